"""Fixed schemas of the input tables and the stream record (bound by column name)."""

from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("gender", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_INFO = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

# Parsed ad-click record; ``seq`` is the source's own row id (stream offset, or the event id of the
# fixture), used only to order events of the same millisecond.
ADS_LOG = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ads_id", T.StringType()),
    T.StructField("seq", T.LongType()),
])

# Request parameters (the reference's condition JSON).
CONDITIONS = T.StructType([
    T.StructField("startDate", T.StringType()),
    T.StructField("endDate", T.StringType()),
    T.StructField("startAge", T.StringType()),
    T.StructField("endAge", T.StringType()),
    T.StructField("professionals", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("targetPageFlow", T.StringType()),
])


def bind(df, schema: T.StructType):
    """Select the schema's columns by name with casts (extra columns are dropped)."""
    from pyspark.sql import functions as F
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
