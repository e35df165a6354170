"""Catalog / file table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopflow.schemas import bind


def read_table(spark: SparkSession, name: str, base: str | None = None,
               database: str | None = None) -> DataFrame:
    """Read a table by name: ``{base}/{name}.parquet`` when a folder is given, else the catalog.

    A configured database is made current first (S1). Nothing is read until an action runs,
    so filters and column choices reach the parquet scan.
    """
    if base:
        return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    if database:
        spark.catalog.setCurrentDatabase(database)
    return spark.table(name)


def read_bound(spark: SparkSession, name: str, schema, base: str | None = None,
               database: str | None = None) -> DataFrame:
    """Read and bind to a fixed schema by column name."""
    return bind(read_table(spark, name, base, database), schema)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, database: str | None = None,
                   sort_by: list[str] | None = None) -> None:
    """Store ``df`` as a managed table bucketed (and optionally sorted) on ``key``.

    Two tables bucketed on the same key with the same bucket count join without a shuffle:
    with actions and users both bucketed on ``user_id`` the request's user semi join (J1)
    reads matching buckets side by side even when the users are too many to broadcast.
    """
    w = df.write.mode("overwrite").bucketBy(buckets, key)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(f"{database}.{name}" if database else name)
