"""Column expressions shared by the operators (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACTION_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(x, decimals: int) -> Column:
    """Round half up in doubles: floor(x * 10^d + 0.5) / 10^d."""
    scale = float(10 ** decimals)
    return (F.floor(col_(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def percent(count, total, decimals: int) -> Column:
    """Share of ``count`` in ``total`` in percent, rounded half up.

    Same expression order as the reference (count / total * scale, then round), so the doubles
    match bit for bit. An empty total gives 0.0 instead of an error (ANSI division by zero).
    """
    scale = float(10 ** (decimals + 2))
    ratio = col_(count).cast("double") / F.nullif(col_(total).cast("double"), F.lit(0.0))
    rounded = F.floor(ratio * F.lit(scale) + F.lit(0.5)) / F.lit(float(10 ** decimals))
    return F.coalesce(rounded.cast("double"), F.lit(0.0))


def csv_ids(c) -> Column:
    """Split a comma list into trimmed, non-empty tokens (null list -> null)."""
    return F.filter(F.transform(F.split(col_(c), ","), lambda s: F.trim(s)), lambda s: s != "")


def parse_action_time(c, fmt: str = ACTION_TIME_FORMAT) -> Column:
    """Text instant -> timestamp; unparsable text gives null instead of an error."""
    return F.try_to_timestamp(col_(c), F.lit(fmt))


def time_chunk(ts, seconds: int) -> Column:
    """Monotone time bucket used to split very long sessions into ordered pieces."""
    return F.floor(F.unix_seconds(col_(ts)) / F.lit(int(seconds)))


def pct_label(name, rate) -> Column:
    """``name:21.2%`` (the rate printed as a double, e.g. 100.0)."""
    return F.concat(col_(name), F.lit(":"), col_(rate).cast("string"), F.lit("%"))


def sorted_join(items, sep: str = ",") -> Column:
    """Join ``items`` (array of struct(order..., v)) by the struct order, nulls skipped."""
    return F.array_join(F.transform(F.array_sort(col_(items)), lambda x: x["v"]), sep)


def json_pairs(arr, key: str, value: str) -> Column:
    """Array of structs -> compact JSON ``[{"k":v},...]``, one object per pair, array order kept."""
    return F.to_json(F.transform(col_(arr), lambda x: F.create_map(x[key].cast("string"), x[value])))
