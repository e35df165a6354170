"""Request parameters -> conjunctive filters on actions and users (F1, F8, J1; D1, D2).

Parameters are the reference's condition JSON (``startDate endDate startAge endAge
professionals gender city targetPageFlow``). A missing, null or blank field means "no filter".
Values become typed literals; no SQL text is ever built from them.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("startDate", "endDate", "startAge", "endAge", "professionals", "gender", "city",
          "targetPageFlow")


def parse_conditions(params) -> dict:
    """JSON text, dict or None -> dict with every known field (blank -> None)."""
    if params is None:
        raw = {}
    elif isinstance(params, str):
        raw = json.loads(params) if params.strip() else {}
    else:
        raw = dict(params)
    out = {}
    for f in FIELDS:
        v = raw.get(f)
        if v is not None and not isinstance(v, str):
            v = str(v)
        out[f] = v.strip() if isinstance(v, str) and v.strip() != "" else None
    return out


def conditions_json(params) -> str:
    """Canonical JSON text of the parameters (stored next to results, F9)."""
    return json.dumps(parse_conditions(params), sort_keys=True, ensure_ascii=False)


def _all(preds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, preds) if preds else None


def _day_text(value: str) -> str:
    """A request date as canonical ``yyyy-MM-dd`` text (``2024-1-5`` -> ``2024-01-05``)."""
    y, m, d = (int(x) for x in value.split("-"))
    return dt.date(y, m, d).isoformat()


def action_predicate(params) -> Column | None:
    """Predicates on action columns: day range and city.

    The day column is ``yyyy-MM-dd`` text and is compared as text, as the reference did; with
    the parameter in the same canonical form this is date order, and a literal text bound
    reaches the parquet scan as a pushed filter (a cast of the column would not).
    """
    p = parse_conditions(params)
    preds = []
    if p["startDate"]:
        preds.append(F.col("date") >= F.lit(_day_text(p["startDate"])))
    if p["endDate"]:
        preds.append(F.col("date") <= F.lit(_day_text(p["endDate"])))
    if p["city"]:
        preds.append(F.col("city_id") == F.lit(int(p["city"])))
    return _all(preds)


def user_predicate(params) -> Column | None:
    """Predicates on user columns: age range, profession (parameter ``professionals``), gender."""
    p = parse_conditions(params)
    preds = []
    if p["startAge"]:
        preds.append(F.col("age") >= F.lit(int(p["startAge"])))
    if p["endAge"]:
        preds.append(F.col("age") <= F.lit(int(p["endAge"])))
    if p["professionals"]:
        preds.append(F.col("professional") == F.lit(p["professionals"]))
    if p["gender"]:
        preds.append(F.col("gender") == F.lit(p["gender"]))
    return _all(preds)


def filter_actions(actions: DataFrame, users: DataFrame, params=None) -> DataFrame:
    """Actions of known users that pass the request filters; action columns only (``ua.*``).

    The reference inner-joins on ``user_id`` and keeps only action columns, so a left-semi join
    is the same result (``user_id`` is the key of ``users``) and ships only user keys. Filters
    are pushed to both scans by Catalyst; Spark broadcasts the user keys when they are small
    and shuffles otherwise.
    """
    ap, up = action_predicate(params), user_predicate(params)
    a = actions.filter(ap) if ap is not None else actions
    u = users.filter(up) if up is not None else users
    return a.join(u.select("user_id"), "user_id", "left_semi").select(*actions.columns)


def target_flow(params, default: str = "1,2,3,4,5,6,7") -> list[int]:
    """Target page flow as a list of page ids (any length >= 2, D11)."""
    p = parse_conditions(params)
    text = p["targetPageFlow"] or default
    return [int(x) for x in text.split(",") if x.strip() != ""]
