"""Symbols by role, and dated events, from their JSON files."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from ..functions.temporal import us_holidays


def universe(spark: SparkSession, groups: dict, invalid: list[str] = ()) -> DataFrame:
    """(symbol, role, grp) of {"training": [...], "correlative": [...], "prediction_groups": [{"name", "symbols"}]}, without invalid ones."""
    rows = [(s, role, None) for role in ("training", "correlative") for s in groups.get(role, [])]
    rows += [(s, "prediction", g["name"]) for g in groups.get("prediction_groups", []) for s in g["symbols"]]
    bad = set(invalid)
    return spark.createDataFrame(sorted({r for r in rows if r[0] not in bad}, key=str), "symbol string, role string, grp string")


def event_dates(text: str, key: str = "fed_event_days") -> list[dt.date]:
    """The readable ISO dates of a JSON list, in order."""
    out = []
    for s in json.loads(text).get(key, []):
        try:
            out.append(dt.date.fromisoformat(str(s)[:10]))
        except ValueError:
            continue
    return sorted(set(out))


def market_calendar(spark: SparkSession, last_year: int, events: list[dt.date], years: int = 21) -> dict[str, DataFrame]:
    """Holidays of the last so many years, and event dates, as (date) tables."""
    holidays = us_holidays(last_year - years + 1, last_year)
    return {name: spark.createDataFrame([(d,) for d in dates], "date date") for name, dates in (("holidays", holidays), ("events", events))}


def combined(*lists: DataFrame) -> DataFrame:
    """The distinct symbols of several lists."""
    out = lists[0].select("symbol")
    for other in lists[1:]:
        out = out.union(other.select("symbol"))
    return out.distinct()


def without(symbols: DataFrame, invalid: DataFrame) -> DataFrame:
    return symbols.select("symbol").distinct().join(invalid.select("symbol"), "symbol", "left_anti")


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("symbol").intersect(b.select("symbol"))
