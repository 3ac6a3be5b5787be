"""Checks of bars (the wording of the issues is fixed). Each gives (symbol, issue) rows; of a symbol's issues the one of the earliest check counts."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RAW_COLUMNS

PRICES = ("open", "high", "low", "close", "adj_close")
#: Range rules in the order in which the first broken one is named.
RANGE_RULES = (("low", ">", "high"), ("low", ">", "open"), ("low", ">", "close"), ("low", ">", "adj_close"), ("high", "<", "open"), ("high", "<", "close"), ("high", "<", "adj_close"))


def missing_columns(bars: DataFrame, required: tuple[str, ...] = RAW_COLUMNS) -> list[str]:
    return [c for c in required if c not in bars.columns]


def structure(bars: DataFrame, required: tuple[str, ...] = RAW_COLUMNS) -> list[str]:
    """Issues of a table's shape, before any row is read: no or repeated columns, missing ones, and those of a wrong type.

    Datetimes must be timestamps or dates, prices and volumes numbers; names that differ in case only are the same.
    """
    if not bars.columns:
        return ["No columns"]
    seen = Counter(c.lower() for c in bars.columns)
    repeated = sorted(c for c, n in seen.items() if n > 1)
    out = [f"Duplicate columns: {', '.join(repeated)}"] if repeated else []
    absent = [c for c in required if c.lower() not in seen]
    out += [f"Missing columns: {', '.join(absent)}"] if absent else []
    wrong = []
    for f in bars.schema.fields:
        fits = (T.TimestampType, T.TimestampNTZType, T.DateType) if f.name.lower() == "datetime" else T.NumericType
        if f.name.lower() in required and not isinstance(f.dataType, fits):
            wrong.append(f"{f.name} ({f.dataType.simpleString()})")
    return out + ([f"Wrong types: {', '.join(wrong)}"] if wrong else [])


def _first(pairs: list[tuple[Column, str]]) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for holds, name in pairs:
        out = out.when(holds, F.lit(name))
    return out


def null_columns(bars: DataFrame, required: tuple[str, ...] = RAW_COLUMNS) -> DataFrame:
    """(symbol, issue): the required columns, in order, in which a symbol has nulls."""
    flags = [F.when(F.count_if(F.col(c).isNull()) > 0, F.lit(c)) for c in required]
    out = bars.groupBy("symbol").agg(F.concat_ws(", ", *flags).alias("issue"))
    return out.where("issue <> ''").withColumn("issue", F.concat(F.lit("Null values in: "), "issue"))


def empty_history(universe: DataFrame, bars: DataFrame) -> DataFrame:
    return universe.select("symbol").distinct().join(bars.select("symbol"), "symbol", "left_anti").withColumn("issue", F.lit("Historical prices are empty"))


def not_registered(universe: DataFrame, bars: DataFrame) -> DataFrame:
    return bars.select("symbol").distinct().join(universe, "symbol", "left_anti").withColumn("issue", F.lit("Symbol not in registry"))


def unsorted(bars: DataFrame, position: str) -> DataFrame:
    """Symbols whose datetimes fall somewhere in stored order (`position`)."""
    before = F.lag("datetime").over(Window.partitionBy("symbol").orderBy(position))
    found = bars.withColumn("__down", before > F.col("datetime")).where("__down").select("symbol").distinct()
    return found.withColumn("issue", F.lit("datetime column is not sorted"))


def price_range(bars: DataFrame) -> DataFrame:
    """The first broken rule of each symbol."""
    ops = {">": lambda a, b: a > b, "<": lambda a, b: a < b}
    flags = [(F.bool_or(ops[op](F.col(a), F.col(b))), f"{a} {op} {b}") for a, op, b in RANGE_RULES]
    return bars.groupBy("symbol").agg(_first(flags).alias("issue")).where("issue is not null")


def price_sign(bars: DataFrame, raw: bool = True) -> DataFrame:
    """Price columns with values of the wrong sign: raw bars forbid zero, enriched ones only negative values."""
    wrong = lambda c: (F.col(c) <= 0) if raw else (F.col(c) < 0)
    names = F.concat_ws(", ", *(F.when(F.count_if(wrong(c)) > 0, F.lit(c)) for c in PRICES))
    return bars.groupBy("symbol").agg(names.alias("issue")).where("issue <> ''")


def volume(bars: DataFrame) -> DataFrame:
    """(symbol, n_negative, n_zero, issue): negative volume is an issue, zero volume a warning (issue NULL)."""
    out = bars.groupBy("symbol").agg(F.count_if(F.col("volume") < 0).alias("n_negative"), F.count_if(F.col("volume") == 0).alias("n_zero"))
    return out.withColumn("issue", F.when(F.col("n_negative") > 0, F.lit("Negative volume found")))


def uneven_days(bars: DataFrame, interval_seconds: int) -> DataFrame:
    """(symbol, date, spread): days whose steps between bars have a population deviation above the interval."""
    day = F.to_date("datetime")
    before = F.lag("datetime").over(Window.partitionBy("symbol", day).orderBy("datetime"))
    steps = bars.where(F.year("datetime") > 1971).select("symbol", day.alias("date"), (F.unix_seconds("datetime") - F.unix_seconds(before)).alias("step"))
    out = steps.groupBy("symbol", "date").agg(F.stddev_pop("step").alias("spread"))
    return out.where(F.col("spread") > interval_seconds)


def duplicates(bars: DataFrame) -> DataFrame:
    """(symbol, datetime, n) of bars that stand more than once."""
    return bars.groupBy("symbol", "datetime").agg(F.count("*").alias("n")).where("n > 1")


def missing_days(bars: DataFrame, holidays: DataFrame) -> DataFrame:
    """(symbol, date): weekdays between a symbol's first and last bar that are no holiday and have no bar."""
    ends = bars.groupBy("symbol").agg(F.to_date(F.min("datetime")).alias("lo"), F.to_date(F.max("datetime")).alias("hi"))
    days = ends.select("symbol", F.explode(F.sequence("lo", "hi")).alias("date")).where(F.weekday("date") < 5)
    days = days.join(F.broadcast(holidays.distinct()), "date", "left_anti")
    return days.join(bars.select("symbol", F.to_date("datetime").alias("date")), ["symbol", "date"], "left_anti").select("symbol", "date")


def missing_steps(bars: DataFrame, days: int, holidays: DataFrame) -> DataFrame:
    """(symbol, date): for intervals of several days, the dates of the grid from the first bar on that have no bar.

    Grid dates on weekends and holidays don't count.
    """
    ends = bars.groupBy("symbol").agg(F.to_date(F.min("datetime")).alias("lo"), F.to_date(F.max("datetime")).alias("hi"))
    step = F.expr(f"sequence(lo, hi, interval {int(days)} day)")
    grid = ends.select("symbol", F.explode(step).alias("date")).where(F.weekday("date") < 5)
    grid = grid.join(F.broadcast(holidays.distinct()), "date", "left_anti")
    return grid.join(bars.select("symbol", F.to_date("datetime").alias("date")), ["symbol", "date"], "left_anti").select("symbol", "date")


def report(universe: DataFrame, bars: DataFrame, holidays: DataFrame, raw: bool = True, interval_seconds: int = 3600, position: str | None = None) -> DataFrame:
    """(symbol, issue): of every symbol the issue of the earliest check that it fails, NULL if it passes all.

    position: a column with the stored order, where that is to be checked too.
    """
    uneven = uneven_days(bars, interval_seconds).groupBy("symbol").agg(F.min("date").cast("string").alias("d"))
    days = missing_days(bars, holidays) if interval_seconds <= 86400 else missing_steps(bars, interval_seconds // 86400, holidays)
    what = " trading days: [" if interval_seconds <= 86400 else " expected interval points: ["
    quoted = F.array_sort(F.collect_list(F.concat(F.lit("'"), F.col("date").cast("string"), F.lit("'"))))
    days = days.groupBy("symbol").agg(F.concat(F.lit("Missing "), F.count("*").cast("string"), F.lit(what), F.array_join(quoted, ", "), F.lit("]")).alias("issue"))
    checks = [
        not_registered(universe, bars), empty_history(universe, bars), null_columns(bars), *([unsorted(bars, position)] if position else []), days,
        price_range(bars), price_sign(bars, raw), volume(bars).where("issue is not null"),
        uneven.select("symbol", F.concat(F.lit("Inconsistent intervals within "), "d").alias("issue")),
    ]
    issues = reduce(DataFrame.unionByName, (c.select("symbol", "issue", F.lit(k).alias("k")) for k, c in enumerate(checks)))
    first = issues.groupBy("symbol").agg(F.min_by("issue", "k").alias("issue"))
    everyone = universe.select("symbol").union(bars.select("symbol")).distinct()
    return everyone.join(first, "symbol", "left")


def verdict(rows: DataFrame) -> DataFrame:
    """(n_passed, n_failed, is_valid) of a report."""
    n = F.count("issue")
    return rows.agg((F.count("*") - n).alias("n_passed"), n.alias("n_failed"), (n == 0).alias("is_valid"))
