"""OHLCV bars: resampling, ranges, alignment, trimming, merging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.indicators import by_time


def tick_order() -> Column:
    """One number that orders ticks by (ts, id): with it, unlike with a struct, first and last prices are hash aggregates."""
    number = lambda c: c.cast("decimal(19,0)")
    return number(F.unix_micros("ts")) * F.lit("20000000000000000000").cast("decimal(20,0)") + number(F.col("id"))


def traded(ticks: DataFrame) -> Column:
    """What the ticks of a bar traded: their sizes, or their number where ticks have no size."""
    return F.sum(F.coalesce("size", F.lit(0.0)) if "size" in ticks.columns else F.lit(1.0))


def from_ticks(ticks: DataFrame, unit: str = "day") -> DataFrame:
    """Bars of a calendar unit from ticks (symbol, ts, price, id, size). Volume: the sum of the sizes; a null size is 0.

    Ticks without that column count 1 each. One aggregation with map-side combining; order within a bar is by (ts, id).
    """
    order = tick_order()
    bars = ticks.groupBy("symbol", F.date_trunc(unit, "ts").alias("datetime")).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        traded(ticks).alias("volume"),
    )
    return bars.withColumn("adj_close", F.col("close"))


def resample(bars: DataFrame, start: Column) -> DataFrame:
    """Bars of longer windows from bars, `start` being each bar's window: dated by their first bar; without bars, no row."""
    at = F.col("datetime")
    return bars.withColumn("__start", start).groupBy("symbol", "__start").agg(
        F.min(at).alias("datetime"),
        F.min_by("open", at).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", at).alias("close"),
        F.sum("volume").alias("volume"),
        F.max_by("adj_close", at).alias("adj_close"),
    ).drop("__start")


def resample_anchored(bars: DataFrame, minutes: int, anchor: str | None = None) -> DataFrame:
    """Windows of so many minutes, counted from each symbol's first bar, or so that they end at a given time.

    With an anchor, bars before the first whole window and from the anchor on are left out; a symbol that has no whole
    window before the anchor has the one window that begins on the grid at or after its first bar.
    """
    first = bars.groupBy("symbol").agg(F.unix_seconds(F.min("datetime")).alias("__first"))
    table, step, at = bars.join(first, "symbol"), minutes * 60, F.unix_seconds("datetime")
    if anchor is None:
        start = F.col("__first") + F.floor((at - F.col("__first")) / step) * step
        return resample(table, F.timestamp_seconds(start))
    end = F.unix_seconds(F.lit(anchor).cast("timestamp"))
    begin = F.col("__first") + F.pmod(end - F.col("__first"), F.lit(step))
    none = end - step < begin
    start = begin + F.floor((at - begin) / step) * step
    inside = (at >= begin) & F.when(none, at < begin + step).otherwise(at < end)
    return resample(table.where(inside), F.timestamp_seconds(start))


def ranges(bars: DataFrame) -> DataFrame:
    """One row: least and greatest price and volume over all symbols."""
    return bars.agg(F.min("low").alias("min_price"), F.max("high").alias("max_price"), F.min("volume").alias("min_volume"), F.max("volume").alias("max_volume"))


def align_start(bars: DataFrame) -> DataFrame:
    """Bars from the latest of the symbols' first datetimes on."""
    start = bars.groupBy("symbol").agg(F.min("datetime").alias("first")).agg(F.max("first").alias("__start"))
    return bars.join(F.broadcast(start), F.col("datetime") >= F.col("__start")).drop("__start")


def null_trim(bars: DataFrame, ignore: tuple[str, ...] = ("volume", "obv", "relative_volume", "volume_change", "volume_rvol_20d")) -> DataFrame:
    """Drops, per symbol, everything up to the last bar with a null, whatever comes before it.

    Columns to ignore, and columns that a symbol never has a value in, don't count.
    """
    names = [c for c in bars.columns if c not in (*ignore, "symbol")]
    whole = Window.partitionBy("symbol")
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() & (F.count(c).over(whole) > 0) for c in names])
    rows = bars.withColumn("__bad", bad).withColumn("__row", F.row_number().over(by_time()))
    rows = rows.withColumn("__last", F.max(F.when(F.col("__bad"), F.col("__row"))).over(whole))
    return rows.where(F.col("__row") > F.coalesce("__last", F.lit(0))).drop("__bad", "__row", "__last")


def new_rows(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Fresh bars at datetimes that aren't stored yet."""
    return fresh.join(stored.select("symbol", "datetime"), ["symbol", "datetime"], "left_anti")


def keep_first(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key: the first in order."""
    at = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(at)).where("__n = 1").drop("__n")


def upsert(stored: DataFrame, fresh: DataFrame, order: str) -> DataFrame:
    """Stored bars and the new ones; of repeats inside the fresh batch the first by `order` is taken."""
    once = keep_first(new_rows(stored, fresh), ["symbol", "datetime"], [order]).select(*stored.columns)
    return once.unionByName(stored)


def stale_symbols(universe: DataFrame, bars: DataFrame, days: int = 7) -> DataFrame:
    """universe (symbol) with the last datetime and whether it is missing or more than `days` whole days before the latest of all."""
    last = bars.groupBy("symbol").agg(F.max("datetime").alias("last"))
    latest = last.agg(F.max("last").alias("latest"))
    out = universe.join(last, "symbol", "left").join(F.broadcast(latest), how="left")
    return out.withColumn("is_stale", F.coalesce(F.floor((F.unix_seconds("latest") - F.unix_seconds("last")) / 86400) > days, F.lit(True))).drop("latest")


def latest(bars: DataFrame) -> DataFrame:
    """The last bar of each symbol."""
    fields = F.struct(*[c for c in bars.columns if c != "symbol"])
    return bars.groupBy("symbol").agg(F.max_by(fields, "datetime").alias("r")).select("symbol", "r.*")


def reconcile(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Two versions (id, last_updated, payload) of a dataset -> the newer; equal ids or times: the local one."""
    both = local.withColumn("is_local", F.lit(1)).unionByName(remote.withColumn("is_local", F.lit(0)))
    both = both.where(F.col("id").isNotNull() & F.col("last_updated").isNotNull())
    same = F.when(F.count_distinct("id") == 1, F.max_by("payload", "is_local"))
    return both.agg(F.coalesce(same, F.max_by("payload", F.struct("last_updated", "is_local"))).alias("payload"))
