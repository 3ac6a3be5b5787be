"""Trading hours inferred from bars: daily bounds, recurrent blocks, date ranges, a schedule of all symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GAP_DAYS = 8
RECURRENT = 0.2


def daily_bounds(bars: DataFrame) -> DataFrame:
    """(symbol, date, first, last): the first and last time of day, "HH:MM"."""
    t = F.date_format("datetime", "HH:mm")
    return bars.groupBy("symbol", F.to_date("datetime").alias("date")).agg(F.min(t).alias("first"), F.max(t).alias("last"))


def _minutes(hhmm: str):
    return F.substring(hhmm, 1, 2).cast("int") * 60 + F.substring(hhmm, 4, 2).cast("int")


def trading_blocks(bounds: DataFrame, interval_minutes: int) -> DataFrame:
    """(symbol, weekday, from, to, hours, all_day, dates, recurrent): the day's hours by weekday; to wraps at midnight.

    Recurrent: as long as the weekday's longest, on at least a fifth of its dates.
    """
    end = (_minutes("last") + interval_minutes) % 1440
    to = F.format_string("%02d:%02d", F.floor(end / 60).cast("int"), (end % 60).cast("int"))
    rows = bounds.select("symbol", F.weekday("date").alias("weekday"), F.col("first").alias("from"), to.alias("to"), "date")
    blocks = rows.groupBy("symbol", "weekday", "from", "to").agg(F.count_distinct("date").alias("dates"))
    length = _minutes("to") - _minutes("from")
    blocks = blocks.withColumn("hours", F.round(F.when(length <= 0, length + 1440).otherwise(length) / 60, 2))
    day = Window.partitionBy("symbol", "weekday")
    longest = F.col("hours") == F.max("hours").over(day)
    often = F.col("dates") >= RECURRENT * F.sum("dates").over(day)
    return blocks.withColumns({"all_day": F.col("hours") == 24, "recurrent": longest & often})


def date_islands(dates: DataFrame, keys: list[str], gap: int = GAP_DAYS) -> DataFrame:
    """Rows (keys, date) -> (keys, date_from, date_to): runs of dates without a gap of more than `gap` days."""
    w = Window.partitionBy(*keys).orderBy("date")
    new = F.coalesce(F.datediff("date", F.lag("date").over(w)) > gap, F.lit(True))
    runs = dates.withColumn("__new", new.cast("int")).withColumn("__run", F.sum("__new").over(w))
    return runs.groupBy(*keys, "__run").agg(F.min("date").alias("date_from"), F.max("date").alias("date_to")).drop("__run")


def merge_intervals(spans: DataFrame, keys: list[str], gap: int = GAP_DAYS) -> DataFrame:
    """Rows (keys, date_from, date_to) -> the same with overlapping and close ones joined."""
    w = Window.partitionBy(*keys).orderBy("date_from", "date_to")
    before = F.max("date_to").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.datediff("date_from", before) > gap, F.lit(True))
    runs = spans.withColumn("__new", new.cast("int")).withColumn("__run", F.sum("__new").over(w))
    return runs.groupBy(*keys, "__run").agg(F.min("date_from").alias("date_from"), F.max("date_to").alias("date_to")).drop("__run")


def close_gaps(spans: DataFrame, order: list[str], keys: list[str] = ()) -> DataFrame:
    """Neighbours (in order) that are more than a day apart are both moved to the middle between them."""
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    prev_to, next_from = F.lag("date_to").over(w), F.lead("date_from").over(w)
    ahead, behind = F.datediff(next_from, "date_to"), F.datediff("date_from", prev_to)
    to = F.when(ahead > 1, F.date_add("date_to", F.floor(ahead / 2).cast("int"))).otherwise(F.col("date_to"))
    start = F.when(behind > 1, F.date_add(prev_to, F.floor(behind / 2).cast("int") + 1)).otherwise(F.col("date_from"))
    return spans.withColumns({"__to": to, "__from": start}).drop("date_from", "date_to").withColumnsRenamed({"__from": "date_from", "__to": "date_to"})


def adjacent_merge(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Neighbours by date_from with equal hours (from, to) become one, ending where the last of them does."""
    w = Window.partitionBy(*keys).orderBy("date_from", "from", "to")
    same = (F.lag("from").over(w) == F.col("from")) & (F.lag("to").over(w) == F.col("to"))
    rows = spans.withColumn("__n", F.row_number().over(w)).withColumn("__new", (~F.coalesce(same, F.lit(False))).cast("int"))
    rows = rows.withColumn("__run", F.sum("__new").over(w))
    return rows.groupBy(*keys, "__run", "from", "to").agg(F.min("date_from").alias("date_from"), F.max_by("date_to", "__n").alias("date_to")).drop("__run")


def symbol_summary(bars: DataFrame, interval_minutes: int) -> DataFrame:
    """(symbol, from, to, date_from, date_to, hours, all_day): the recurrent hours of each symbol and their dates."""
    bounds = daily_bounds(bars)
    blocks = trading_blocks(bounds, interval_minutes).where("recurrent")
    end = (_minutes("last") + interval_minutes) % 1440
    to = F.format_string("%02d:%02d", F.floor(end / 60).cast("int"), (end % 60).cast("int"))
    dated = bounds.select("symbol", F.weekday("date").alias("weekday"), F.col("first").alias("from"), to.alias("to"), "date")
    spans = date_islands(dated.join(blocks.select("symbol", "weekday", "from", "to"), ["symbol", "weekday", "from", "to"], "left_semi"), ["symbol", "weekday", "from", "to"])
    spans = merge_intervals(adjacent_merge(spans, ["symbol", "weekday"]), ["symbol", "from", "to"])
    about = blocks.groupBy("symbol", "from", "to").agg(F.max("hours").alias("hours"), F.max("all_day").alias("all_day"))
    return spans.join(about, ["symbol", "from", "to"])


def consolidated(summary: DataFrame) -> DataFrame:
    """The schedule of all symbols (from, to, date_from, date_to), without all-day hours."""
    part = summary.where("not all_day").select("from", "to", "hours", "date_from", "date_to")
    return merge_intervals(part, ["from", "to", "hours"]).drop("hours")


def final_schedule(schedule: DataFrame) -> DataFrame:
    """The schedule without rows that start or end at midnight, its gaps closed."""
    return close_gaps(schedule.where("`from` <> '00:00' and `to` <> '00:00'").distinct(), ["date_from", "from", "to"])


def bar_seconds(bars: DataFrame) -> DataFrame:
    """(symbol, bar_seconds): the commonest step between bars, the least of several."""
    w = Window.partitionBy("symbol").orderBy("datetime")
    step = bars.select("symbol", (F.unix_seconds("datetime") - F.unix_seconds(F.lag("datetime").over(w))).alias("step")).where("step is not null")
    return step.groupBy("symbol", "step").count().groupBy("symbol").agg(F.max_by("step", F.struct("count", -F.col("step"))).alias("bar_seconds"))


def bars_per_session(bars: DataFrame) -> DataFrame:
    """(symbol, bars_per_session): the median length of a day, in bars, rounded up."""
    t = F.unix_seconds("datetime")
    days = bars.groupBy("symbol", F.to_date("datetime").alias("date")).agg((F.max(t) - F.min(t)).alias("length"))
    days = days.join(bar_seconds(bars), "symbol").withColumn("n", (F.col("length") + F.col("bar_seconds")) / F.col("bar_seconds"))
    return days.groupBy("symbol").agg(F.ceil(F.median("n")).cast("long").alias("bars_per_session"))
