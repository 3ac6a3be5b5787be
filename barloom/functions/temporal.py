"""Calendar, event and market-phase features as columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def seconds_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _elapsed(ts: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """Share of [start, end) that has passed, and its length in days."""
    length = F.unix_seconds(end) - F.unix_seconds(start)
    return (F.unix_seconds(ts) - F.unix_seconds(start)) / length, length / 86400


def time_fractions(ts: Column, raw: bool = False) -> dict[str, Column]:
    """Share of the day, week (from Monday), month and year that has passed; raw: as hours and days, counted from 1."""
    day = seconds_of_day(ts) / 86400
    week = (F.weekday(ts) * 86400 + seconds_of_day(ts)) / 604800
    month = F.date_trunc("month", ts)
    year = F.date_trunc("year", ts)
    m, m_days = _elapsed(ts, month, F.to_timestamp(F.add_months(month, 1)))
    y, y_days = _elapsed(ts, year, F.to_timestamp(F.add_months(year, 12)))
    if raw:
        return {"time_of_day": day * 24, "time_of_week": week * 7 + 1, "time_of_month": m * m_days + 1, "time_of_year": y * y_days + 1}
    return {"time_of_day": day, "time_of_week": week, "time_of_month": m, "time_of_year": y}


def is_weekday(ts: Column) -> Column:
    return F.weekday(ts) < 5


def _nth(year: int, month: int, weekday: int, n: int) -> dt.date:
    """The n-th such weekday of a month; n = -1: the last."""
    if n > 0:
        first = dt.date(year, month, 1)
        return first + dt.timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(1)
    return last - dt.timedelta((last.weekday() - weekday) % 7)


def us_holidays(first_year: int, last_year: int) -> list[dt.date]:
    """US federal holidays by rule; one on a Saturday is also kept the day before, one on a Sunday the day after."""
    out: set[dt.date] = set()
    for y in range(first_year, last_year + 1):
        fixed = [dt.date(y, 1, 1), dt.date(y, 7, 4), dt.date(y, 11, 11), dt.date(y, 12, 25)] + ([dt.date(y, 6, 19)] if y >= 2021 else [])
        for d in fixed:
            out.add(d)
            out.update({5: [d - dt.timedelta(1)], 6: [d + dt.timedelta(1)]}.get(d.weekday(), []))
        out.update([_nth(y, 1, 0, 3), _nth(y, 2, 0, 3), _nth(y, 5, 0, -1), _nth(y, 9, 0, 1), _nth(y, 10, 0, 2), _nth(y, 11, 3, 4)])
    return sorted(out)


def dates_table(spark: SparkSession, dates: list[dt.date]) -> DataFrame:
    """A calendar dimension (date): a few hundred rows, broadcast where it is joined."""
    return spark.createDataFrame([(d,) for d in sorted(set(dates))], "date date")


def event_features(bars: DataFrame, events: DataFrame, name: str, days: int = 5, raw: bool = False, nearest: bool = False) -> DataFrame:
    """bars with is_<name>, is_pre_<name> and is_post_<name>.

    The weight of a date k days from an event is (days + 1 - k) / days for k up to days, else 0; of several events the
    farthest counts, unless `nearest`. Events are expanded to the dates around them, so the join is by equal dates.
    """
    k = F.explode(F.sequence(F.lit(-days), F.lit(days))).alias("k")
    around = events.distinct().select("date", k).select(F.date_add("date", F.col("k")).alias("__date"), "k")
    pick = F.min if nearest else F.max
    # An event lies k days after the date where the date is the event moved back by k.
    table = around.groupBy("__date").agg(
        F.max(F.col("k") == 0).alias("__is"),
        pick(F.when(F.col("k") < 0, -F.col("k"))).alias("__before"),
        pick(F.when(F.col("k") > 0, F.col("k"))).alias("__after"),
    )
    out = bars.join(F.broadcast(table), F.to_date("datetime") == F.col("__date"), "left")
    weight = lambda c: F.coalesce((days + 1 - F.col(c)) / days, F.lit(0.0))
    is_event = F.coalesce("__is", F.lit(False))
    scale = 100 if raw else 1
    return out.withColumns({
        f"is_{name}": is_event if raw else is_event.cast("double"),
        f"is_pre_{name}": weight("__before") * scale,
        f"is_post_{name}": weight("__after") * scale,
    }).drop("__date", "__is", "__before", "__after")


def is_workday(bars: DataFrame, holidays: DataFrame, name: str = "is_workday") -> DataFrame:
    """bars with a flag of weekdays that are no holiday."""
    table = F.broadcast(holidays.distinct().withColumnRenamed("date", "__date"))
    out = bars.join(table, F.to_date("datetime") == F.col("__date"), "left")
    return out.withColumn(name, is_weekday(F.col("datetime")) & F.col("__date").isNull()).drop("__date")


def market_phase(bars: DataFrame, schedule: DataFrame, intraday: bool, floor_to_hour: bool = False) -> DataFrame:
    """bars (with is_workday) with is_pre_market_time, is_market_time, is_post_market_time and is_market_day.

    schedule: (date_from, date_to, time_from, time_to, ord), "HH:MM"; of overlapping rows the last by ord holds. Its
    ranges are expanded to dates, so the join is by equal dates. Bars of a day or more are always in the market.
    """
    if not intraday:
        flags = {"is_pre_market_time": F.lit(False), "is_market_time": F.lit(True), "is_post_market_time": F.lit(False)}
        return bars.withColumns(flags).withColumn("is_market_day", F.col("is_workday"))
    times = {c: (F.concat(F.substring(c, 1, 2), F.lit(":00")) if floor_to_hour else F.col(c)) for c in ("time_from", "time_to")}
    day = F.explode(F.sequence("date_from", "date_to")).alias("__date")
    table = schedule.select(day, times["time_from"].alias("time_from"), times["time_to"].alias("time_to"), "ord")
    table = table.groupBy("__date").agg(F.max_by(F.struct("time_from", "time_to"), "ord").alias("__s"))
    out = bars.join(F.broadcast(table), F.to_date("datetime") == F.col("__date"), "left")
    now, lo, hi = F.date_format("datetime", "HH:mm:ss"), F.concat("__s.time_from", F.lit(":00")), F.concat("__s.time_to", F.lit(":00"))
    no = F.lit(False)
    out = out.withColumns({
        "is_pre_market_time": F.coalesce(now < lo, no), "is_market_time": F.coalesce(now.between(lo, hi), no), "is_post_market_time": F.coalesce(now > hi, no),
    })
    any_phase = F.col("is_pre_market_time") | F.col("is_market_time") | F.col("is_post_market_time")
    return out.withColumn("is_market_day", any_phase & F.col("is_workday")).drop("__date", "__s")
