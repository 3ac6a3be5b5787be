"""A price provider as a Python data source: one partition for each symbol and block of days.

The client is any callable (symbol, start, end, interval) -> rows of (datetime, open, high, low, close, adj_close,
volume); it is named by its import path, so that executors load it themselves.
"""

from __future__ import annotations

import datetime as dt
import importlib
import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..config import FALLBACK_DAYS, Exchange
from ..functions.interval import to_minutes
from ..operators.bars import keep_first

SCHEMA = "symbol string, datetime timestamp, open double, high double, low double, close double, adj_close double, volume double"


@dataclass
class Block(InputPartition):
    symbol: str
    start: dt.datetime
    end: dt.datetime


def blocks(start: dt.datetime, end: dt.datetime, days: int = 240) -> list[tuple[dt.datetime, dt.datetime]]:
    """[start, end] in pieces that begin at midnight, of at most so many days."""
    out, at = [], start
    while at <= end:
        stop = min(end, dt.datetime.combine(at.date(), dt.time(), at.tzinfo) + dt.timedelta(days))
        out.append((at, stop))
        if stop == end:
            break
        at = stop
    return out


class PriceReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        start, end = (dt.datetime.fromisoformat(self.options[k]) for k in ("start", "end"))
        days = int(self.options.get("blockdays", 240))
        return [Block(s, a, b) for s in self.options["symbols"].split(",") for a, b in blocks(start, end, days)]

    def read(self, partition: Block):
        module, _, name = self.options["client"].partition(":")
        client = getattr(importlib.import_module(module), name)
        tries, pause = int(self.options.get("retries", 3)), float(self.options.get("sleep", 1))
        rows = []
        for k in range(1, tries + 1):
            try:
                rows = list(client(partition.symbol, partition.start, partition.end, self.options.get("interval", "1h")))
                break
            except Exception as e:
                where = f"{partition.symbol} from {partition.start} to {partition.end}"
                logging.getLogger(__name__).warning("Prices of %s, attempt %d of %d: %s", where, k, tries, e)
                if k < tries:
                    time.sleep(pause)
                elif self.options.get("onerror", "empty") == "fail":
                    raise RuntimeError(f"No prices of {where}") from e
        for r in rows:
            if partition.start <= r[0] <= partition.end:
                yield (partition.symbol, *r)


class PriceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "prices"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PriceReader:
        return PriceReader(self.options)


def read(spark: SparkSession, client: str, symbols: list[str], start: dt.datetime, end: dt.datetime, interval: str = "1h", **options) -> DataFrame:
    """Bars of the symbols in [start, end]; where blocks overlap, the first of equal datetimes is kept.

    A block that can't be fetched after all `retries` has no rows, and each failure is logged as a warning; with
    onerror="fail" it fails the read, so that lost history can't be taken for days without trading.
    """
    spark.dataSource.register(PriceSource)
    reader = spark.read.format("prices").options(client=client, symbols=",".join(symbols), start=start.isoformat(), end=end.isoformat(), interval=interval, **options)
    return keep_first(reader.load(), ["symbol", "datetime"], ["open", "close"])


def cursors(universe: DataFrame, bars: DataFrame, as_of: str, interval: str = "1h") -> DataFrame:
    """(symbol, start): where the next load begins, one step after the last bar, or so many days back for a new symbol."""
    last = bars.groupBy("symbol").agg(F.max("datetime").alias("last"))
    step, back = to_minutes(interval) * 60, FALLBACK_DAYS.get(interval, 59) * 86400
    now = F.unix_seconds(F.lit(as_of).cast("timestamp"))
    start = F.coalesce(F.unix_seconds("last") + step, now - back)
    return universe.select("symbol").distinct().join(last, "symbol", "left").select(
        "symbol", F.timestamp_seconds(start).alias("start"), (start > now).alias("is_waiting"), F.greatest(start - now, F.lit(0)).alias("wait_seconds")
    )


def sessions(spark: SparkSession, exchange: Exchange, first: str, last: str, holidays: DataFrame, step_minutes: int = 60) -> DataFrame:
    """(date, open, close) of the trading days in [first, last], in UTC; hours that open as they close last the whole day."""
    days = spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}')) AS date")
    days = days.where(F.array(*(F.lit(d) for d in exchange.days))[F.weekday("date")]).join(F.broadcast(holidays), "date", "left_anti")
    at = lambda t: F.to_utc_timestamp(F.concat_ws(" ", F.col("date").cast("string"), F.lit(t)), exchange.timezone)
    out = days.select("date", at(exchange.regular[0]).alias("open"), at(exchange.regular[1]).alias("close"))
    if exchange.regular[0] == exchange.regular[1]:
        out = out.withColumn("close", F.timestamp_seconds(F.unix_seconds("open") + 86400 - max(60, step_minutes * 60)))
    return out


def next_bar(last: DataFrame, calendar: DataFrame, step_minutes: int) -> DataFrame:
    """(symbol, next): the first time from last + step on that lies in a session: itself, or the next one's opening.

    Each moment has one session to wait for or be in: the first that closes after it. Sessions are expanded to the dates on
    which they are that one, so that the join is by equal dates; the calendar has a row for each day.
    """
    rows = last.select("symbol", F.timestamp_seconds(F.unix_seconds("last") + step_minutes * 60).alias("want")).withColumn("date", F.to_date("want"))
    earliest = rows.agg(F.min("date").alias("__earliest"))
    sessions = calendar.select("open", "close", F.lag("close").over(Window.orderBy("close")).alias("__before")).join(F.broadcast(earliest))
    begin = F.coalesce(F.to_date("__before"), F.least("__earliest", F.to_date("open")))
    days = sessions.where("__earliest is not null").select("open", "close", "__before", F.explode(F.sequence(begin, F.to_date("close"))).alias("date"))
    inside = (F.col("close") > F.col("want")) & (F.col("__before").isNull() | (F.col("__before") <= F.col("want")))
    return rows.join(days, "date").where(inside).groupBy("symbol").agg(F.min(F.greatest("want", "open")).alias("next"))


def shortest_wait(cursor_rows: DataFrame) -> DataFrame:
    """(symbol, wait_seconds) of the symbol whose next bar comes first; none if nothing waits."""
    first = F.min_by(F.struct("symbol", "wait_seconds"), F.struct("wait_seconds", "symbol")).alias("r")
    return cursor_rows.where("is_waiting").agg(first).where("r is not null").select("r.*")


def available(universe: DataFrame, bars: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """(symbol, is_available): whether a symbol has any bar in the last so many days."""
    late = F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("datetime") <= days * 86400
    some = bars.where(late).select("symbol").distinct().withColumn("is_available", F.lit(True))
    return universe.select("symbol").distinct().join(some, "symbol", "left").withColumn("is_available", F.coalesce("is_available", F.lit(False)))


def to_process(universe: DataFrame, bars: DataFrame, invalid: DataFrame) -> DataFrame:
    """Symbols (symbol, name) to load: all but those without history that are invalid or have no name."""
    bare = universe.join(bars.select("symbol"), "symbol", "left_anti")
    bad = bare.join(invalid.select("symbol").withColumn("__bad", F.lit(True)), "symbol", "left")
    skipped = bad.where(F.col("__bad") | F.coalesce(F.trim("name"), F.lit("")).eqNullSafe("")).select("symbol")
    return universe.join(skipped, "symbol", "left_anti")
