"""Ticks (symbol, ts, price, id, size) from tables that have them under other names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ticks(df: DataFrame, symbol: str, ts: str, price: str, key: str, size: Column | None = None) -> DataFrame:
    """size: what was traded; 1 for each tick if none is given."""
    amount = F.lit(1.0) if size is None else size.cast("double")
    return df.select(F.col(symbol).alias("symbol"), F.col(ts).cast("timestamp").alias("ts"), F.col(price).alias("price"), F.col(key).alias("id"), amount.alias("size"))


def event_ticks(spark: SparkSession, folder: str, size: Column | None = None) -> DataFrame:
    return ticks(spark.read.parquet(f"{folder}/events.parquet"), "event_type", "ts", "value", "event_id", size)


def order_ticks(spark: SparkSession, folder: str, size: Column | None = None) -> DataFrame:
    return ticks(spark.read.parquet(f"{folder}/orders.parquet"), "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey", size)
