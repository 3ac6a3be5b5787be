"""Market datasets at rest: nested JSON documents and Parquet tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.indicators import repair_volume
from ..operators.bars import stale_symbols

BAR = T.StructType([T.StructField("datetime", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in ("adj_close", "close", "high", "low", "open", "volume"))])
INSTRUMENT = ("symbol", "name", "type", "sector", "industry", "currency", "exchange")
ENTRY = T.StructType([*(T.StructField(c, T.StringType()) for c in INSTRUMENT), T.StructField("historical_prices", T.ArrayType(BAR))])
DOCUMENT = T.StructType([*(T.StructField(c, T.StringType()) for c in ("id", "last_updated", "last_check", "interval")), T.StructField("symbols", T.ArrayType(ENTRY))])


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def delete(spark: SparkSession, path: str) -> bool:
    """Whether there was something to delete."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def read_json(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT) -> DataFrame:
    """Documents of a JSON file; an absent, blank or corrupt file gives none."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    kept = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(kept).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    found = rows.where(F.col("_corrupt").isNull() & F.coalesce(*(F.col(f"`{c}`").isNotNull() for c in schema.names)))
    return found.select(*schema.names)


def with_defaults(document: DataFrame, now: str, new_id: str) -> DataFrame:
    """Documents with times and a list of symbols in any case: a blank or absent id is a new dataset, updated now.

    An absent or unreadable last_check is `now`, such a last_updated the last check; ids are trimmed.
    """
    at = F.lit(now).cast("timestamp")
    known, check = F.nullif(F.trim("id"), F.lit("")), F.coalesce(F.try_to_timestamp("last_check"), at)
    updated = F.when(known.isNull(), at).otherwise(F.coalesce(F.try_to_timestamp("last_updated"), check))
    nothing = F.array().cast(document.schema["symbols"].dataType)
    return document.select(F.coalesce(known, F.lit(new_id)).alias("id"), updated.alias("last_updated"), check.alias("last_check"), "interval", F.coalesce("symbols", nothing).alias("symbols"))


def load_raw(spark: SparkSession, path: str, now: str, invalid: DataFrame | None = None, interval: str = "1h", new_id: str | None = None, stale_days: int = 7) -> dict[str, DataFrame]:
    """A raw dataset: "header", "instruments", "bars" (zero volumes repaired) and "stale" symbols, without the invalid ones.

    An absent or corrupt file is an empty dataset with a new id. now: the time of the load, never taken from the clock.
    """
    new_id = uuid.uuid4().hex if new_id is None else new_id
    found = read_json(spark, path)
    one = spark.range(1).select(F.lit(None).cast("string").alias("id"), F.lit(interval).alias("interval"))
    found = found if not found.isEmpty() else one.select("id", *(F.lit(None).cast(f.dataType).alias(f.name) for f in DOCUMENT.fields[1:3]), "interval", F.lit(None).cast(DOCUMENT["symbols"].dataType).alias("symbols"))
    whole = with_defaults(found, now, new_id)
    about = instruments(whole)
    about = about.join(invalid.select("symbol"), "symbol", "left_anti").select(*INSTRUMENT) if invalid is not None else about
    rows = repair_volume(bars(whole, invalid))
    stale = stale_symbols(about.select("symbol"), rows, stale_days).where("is_stale").select("symbol")
    return {"header": whole.drop("symbols"), "instruments": about, "bars": rows, "stale": stale}


def enriched_schema(features: T.StructType) -> T.StructType:
    """The document of an enriched dataset whose bars have these fields; what else a file holds is not read."""
    fields = [T.StructField("datetime", T.StringType()) if f.name == "datetime" else f for f in features.fields if f.name != "symbol"]
    entry = T.StructType([*(T.StructField(c, T.StringType()) for c in INSTRUMENT), T.StructField("historical_prices", T.ArrayType(T.StructType(fields)))])
    span = T.StructType([T.StructField(c, T.DoubleType()) for c in ("min", "max")])
    times = T.StructType([T.StructField(c, T.StringType()) for c in ("time_from", "time_to", "date_from", "date_to")])
    head = [T.StructField(c, T.StringType()) for c in ("id", "last_updated", "interval")]
    return T.StructType([*head, T.StructField("ranges", T.StructType([T.StructField(c, span) for c in ("price", "volume")])), T.StructField("market_time", T.ArrayType(times)), T.StructField("symbols", T.ArrayType(entry))])


def enriched_document(head: DataFrame, ranges: DataFrame, schedule: DataFrame | None, about: DataFrame, rows: DataFrame) -> DataFrame:
    """The nested document of a header (id, last_updated, interval), ranges of price and volume, the market's hours and enriched bars."""
    spans = ranges.select(F.struct(*(F.struct(F.col(f"min_{c}").alias("min"), F.col(f"max_{c}").alias("max")).alias(c) for c in ("price", "volume"))).alias("ranges"))
    names = [c for c in rows.columns if c not in ("symbol", "datetime")]
    bar = F.struct(F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("datetime"), *names)
    by_time = lambda a, b: F.when(a["datetime"] < b["datetime"], -1).when(a["datetime"] > b["datetime"], 1).otherwise(0)
    history = rows.groupBy("symbol").agg(F.array_sort(F.collect_list(bar), by_time).alias("historical_prices"))
    entries = about.join(history, "symbol", "left").select(F.struct(*INSTRUMENT, "historical_prices").alias("e"))
    by_name = lambda a, b: F.when(a["symbol"] < b["symbol"], -1).when(a["symbol"] > b["symbol"], 1).otherwise(0)
    out = head.select("id", "last_updated", "interval").join(spans)
    hours = F.struct("time_from", "time_to", F.col("date_from").cast("string").alias("date_from"), F.col("date_to").cast("string").alias("date_to"))
    if schedule is not None:
        out = out.join(schedule.agg(F.array_sort(F.collect_list(hours)).alias("market_time")))
    return out.join(entries.agg(F.array_sort(F.collect_list("e"), by_name).alias("symbols")))


def read_enriched(spark: SparkSession, path: str, features: T.StructType) -> dict[str, DataFrame] | None:
    """An enriched dataset: "header" (with ranges and market_time), "instruments" and "bars" with just these features; None without a file."""
    found = read_json(spark, path, enriched_schema(features))
    if found.isEmpty():
        return None
    rows = found.select(F.explode("symbols").alias("s")).select("s.symbol", F.explode("s.historical_prices").alias("b")).select("symbol", "b.*")
    return {"header": found.drop("symbols"), "instruments": instruments(found), "bars": rows.withColumn("datetime", F.try_to_timestamp("datetime"))}


def header(document: DataFrame) -> DataFrame:
    return document.select("id", "last_updated", "last_check", "interval")


def instruments(document: DataFrame) -> DataFrame:
    return document.select(F.explode("symbols").alias("s")).select(*(f"s.{c}" for c in INSTRUMENT))


def bars(document: DataFrame, invalid: DataFrame | None = None) -> DataFrame:
    """(symbol, datetime, prices, volume) of a document, without the symbols in `invalid`; unreadable times are NULL."""
    rows = document.select(F.explode("symbols").alias("s")).select("s.symbol", F.explode("s.historical_prices").alias("b"))
    rows = rows.select("symbol", F.try_to_timestamp("b.datetime").alias("datetime"), *(f"b.{c}" for c in BAR.names[1:]))
    return rows.join(invalid.select("symbol"), "symbol", "left_anti") if invalid is not None else rows


def document(head: DataFrame, about: DataFrame, rows: DataFrame) -> DataFrame:
    """The nested document of a header, instruments and bars: for interchange; tables at rest are Parquet."""
    bar = F.struct(F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("datetime"), *BAR.names[1:])
    history = rows.groupBy("symbol").agg(F.array_sort(F.collect_list(bar)).alias("historical_prices"))
    entries = about.join(history, "symbol", "left").select(F.struct(*INSTRUMENT, "historical_prices").alias("e"))
    return head.join(entries.agg(F.array_sort(F.collect_list("e"), lambda a, b: F.when(a["symbol"] < b["symbol"], -1).otherwise(1)).alias("symbols")))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_bars(rows: DataFrame, path: str) -> None:
    """Bars as Parquet by symbol and year, so that scans of a symbol or a time read its part only."""
    rows.withColumn("year", F.year("datetime")).repartition("symbol", "year").write.mode("overwrite").partitionBy("symbol", "year").parquet(path)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("year")


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)
