"""Datasets at rest, providers that fail, shapes of tables, measures of simulations, samples and models."""

from __future__ import annotations

import datetime as dt
import json
import logging

import pytest
from pyspark.sql import functions as F

from barloom.functions import recursive, temporal
from barloom.operators import bars as ops
from barloom.operators import learning, trading, validate
from barloom.plans import enrich
from barloom.queries import EVENTS, HOLIDAYS, daily, hourly
from barloom.sources import dataset, provider, universe

NOW = "2024-01-12 00:00:00"
BARS = [{"datetime": f"2024-01-0{k}T00:00:00+00:00", "adj_close": 1.0, "close": 1.0, "high": 2.0, "low": 0.5, "open": 1.0, "volume": v} for k, v in ((1, 100.0), (2, 0.0), (3, 300.0))]


def saved(path, **fields):
    path.write_text(json.dumps(fields))
    return str(path)


def test_raw_dataset_is_completed(spark, tmp_path):
    fresh = [BARS[0] | {"datetime": "2024-01-10T00:00:00+00:00"}]
    symbols = [{"symbol": "old", "historical_prices": BARS}, {"symbol": "new", "historical_prices": fresh}, {"symbol": "bad", "historical_prices": BARS}, {"symbol": "none", "historical_prices": []}]
    invalid = spark.createDataFrame([("bad",)], "symbol string")
    got = dataset.load_raw(spark, saved(tmp_path / "a.json", id="  ", symbols=symbols), NOW, invalid, new_id="n1")
    head = got["header"].first()
    assert (head.id, str(head.last_updated), str(head.last_check)) == ("n1", NOW, NOW)
    assert [r.volume for r in got["bars"].where("symbol = 'old'").orderBy("datetime").collect()] == [100.0, 200.0, 300.0]
    assert {r.symbol for r in got["instruments"].collect()} == {"old", "new", "none"} and {r.symbol for r in got["stale"].collect()} == {"none"}
    got = dataset.load_raw(spark, saved(tmp_path / "b.json", id=" x ", last_check="2024-01-05T00:00:00", symbols=[]), NOW, new_id="n2")
    head = got["header"].first()
    assert (head.id, str(head.last_updated)) == ("x", "2024-01-05 00:00:00") and got["bars"].isEmpty()
    for path in (str(tmp_path / "absent.json"), saved(tmp_path / "c.json")):
        got = dataset.load_raw(spark, path, NOW)
        assert len(got["header"].first().id) == 32 and got["bars"].isEmpty() and got["instruments"].isEmpty()


def test_enriched_dataset_round_trip(spark, data, tmp_path):
    rows = enrich.enrich(daily(spark, data), temporal.dates_table(spark, HOLIDAYS), temporal.dates_table(spark, EVENTS))
    rows = rows.select("symbol", "datetime", F.struct("raw.close", "raw.candle_pattern").alias("raw"), "close", "rsi", "candle_pattern")
    head = spark.createDataFrame([("e1", "2024-01-01T00:00:00", "1d")], "id string, last_updated string, interval string")
    about = rows.select("symbol").distinct().select("symbol", *(F.lit(None).cast("string").alias(c) for c in dataset.INSTRUMENT[1:]))
    hours = spark.createDataFrame([("09:30", "16:00", dt.date(2024, 1, 1), dt.date(2024, 6, 1))], "time_from string, time_to string, date_from date, date_to date")
    dataset.write_json(dataset.enriched_document(head, ops.ranges(daily(spark, data)), hours, about, rows), str(tmp_path / "e"))
    allowed = rows.drop("rsi").schema
    got = dataset.read_enriched(spark, str(tmp_path / "e"), allowed)
    first = got["header"].first()
    assert (first.id, first.interval, first.market_time[0].time_to) == ("e1", "1d", "16:00") and first.ranges.price.max > first.ranges.price.min
    assert got["bars"].columns == ["symbol", "datetime", "raw", "close", "candle_pattern"]
    assert got["bars"].exceptAll(rows.drop("rsi")).isEmpty() and got["bars"].count() == rows.count()
    assert dataset.read_enriched(spark, str(tmp_path / "nothing"), allowed) is None


def test_tables_at_rest(spark, data, tmp_path):
    rows = hourly(spark, data).withColumn("symbol", F.concat("symbol", F.lit("/")))
    dataset.write_bars(rows, str(tmp_path / "bars"))
    again = dataset.read_bars(spark, str(tmp_path / "bars")).select(*rows.columns)
    assert again.exceptAll(rows).isEmpty() and again.count() == rows.count()
    dataset.write_csv(rows.select("symbol", "close"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == rows.count()


def broken_client(symbol, start, end, interval):
    if symbol == "bad":
        raise OSError("no line")
    return [(start, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]


def test_blocks_that_fail(caplog):
    at = dt.datetime(2024, 1, 1)
    options = {"client": "tests.test_datasets:broken_client" if __name__.startswith("tests.") else f"{__name__}:broken_client", "symbols": "ok,bad", "start": at.isoformat(), "end": dt.datetime(2024, 1, 3).isoformat(), "retries": "2", "sleep": "0"}
    with caplog.at_level(logging.WARNING):
        got = [list(provider.PriceReader(options).read(p)) for p in provider.PriceReader(options).partitions()]
    assert [len(x) for x in got] == [1, 0] and "bad" in caplog.text and "attempt 2 of 2" in caplog.text
    reader = provider.PriceReader(options | {"onerror": "fail"})
    with pytest.raises(RuntimeError, match="bad"):
        list(reader.read(reader.partitions()[1]))


def test_next_bar_between_and_before_sessions(spark):
    at = lambda s: dt.datetime.fromisoformat(s)
    days = [(at(f"2024-01-0{k}T09:00"), at(f"2024-01-0{k}T17:00")) for k in (2, 4, 5)] + [(at("2024-01-08T22:00"), at("2024-01-09T21:59"))]
    calendar = spark.createDataFrame([(o.date(), o, c) for o, c in days], "date date, open timestamp, close timestamp")
    last = {"before": "2023-12-20T10:00", "inside": "2024-01-02T11:00", "end": "2024-01-02T16:00", "gap": "2024-01-05T16:30", "night": "2024-01-09T03:00", "after": "2024-01-09T21:00"}
    rows = spark.createDataFrame([(k, at(v)) for k, v in last.items()], "symbol string, last timestamp")
    got = {r.symbol: r.next for r in provider.next_bar(rows, calendar, 60).collect()}
    assert got == {"before": at("2024-01-02T09:00"), "inside": at("2024-01-02T12:00"), "end": at("2024-01-04T09:00"), "gap": at("2024-01-08T22:00"), "night": at("2024-01-09T04:00")}
    assert provider.next_bar(rows.limit(0), calendar, 60).isEmpty() and provider.next_bar(rows, calendar.limit(0), 60).isEmpty()


def test_structure(spark):
    good = spark.createDataFrame([], "symbol string, datetime timestamp, adj_close double, close double, high double, low double, open double, volume double")
    assert validate.structure(good) == []
    assert validate.structure(good.drop("low", "open")) == ["Missing columns: low, open"]
    assert validate.structure(good.select("*", F.lit(1).alias("Low"))) == ["Duplicate columns: low"]
    assert validate.structure(good.withColumn("close", F.lit("x")).withColumn("datetime", F.lit("x"))) == ["Wrong types: datetime (string), close (string)"]
    assert validate.structure(spark.createDataFrame([], "")) == ["No columns"]


def returns(spark, *values):
    return spark.createDataFrame([("a", dt.date(2024, 1, 1) + dt.timedelta(k), float(r)) for k, r in enumerate(values)], "symbol string, date date, ret double")


@pytest.mark.parametrize("values, want", [((0.5, -1, 0.1), 1.0), ((0.5, -2, 0.1), 1.0), ((-1,), 1.0), ((0.1, 0.2), 0.0), ((1, -0.5, -0.5), 0.75)])
def test_drawdown_with_a_total_loss(spark, values, want):
    assert trading.drawdown(returns(spark, *values), ["symbol"]).first().max_drawdown == pytest.approx(want)


def test_growth_by_key(spark):
    both = returns(spark, 0.5, -0.5).union(returns(spark, 0.1, -1).withColumn("symbol", F.lit("b")))
    got = {r.symbol: r.last_year for r in trading.growth(both, ["symbol"]).collect()}
    assert got == {"a": pytest.approx(0.75), "b": 0}


@pytest.mark.parametrize("parts", [1, 7])
def test_undersampling_is_exact_and_the_same_however_rows_are_dealt(spark, monkeypatch, parts):
    monkeypatch.setattr(trading, "PARTS", 16)
    rows = spark.range(1000).select("id", F.when(F.col("id") < 700, "x").when(F.col("id") < 950, "y").otherwise("z").alias("k"), F.lit(1).alias("same"))
    rows = rows.union(spark.createDataFrame([(5000, None, 1)], "id long, k string, same int"))
    got = trading.undersample(rows.repartition(parts), "k")
    assert {r["k"]: r["count"] for r in got.groupBy("k").count().collect()} == {"x": 50, "y": 50, "z": 50}
    assert got.columns == rows.columns and got.exceptAll(trading.undersample(rows.repartition(3), "k")).isEmpty()
    equal = spark.createDataFrame([("x", 1)] * 9 + [("y", 1)] * 4, "k string, v int")
    assert {r["k"]: r["count"] for r in trading.undersample(equal, "k").groupBy("k").count().collect()} == {"x": 4, "y": 4}


def test_as_of_takes_the_last_row_up_to_a_date(spark):
    at = dt.datetime.fromisoformat
    rows = spark.createDataFrame([("a", at("2024-01-01T10:00"), 1), ("a", at("2024-01-03T10:00"), 2), ("a", at("2024-01-03T11:00"), 3), ("b", at("2024-01-09T00:00"), 4)], "symbol string, datetime timestamp, v int")
    dates = spark.createDataFrame([(s, dt.date(2024, 1, k)) for s in "abc" for k in (1, 2, 3, 5)], "symbol string, date date")
    got = {(r.symbol, r.date.day): r.r.v for r in trading.as_of(rows, dates).collect()}
    assert got == {("a", 1): 1, ("a", 2): 1, ("a", 3): 3, ("a", 5): 3}


def test_names_and_calendars(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,)], "t int").orderBy("t")
    assert [r[0] for r in rows.select(trading.direction_name("t")).collect()] == ["DOWN", "NEUTRAL", "UP"]
    got = universe.market_calendar(spark, 2024, [dt.date(2024, 1, 31)], years=2)
    assert {r.date for r in got["events"].collect()} == {dt.date(2024, 1, 31)}
    days = {r.date for r in got["holidays"].collect()}
    assert {dt.date(2023, 7, 4), dt.date(2024, 12, 25), dt.date(2024, 11, 28)} <= days and min(days).year >= 2022


def test_boosted_models_at_rest(spark, tmp_path):
    rows = spark.createDataFrame([(float(k % 3), float(k % 3) + (k % 7) / 100, "s" if k % 2 else "t") for k in range(90)], "target double, x double, s string")
    model = learning.fit(rows, ["x"], ["s"], boosted=True, maxIter=3)
    learning.save(model, str(tmp_path / "m"))
    again = learning.load(str(tmp_path / "m"))
    assert [r.prediction for r in again.transform(rows).select("prediction").collect()] == [r.target for r in rows.collect()]


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_means_in_parts(block):
    """A running mean is the same in parts of any length, with missing values anywhere."""
    import numpy as np

    r = np.random.default_rng(1)
    x = np.where(r.random(1000) < 0.2, np.nan, r.normal(size=1000))
    for factor, seed in ((0.3, 1), (1 / 14, 14), (0.001, 300), (0.5, 5000)):
        want, seen, total, y = [], 0, 0.0, float("nan")
        for v in x:
            if v == v:
                seen += 1
                total += v
                y = total / seed if seen == seed else y + factor * (v - y) if seen > seed else float("nan")
            want.append(y)
        mean = recursive.Mean(factor, seed)
        got = np.concatenate([mean.add(x[k : k + block]) for k in range(0, len(x), block)])
        assert np.allclose(got, want, rtol=1e-11, atol=1e-12, equal_nan=True)


def test_search_goes_where_scores_promise_most():
    """A smooth score over the settings: five trials come closer to its top than the average of all settings."""
    score = lambda s: -(((s[0] - 7) / 5) ** 2) - ((s[1] - 30) / 30) ** 2
    gaps = []
    for seed in range(20):
        tried = {}
        for _ in range(8):
            s = learning._next_setting(tried, seed)
            assert s in learning.SPACE and s not in tried
            tried[s] = score(s)
        gaps.append(-max(tried.values()))
    assert sum(gaps) / len(gaps) < 0.02 and learning._next_setting({(3, 10): 0.5, (8, 40): 0.5}, 1) in learning.SPACE
