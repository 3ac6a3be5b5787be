from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import bars as ops
from barloom.operators import schedule, trading, validate
from barloom.plans import enrich
from barloom.queries import EVENTS, HOLIDAYS, daily
from barloom.functions import temporal
from barloom.sources import dataset, metadata, provider, universe
from barloom.sources.ticks import event_ticks
from barloom.streaming.bars import stream_activity, stream_bars

COLUMNS = "symbol string, datetime timestamp, open double, high double, low double, close double, adj_close double, volume double"


def table(spark, times, symbol="a", **cells):
    base = {"open": 10.0, "high": 12.0, "low": 9.0, "close": 11.0, "adj_close": 11.0, "volume": 5.0} | cells
    return spark.createDataFrame([(symbol, dt.datetime.fromisoformat(t), *base.values()) for t in times], COLUMNS)


def test_resample_keeps_volume_and_range(spark, data):
    ticks = event_ticks(spark, data)
    hours, days = ops.from_ticks(ticks, "hour"), ops.from_ticks(ticks, "day")
    again = ops.resample(hours, F.date_trunc("day", "datetime")).withColumn("datetime", F.date_trunc("day", "datetime"))
    key = ["symbol", "datetime", "open", "high", "low", "close", "volume"]
    assert days.select(key).exceptAll(again.select(key)).isEmpty() and again.count() == days.count()


def test_uneven_days(spark):
    gaps = table(spark, ["2024-01-02T09:30", "2024-01-02T10:30", "2024-01-02T14:30"])
    even = table(spark, ["2024-01-02T09:30", "2024-01-02T10:30", "2024-01-02T11:30"])
    assert [r.spread for r in validate.uneven_days(gaps, 3600).collect()] == [5400] and validate.uneven_days(even, 3600).isEmpty()


def test_missing(spark):
    none = spark.createDataFrame([], "date date")
    seen = table(spark, ["2024-01-01", "2024-01-03"])
    assert [str(r.date) for r in validate.missing_days(seen, none).collect()] == ["2024-01-02"]
    steps = table(spark, ["2024-01-01", "2024-01-07", "2024-01-13"])
    assert [str(r.date) for r in validate.missing_steps(steps, 3, none).collect()] == ["2024-01-04", "2024-01-10"]


@pytest.mark.parametrize("cells, issue", [({"low": 13.0}, "low > high"), ({"high": 9.5}, "high < open"), ({}, None)])
def test_price_range(spark, cells, issue):
    got = [r.issue for r in validate.price_range(table(spark, ["2024-01-01"], **cells)).collect()]
    assert got == ([issue] if issue else [])


def test_price_sign(spark):
    zero = table(spark, ["2024-01-01"], low=0.0, adj_close=0.0)
    assert [r.issue for r in validate.price_sign(zero, raw=True).collect()] == ["low, adj_close"]
    assert validate.price_sign(zero, raw=False).isEmpty()


def test_structure_checks(spark):
    rows = table(spark, ["2024-01-02", "2024-01-01"]).withColumn("pos", F.monotonically_increasing_id()).coalesce(1)
    assert validate.unsorted(rows, "pos").count() == 1
    assert validate.missing_columns(rows.drop("close")) == ["close"]
    holes = rows.withColumn("open", F.lit(None).cast("double"))
    assert [r.issue for r in validate.null_columns(holes).collect()] == ["Null values in: open"]


def test_stale(spark):
    rows = table(spark, ["2024-01-02"], "x").union(table(spark, ["2024-01-10"], "y"))
    names = spark.createDataFrame([("x",), ("y",), ("z",)], "symbol string")
    assert {r.symbol: r.is_stale for r in ops.stale_symbols(names, rows).collect()} == {"x": True, "y": False, "z": True}


def test_reconcile(spark):
    def version(id_, day, payload):
        return spark.createDataFrame([(id_, dt.datetime(2024, 1, day), payload)], "id string, last_updated timestamp, payload string")

    pick = lambda a, b: ops.reconcile(a, b).first().payload
    assert pick(version("a", 1, "l"), version("b", 2, "r")) == "r"
    assert pick(version("a", 2, "l"), version("b", 2, "r")) == "l"
    assert pick(version("a", 1, "l"), version("a", 2, "r")) == "l"
    assert pick(version("a", 1, "l").limit(0), version("b", 2, "r")) == "r"


def test_schedule_of_a_week(spark):
    times = [f"2024-01-{d:02d}T{h:02d}:00" for d in (1, 2, 3, 4, 5, 8, 9, 10, 11, 12) for h in range(9, 16)]
    got = schedule.symbol_summary(table(spark, times), 60)
    assert [(r["from"], r["to"], str(r.date_from), str(r.date_to), r.hours) for r in got.collect()] == [("09:00", "16:00", "2024-01-01", "2024-01-12", 7.0)]
    final = schedule.final_schedule(schedule.consolidated(got))
    assert final.count() == 1
    assert schedule.bars_per_session(table(spark, times)).first().bars_per_session == 7


def test_next_bar(spark):
    from barloom.config import Exchange

    utc = Exchange("X", "UTC", (True,) * 7, ("09:00", "17:00"))
    off = spark.createDataFrame([(dt.date(2024, 1, 2),)], "date date")
    calendar = provider.sessions(spark, utc, "2024-01-01", "2024-01-10", off)
    last = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 16))], "symbol string, last timestamp")
    assert provider.next_bar(last, calendar, 60).first().next == dt.datetime(2024, 1, 3, 9)


def fake_client(symbol, start, end, interval):
    day = start
    if symbol == "bad":
        raise RuntimeError("no such symbol")
    while day <= end:
        yield (day, 1.0, 2.0, 0.5, 1.5, 1.5, 10.0)
        day += dt.timedelta(1)


def test_provider(spark):
    import os
    import sys
    import tempfile

    folder = tempfile.mkdtemp()
    with open(os.path.join(folder, "fake_prices.py"), "w") as f:
        f.write("import datetime as dt\n\n" + __import__("inspect").getsource(fake_client))
    sys.path.insert(0, folder)
    spark.sparkContext.addPyFile(os.path.join(folder, "fake_prices.py"))
    got = provider.read(spark, "fake_prices:fake_client", ["a", "bad"], dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 20), blockdays="7", sleep="0")
    assert got.count() == 20 and got.select("symbol").distinct().count() == 1


def test_dataset_round_trip(spark, tmp_path):
    head = spark.createDataFrame([("id1", "2024-01-01", "2024-01-01", "1h")], "id string, last_updated string, last_check string, interval string")
    about = spark.createDataFrame([("a", *["x"] * 6), ("b", *["y"] * 6)], ", ".join(f"{c} string" for c in dataset.INSTRUMENT))
    rows = table(spark, ["2024-01-01T10:00", "2024-01-01T11:00"])
    path = f"file://{tmp_path}/d"
    dataset.write_json(dataset.document(head, about, rows), path)
    back = dataset.read_json(spark, path)
    assert dataset.header(back).first().id == "id1" and dataset.instruments(back).count() == 2
    assert dataset.bars(back).select("symbol", "datetime", "close").exceptAll(rows.select("symbol", "datetime", "close")).isEmpty()
    assert dataset.bars(back, spark.createDataFrame([("a",)], "symbol string")).isEmpty()
    assert dataset.read_json(spark, f"file://{tmp_path}/none").isEmpty()
    (tmp_path / "bad.json").write_text("{ not json")
    assert dataset.read_json(spark, f"file://{tmp_path}/bad.json").isEmpty()
    assert dataset.delete(spark, path) and not dataset.exists(spark, path)


def test_metadata(spark):
    info = {"sharesOutstanding": "12", "beta": "x", "isOpen": "yes", "officers": "['p', 'q']", "sector": " "}
    rows = spark.createDataFrame([("a", info)], "symbol string, info map<string,string>")
    got = metadata.typed(rows, {"shares_outstanding": "int", "beta": "float", "is_open": "bool", "officers": "list", "sector": "str"}).first()
    assert (got.shares_outstanding, got.beta, got.is_open, got.officers, got.sector) == (12, None, True, ["p", "q"], None)
    assert metadata.describe(rows).first().currency == "USD"


def test_universe(spark):
    got = universe.universe(spark, {"training": ["b", "a"], "correlative": ["a", "x"], "prediction_groups": [{"name": "g", "symbols": ["a"]}]}, ["x"])
    assert got.count() == 4
    assert universe.event_dates('{"fed_event_days": ["2024-02-01", "no", "2024-01-03"]}') == [dt.date(2024, 1, 3), dt.date(2024, 2, 1)]


def test_simulation_measures(spark):
    rows = spark.createDataFrame([("a", dt.date(2024, 1, d), r) for d, r in ((1, 0.1), (2, -0.5), (3, 0.2))], "symbol string, date date, ret double")
    assert trading.growth(rows).first().last_year == pytest.approx(1.1 * 0.5 * 1.2)
    assert trading.drawdown(rows, ["symbol"]).first().max_drawdown == pytest.approx(0.5)
    assert rows.agg(trading.profit_factor()).first()[0] == pytest.approx(0.6)
    lost = rows.union(spark.createDataFrame([("a", dt.date(2024, 1, 4), -1.0)], rows.schema))
    assert trading.growth(lost).first().last_year == 0


def test_columns_and_keys(spark):
    rows = spark.createDataFrame([(1, None, 2.0, "a"), (1, None, 3.0, "a"), (2, None, 2.0, "b")], "c int, n double, v double, s string")
    assert trading.informative_columns(rows, ["c", "n", "v", "s"]) == ["c", "v", "s"]
    assert trading.frequent_keys(rows, "s", 2).count() == 2 and trading.dense_rows(rows, ["c", "n", "v", "s", "c"]).count() == 3


def test_stream_matches_batch(spark, data):
    ticks = event_ticks(spark, data)
    schema = spark.read.parquet(f"{data}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(data)
    stream = stream.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.col("event_id").alias("id"))
    run = stream_bars(stream).writeStream.outputMode("append").format("memory").queryName("t_bars").trigger(availableNow=True).start()
    run.awaitTermination(120)
    got, want = spark.table("t_bars"), stream_bars(ticks)
    assert got.count() > 0 and got.exceptAll(want).isEmpty()
    run = stream_activity(stream).writeStream.outputMode("append").format("memory").queryName("t_act").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert spark.table("t_act").count() > 0


def test_enriched_table(spark, data):
    out = enrich.enrich(daily(spark, data), temporal.dates_table(spark, HOLIDAYS), temporal.dates_table(spark, EVENTS))
    got = out.selectExpr("count(*) n", "sum(cast(atr is null or macd is null or raw.rsi is null as int)) nulls", "min(weekday(datetime)) a", "max(weekday(datetime)) b").first()
    assert got.n > 0 and got.nulls == 0 and (got.a, got.b) == (0, 4)
    assert enrich.skip("a", "a", True, 3, 3, True) and not enrich.skip("a", "b", True, 3, 3, True)


def test_search_over_group_folds(spark, data):
    from barloom.operators import learning

    rows = enrich.window_features(daily(spark, data)).withColumn("target", trading.target(0.05).cast("double")).dropna(subset=["rsi", "target", "williams_r"])
    model = learning.search(rows.select("symbol", "target", "rsi", "williams_r"), ["rsi", "williams_r"], trials=1, folds=2)
    assert model.transform(rows).select("prediction").distinct().count() >= 1


def test_report_names_the_first_issue(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "symbol string")
    none = spark.createDataFrame([], "date date")
    rows = table(spark, ["2024-01-01", "2024-01-03"]).union(table(spark, ["2024-01-02"], "b", low=20.0)).union(table(spark, ["2024-01-02"], "x"))
    got = {r.symbol: r.issue for r in validate.report(names, rows, none, interval_seconds=86400).collect()}
    assert got == {"a": "Missing 1 trading days: ['2024-01-02']", "b": "low > high", "c": "Historical prices are empty", "x": "Symbol not in registry"}


def test_windows_that_end_at_a_time(spark):
    rows = table(spark, [f"2024-01-01T{h:02d}:00" for h in (1, 2, 3, 5, 6, 8, 9)])
    got = [(r.datetime.hour, r.volume) for r in ops.resample_anchored(rows, 180, "2024-01-01T09:00").orderBy("datetime").collect()]
    assert got == [(3, 10.0), (6, 10.0)]
    assert [r.datetime.hour for r in ops.resample_anchored(rows, 180, "2024-01-01T02:00").collect()] == [2]


def test_decisions(spark):
    rows = spark.createDataFrame([("a", 0.3, 0.5), ("b", 0.5, 0.3), ("c", 0.3, 0.3)], "k string, p_down double, p_up double")
    assert [r[0] for r in rows.orderBy("k").select(trading.decision()).collect()] == [trading.UP, trading.DOWN, trading.UP]
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (4, 5, 6, 7)], "d date")
    assert [r[0].day for r in days.orderBy("d").select(trading.next_business_day("d")).collect()] == [5, 8, 8, 8]


def test_first_and_last_ticks_of_equal_times(spark):
    at = dt.datetime(2024, 1, 1, 10)
    rows = [("a", at, 5.0, 9_000_000_000_000_000_003), ("a", at, 1.0, 7), ("a", at, 9.0, -9_000_000_000_000_000_003), ("a", dt.datetime(1960, 1, 1), 3.0, 1), ("a", dt.datetime(1960, 1, 1), 4.0, 2)]
    bars = ops.from_ticks(spark.createDataFrame(rows, "symbol string, ts timestamp, price double, id long")).orderBy("datetime").collect()
    assert [(b.open, b.close) for b in bars] == [(3.0, 4.0), (9.0, 5.0)]
    assert "SortAggregate" not in ops.from_ticks(spark.createDataFrame(rows, "symbol string, ts timestamp, price double, id long"))._jdf.queryExecution().executedPlan().toString()
