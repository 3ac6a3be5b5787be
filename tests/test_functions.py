from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom import config
from barloom.functions import candles, interval, recursive, temporal
from barloom.functions import indicators as ind

DAY = dt.datetime(2024, 1, 1)


def bars(spark, closes, volumes=None, symbol="a"):
    rows = [(symbol, DAY + dt.timedelta(k), float(c), c + 1.0, c - 1.0, float(c), float(c), float(v)) for k, (c, v) in enumerate(zip(closes, volumes or [1] * len(closes)))]
    return spark.createDataFrame(rows, "symbol string, datetime timestamp, open double, high double, low double, close double, adj_close double, volume double")


def column(df, name):
    return [r[0] for r in df.orderBy("datetime").select(name).collect()]


CLOSES = [10.0, 11.0, 12.0, 11.0, 13.0, 14.0, 13.0, 15.0]


def test_rsi(spark):
    out = ind.gains_and_losses(bars(spark, CLOSES)).withColumn("x", ind.rsi_from("gain", "loss", 6))
    assert column(out, "x") == [None] * 5 + [pytest.approx(v, abs=1e-6) for v in (83.333333, 71.428571, 75)]


def test_rsi_without_losses_and_without_changes(spark):
    rising = ind.gains_and_losses(bars(spark, [1.0, 2, 3, 4, 5, 6])).withColumn("x", ind.rsi_from("gain", "loss", 6))
    flat = ind.gains_and_losses(bars(spark, [1.0] * 6)).withColumn("x", ind.rsi_from("gain", "loss", 6))
    assert column(rising, "x")[-1] == 100 and column(flat, "x")[-1] is None


def test_atr_and_williams(spark):
    table = bars(spark, CLOSES)
    atr = table.withColumn("tr", ind.true_range()).withColumn("x", ind.full(F.avg, F.col("tr"), 3))
    assert column(atr, "x")[1:] == [None] + [pytest.approx(v, abs=1e-6) for v in (2, 2, 2.333333, 2.333333, 2.333333, 2.333333)]
    assert column(table.withColumn("x", ind.williams_r(3)), "x")[2:] == [pytest.approx(v, abs=1e-6) for v in (-25, -66.666667, -25, -20, -66.666667, -25)]


def test_volume_repair(spark):
    assert column(ind.repair_volume(bars(spark, CLOSES[:6], [0, 0, 100, 0, 300, 0])), "volume") == [100, 100, 100, 200, 300, 300]
    assert column(ind.repair_volume(bars(spark, CLOSES[:2], [0, 0])), "volume") == [None, None]


@pytest.mark.parametrize("block", [2, 3, 4096])
def test_scan_in_blocks(spark, block):
    out = recursive.scan(bars(spark, CLOSES), {"x": ("close", F.lit(0.5))}, block=block)
    assert column(out, "x") == [pytest.approx(v, abs=1e-6) for v in (10, 10.5, 11.25, 11.125, 12.0625, 13.03125, 13.015625, 14.007812)]


def test_scan_skips_nulls(spark):
    table = bars(spark, CLOSES).withColumn("v", F.when(F.dayofmonth("datetime").isin(1, 4), None).otherwise(F.col("close")))
    for block in (2, 100):
        out = column(recursive.scan(table, {"x": ("v", F.lit(0.5))}, block=block), "x")
        assert out == [None, 11, 11.5, 11.5, 12.25, 13.125, 13.0625, 14.03125]


CASES = [
    ((100, 100.05, 90, 100.02), "dragonfly_doji"), ((100, 110, 99.95, 100.02), "gravestone_doji"), ((100, 110, 99.5, 102), "inverted_hammer"),
    ((102, 102.5, 92, 100), "hanging_man"), ((100, 102.5, 92, 102), "hammer_bullish"), ((102, 110, 99.5, 100), "shooting_star_bearish"),
    ((100, 112, 99, 110), "marubozu_bullish"), ((110, 111, 98, 100), "marubozu_bearish"), ((100, 105, 95, 102), "spinning_top_bullish"),
    ((102, 107, 97, 100), "spinning_top_bearish"), ((100, 105, 95, 100.5), "doji"), ((100, 110, 99, 102), "long_upper_shadow"),
    ((100, 103, 92, 102), "long_lower_shadow"), ((100, 112, 94, 110), "bullish"), ((110, 116, 94, 100), "bearish"), ((100, 100, 100, 100), "doji"),
]


def test_candles(spark):
    rows = [(str(k), DAY, *map(float, v)) for k, (v, _) in enumerate(CASES)]
    table = spark.createDataFrame(rows, "symbol string, datetime timestamp, open double, high double, low double, close double")
    got = {r.symbol: r.candle_pattern for r in candles.with_patterns(table).collect()}
    assert [got[str(k)] for k in range(len(CASES))] == [name for _, name in CASES]


THREE = [
    ([(110, 111, 98, 100), (110, 111, 98, 100), (99, 113, 98, 112)], "bullish_engulfing"),
    ([(100, 112, 99, 110), (100, 112, 99, 110), (111, 112, 97, 98)], "bearish_engulfing"),
    ([(110, 111, 98, 100), (99, 104, 94, 99.5), (100, 112, 99.5, 110)], "morning_star"),
    ([(100, 112, 99, 110), (111, 116, 106, 111.5), (110, 110.5, 98, 100)], "evening_star"),
    ([(100, 112, 99, 110), (110, 111, 98, 100), (97, 107, 96, 106)], "piercing_line"),
    ([(110, 111, 98, 100), (100, 112, 99, 110), (113, 114, 103, 104)], "dark_cloud_cover"),
    ([(100, 112, 99, 110), (110, 111, 98, 100), (100, 105, 98, 104)], "tweezer_bottom"),
    ([(100, 112, 99, 110), (100, 112, 99, 110), (110, 112, 104, 105)], "tweezer_top"),
    ([(100, 111, 99, 110), (102, 113, 101, 112), (104, 115, 103, 114)], "three_white_soldiers"),
    ([(114, 115, 103, 104), (112, 113, 101, 102), (110, 111, 99, 100)], "three_black_crows"),
    ([(100, 112, 99, 110), (100, 112, 99, 110), (100, 112, 99, 110)], ""),
]


def test_multi_candles(spark):
    rows = [(str(k), DAY + dt.timedelta(i), *map(float, v)) for k, (three, _) in enumerate(THREE) for i, v in enumerate(three)]
    table = spark.createDataFrame(rows, "symbol string, datetime timestamp, open double, high double, low double, close double")
    got = {(r.symbol, r.datetime.day): (r.multi_candle_pattern, r.multi_candle_score) for r in candles.with_multi_patterns(table).collect()}
    assert [got[str(k), 3][0] for k in range(len(THREE))] == [name for _, name in THREE]
    assert got["0", 1] == (None, None) and got["0", 3][1] == 1.0 and got["10", 3][1] == pytest.approx(0.9)


@given(st.integers(1, 500), st.sampled_from(sorted(interval.MINUTES)))
def test_intervals(n, unit):
    text = f"{n}{unit}"
    assert interval.to_minutes(text) == interval.to_minutes(interval.simplify(text)) == n * interval.MINUTES[unit]


def test_interval_examples():
    assert [interval.to_minutes(x) for x in ("60min", "120m", "1440min", "", None)] == [60, 120, 1440, 0, 0]
    assert (interval.simplify("60min"), interval.simplify("120m"), interval.ratio("90min", "30min")) == ("1hour", "2h", "3:1")
    assert interval.floor_unit("15m") == "minute" and interval.floor_unit("4h") == "hour" and interval.floor_unit("1wk") == "day"
    assert interval.fits("1h", "1d") and not interval.fits("1d", "1h") and not interval.fits("7h", "1d")
    assert not interval.is_valid("1x")
    with pytest.raises(ValueError):
        interval.to_minutes("0m")


def test_exchanges():
    assert config.exchange("").code == "NMS" and config.exchange("CCC").open_days()[-1] == "sunday"
    with pytest.raises(KeyError):
        config.exchange("XXX")
    with pytest.raises(ValueError):
        config.Exchange("X", "UTC", (True,) * 7, ("10:00", "09:00"))
    with pytest.raises(ValueError):
        config.Exchange("X", "UTC", (True,) * 7, ("09:30", "16:00"), pre=("04:00", "09:00"))


def test_holidays():
    got = temporal.us_holidays(2021, 2024)
    for d in ("2024-01-15", "2024-11-28", "2021-07-05", "2021-12-24", "2022-06-20", "2024-05-27"):
        assert dt.date.fromisoformat(d) in got
    assert dt.date(2024, 6, 18) not in got


def test_event_decay_farthest_and_nearest(spark):
    table, days = bars(spark, CLOSES), temporal.dates_table(spark, [dt.date(2024, 1, 4), dt.date(2024, 1, 6)])
    far = temporal.event_features(table, days, "e")
    near = temporal.event_features(table, days, "e", nearest=True)
    assert column(far, "is_pre_e")[:3] == [0.2, 0.4, 0.6] and column(near, "is_pre_e")[:3] == [0.6, 0.8, 1.0]
    assert column(far, "is_e") == [0, 0, 0, 1, 0, 1, 0, 0] and column(far, "is_post_e")[-1] == pytest.approx(0.4)
