"""Candle patterns of one bar and of three bars as CASE ladders, and their scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MULTI_SCORES, SINGLE_SCORES, Candles
from .indicators import by_time

TINY = 1e-9


def with_shape(bars: DataFrame) -> DataFrame:
    """bars with the parts of a candle, computed once: __body, __up, __lo (shadows) and __pct (body's share of the range)."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    body = F.abs(c - o)
    return bars.withColumns({
        "__body": body, "__up": h - F.greatest(o, c), "__lo": F.least(o, c) - lo, "__pct": body / (h - lo + TINY),
    })


def _top(t: Candles) -> Column:
    """A spinning top, either way."""
    body, up, lo, pct = (F.col(f"__{x}") for x in ("body", "up", "lo", "pct"))
    return (pct > t.doji_body) & (pct < t.hammer_body) & (F.least(up, lo) / (body + TINY) > 1)


def pattern(t: Candles = Candles()) -> Column:
    """The first pattern that holds; needs `with_shape`."""
    o, c = F.col("open"), F.col("close")
    body, up, lo, pct = (F.col(f"__{x}") for x in ("body", "up", "lo", "pct"))
    rise, fall = c > o, c < o
    long_up, long_lo = up > t.star_shadow * body, lo > t.hammer_shadow * body
    no_up, no_lo = up < t.upper_ratio * body, lo < t.lower_ratio * body
    top = _top(t)
    ladder = [
        ("dragonfly_doji", (pct < t.doji_body) & long_lo & (up < t.doji_upper)),
        ("gravestone_doji", (pct < t.doji_body) & long_up & (lo < t.doji_lower)),
        ("inverted_hammer", rise & long_up & no_lo & (pct < t.star_body)),
        ("hanging_man", fall & long_lo & no_up & (pct < t.hammer_body)),
        ("hammer_bullish", rise & long_lo & no_up & (pct < t.hammer_body)),
        ("shooting_star_bearish", fall & long_up & no_lo & (pct < t.star_body)),
        ("marubozu_bullish", rise & no_up & no_lo),
        ("marubozu_bearish", fall & no_up & no_lo),
        ("spinning_top_bullish", rise & top),
        ("spinning_top_bearish", fall & top),
        ("doji", pct < t.doji_body),
        ("long_upper_shadow", up > t.star_shadow * body),
        ("long_lower_shadow", lo > t.hammer_shadow * body),
        ("bullish", rise),
    ]
    out = F.when(F.lit(False), F.lit(""))
    for name, holds in ladder:
        out = out.when(holds, F.lit(name))
    out = out.otherwise(F.lit("bearish"))
    known = o.isNotNull() & c.isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull()
    return F.when(known, out)


def score_of(name: Column, scores: dict[str, float]) -> Column:
    return F.create_map(*(F.lit(x) for kv in scores.items() for x in kv))[name]


def with_patterns(bars: DataFrame, t: Candles = Candles()) -> DataFrame:
    """bars with "candle_pattern" and "candle_score"."""
    out = with_shape(bars).withColumn("candle_pattern", pattern(t))
    return out.withColumn("candle_score", score_of(F.col("candle_pattern"), SINGLE_SCORES))


def with_multi_patterns(bars: DataFrame, t: Candles = Candles()) -> DataFrame:
    """bars with "multi_candle_pattern" ("" if none; NULL on a symbol's first two bars) and "multi_candle_score".

    The score is the pattern's, else the mean of the three bars' scores, mapped into the patterns' range.
    """
    rows = with_patterns(bars, t)
    rows = rows.withColumn("__soft", (F.col("__pct") < t.doji_body) | _top(t))
    lagged = {f"__{x}{k}": F.lag(x, k).over(by_time()) for k in (1, 2) for x in ("open", "high", "low", "close", "__body", "__up", "__soft", "candle_pattern", "candle_score")}
    rows = rows.withColumns(lagged)
    col = lambda x, k=0: F.col(x if not k else f"__{x}{k}")
    o, h, lo, c, name = ([col(x, k) for k in (0, 1, 2)] for x in ("open", "high", "low", "close", "candle_pattern"))
    middle = [(a + b) / 2 for a, b in zip(o, c, strict=True)]
    rise, fall = ([x > y for x, y in zip(*v, strict=True)] for v in ((c, o), (o, c)))
    is_bull = [n.isin("bullish", "marubozu_bullish") for n in name]
    is_bear = [n.isin("bearish", "marubozu_bearish") for n in name]
    soft_bear, soft_bull = name[1].isin("bearish", "marubozu_bearish", "spinning_top_bearish"), name[1].isin("bullish", "marubozu_bullish", "spinning_top_bullish")
    small_up = [col("__up", k) < 0.5 * col("__body", k) for k in (0, 1, 2)]
    small_lo = [F.least(o[k], c[k]) - lo[k] < 0.5 * col("__body", k) for k in (0, 1, 2)]
    rising = (o[0] > o[1]) & (o[1] > o[2]) & (c[0] > c[1]) & (c[1] > c[2])
    falling = (o[0] < o[1]) & (o[1] < o[2]) & (c[0] < c[1]) & (c[1] < c[2])
    every = lambda x: x[0] & x[1] & x[2]
    ladder = [
        ("bullish_engulfing", soft_bear & is_bull[0] & (o[0] < c[1]) & (c[0] > o[1])),
        ("bearish_engulfing", soft_bull & is_bear[0] & (o[0] > c[1]) & (c[0] < o[1])),
        ("morning_star", is_bear[2] & col("__soft", 1) & is_bull[0] & (c[0] > middle[2])),
        ("evening_star", is_bull[2] & col("__soft", 1) & is_bear[0] & (c[0] < middle[2])),
        ("piercing_line", fall[1] & rise[0] & (o[0] < lo[1]) & (c[0] > middle[1]) & (c[0] < o[1])),
        ("dark_cloud_cover", rise[1] & fall[0] & (o[0] > h[1]) & (c[0] > o[1]) & (c[0] < middle[1])),
        ("tweezer_bottom", fall[1] & rise[0] & (F.abs(lo[0] - lo[1]) < 1e-3)),
        ("tweezer_top", rise[1] & fall[0] & (F.abs(h[0] - h[1]) < 1e-3)),
        ("three_white_soldiers", every(rise) & rising & every(small_up)),
        ("three_black_crows", every(fall) & falling & every(small_lo)),
    ]
    out = F.when(name[2].isNull() | name[1].isNull() | name[0].isNull(), F.lit(None).cast("string"))
    for label, holds in ladder:
        out = out.when(holds, F.lit(label))
    rows = rows.withColumn("multi_candle_pattern", out.otherwise(F.lit("")))
    low, high = min(MULTI_SCORES.values()) + 1e-6, max(MULTI_SCORES.values()) - 1e-6
    mean = (F.col("candle_score") + F.col("__candle_score1") + F.col("__candle_score2")) / 3
    blend = F.round(F.lit(low) + mean * (high - low), 3)
    known = score_of(F.col("multi_candle_pattern"), MULTI_SCORES)
    rows = rows.withColumn("multi_candle_score", F.when(F.col("multi_candle_pattern").isNotNull(), F.coalesce(known, blend)))
    return rows.drop(*lagged, "__soft", "__body", "__up", "__lo", "__pct")
