"""The whole feature table: bars -> scaled prices -> indicators, raw and scaled -> trimmed, filtered, aligned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import candles, recursive, temporal
from ..functions import indicators as ind
from ..functions.interval import is_intraday
from ..operators import bars as ops
from ..operators.schedule import bars_per_session
from ..sources.staging import staged

PRICES = ("open", "low", "high", "close", "adj_close")


def scale(bars: DataFrame, ranges: DataFrame) -> DataFrame:
    """bars with scaled_<price> and scaled_volume (0 unless there is volume), by the one row of ranges."""
    out = bars.join(F.broadcast(ranges))
    low, high = F.col("min_price"), F.col("max_price")
    cols = {f"scaled_{c}": ind.min_max(F.col(c), low, high) for c in PRICES}
    cols["scaled_volume"] = F.when(F.col("volume") > 0, ind.min_max(F.col("volume"), F.col("min_volume"), F.col("max_volume"))).otherwise(F.lit(0.0))
    return out.withColumns(cols).drop("min_price", "max_price", "min_volume", "max_volume")


def window_features(bars: DataFrame, s: Settings = Settings()) -> DataFrame:
    """bars with every indicator of fixed frames, over one window; two selects, as some build on others."""
    out = ind.gains_and_losses(bars)
    out = out.withColumns({
        "intraday_return": ind.intraday_return(), "price_change": ind.price_change(), "range": ind.price_range(), "volatility": ind.volatility(),
        "typical_price": ind.typical_price(), "average_price": ind.average_price(), "price_derivative": ind.change("close"),
        "return": ind.pct_change("close"), "overnight_return": ind.overnight_return(), "bb_width": ind.bb_width(s.bollinger_window),
        "__tr": ind.true_range(), "rsi": ind.rsi_from("gain", "loss", s.rsi_window), "__rsi": ind.rsi_from("gain", "loss", s.stoch_rsi_window),
        "bollinger_pct_b": ind.bollinger_pct_b(s.bollinger_window, s.bollinger_sigmas), "williams_r": ind.williams_r(s.williams_window),
        "obv": ind.obv(), "relative_volume": ind.relative_volume(s.volume_window), "volume_change": ind.pct_change("volume"),
    })
    out = out.withColumns({
        "smoothed_derivative": ind.smoothed_derivative(s.derivative_window), "atr": ind.full(F.avg, F.col("__tr"), s.atr_window),
        "stoch_rsi": ind.stoch("__rsi", s.stoch_rsi_window),
    })
    return out.drop("gain", "loss", "__tr", "__rsi")


#: Features that raw and scaled bars have in different forms: name -> (raw, scaled) column.
FORMS = {
    "open_close_result": ("open_close_result", "__result"),
    "candle_pattern": ("candle_pattern", "candle_score"),
    "multi_candle_pattern": ("multi_candle_pattern", "multi_candle_score"),
}


def features(bars: DataFrame, s: Settings = Settings()) -> DataFrame:
    """bars with all features of prices and volumes; those of two forms (FORMS) have both."""
    sessions = bars_per_session(bars).withColumnRenamed("bars_per_session", "__sessions")
    out = window_features(bars, s).withColumns({"open_close_result": ind.open_close_result(False), "__result": ind.open_close_result(True)})
    out = ind.volume_rvol(out.join(sessions, "symbol", "left"), "__sessions", s.rvol_days).withColumnRenamed("volume_rvol", "volume_rvol_20d")
    out = out.withColumn("__n", F.coalesce(F.col("__sessions") * 14, F.lit(14)))
    return candles.with_multi_patterns(recursive.smoothed(out, "__n", 14, s.macd_fast, s.macd_slow, s.macd_signal), s.candles).drop("__n", "__sessions")


def enrich(bars: DataFrame, holidays: DataFrame, events: DataFrame, schedule: DataFrame | None = None, s: Settings = Settings(), trim: bool = True) -> DataFrame:
    """(symbol, datetime, raw: struct of unscaled features, scaled features): workdays in the market, from a common start.

    Raw and scaled bars are two series of one table and go through the same pass; then both meet again by bar.
    Features of the time alone are made once. `trim` drops what precedes a symbol's last incomplete bar.
    """
    bars = staged(bars, "bars")  # read for the ranges too
    table = scale(bars, ops.ranges(bars))
    own = (*PRICES, "volume")
    series = lambda scaled, c: F.struct(F.col("symbol").alias("name"), F.lit(scaled).alias("scaled"), *(F.col(f"scaled_{x}" if scaled else x).alias(x) for x in c))
    both = table.select("datetime", F.explode(F.array(series(False, own), series(True, own))).alias("r"))
    both = both.select(F.struct("r.name", "r.scaled").alias("series"), "datetime", *(f"r.{c}" for c in own))
    key = F.to_json("series", {"ignoreNullFields": "false"})
    done = staged(features(both.withColumn("symbol", key), s), "series")
    names = [c for c in done.columns if c not in ("symbol", "series", "datetime", *(f for pair in FORMS.values() for f in pair))]
    pick = lambda scaled, prefix: done.where(F.col("series.scaled") == scaled).select(
        F.col("series.name").alias("symbol"), "datetime", *(F.col(c).alias(prefix + c) for c in names), *(F.col(pair[scaled]).alias(prefix + c) for c, pair in FORMS.items())
    )
    out = pick(False, "raw__").join(pick(True, ""), ["symbol", "datetime"])
    for raw in (True, False):
        times = temporal.time_fractions(F.col("datetime"), raw=raw)
        out = out.withColumns({("raw__" if raw else "") + c: x for c, x in times.items()})
    for dates, name in ((events, "fed_event"), (holidays, "holiday")):
        out = temporal.event_features(out, dates, name, s.event_days, raw=True)
        out = out.withColumnsRenamed({c: f"raw__{c}" for c in (f"is_{name}", f"is_pre_{name}", f"is_post_{name}")})
        out = out.withColumns({f"is_{name}": F.col(f"raw__is_{name}").cast("double")} | {f"is_{x}_{name}": F.col(f"raw__is_{x}_{name}") / 100 for x in ("pre", "post")})
    if trim:
        ignored = ("volume", "obv", "relative_volume", "volume_change", "volume_rvol_20d")
        out = ops.null_trim(out, (*ignored, *(f"raw__{c}" for c in ignored)))
    out = temporal.is_workday(out, holidays)
    intraday = is_intraday(s.enriched_interval)
    if intraday and schedule is None:
        raise ValueError("bars of less than a day need a schedule")
    out = temporal.market_phase(out, schedule, intraday).where("is_market_time and is_workday")
    out = ops.align_start(staged(out, "features"))  # read for the common start too
    names = [c.removeprefix("raw__") for c in out.columns if c.startswith("raw__")]
    return out.select("symbol", "datetime", F.struct(*(F.col(f"raw__{c}").alias(c) for c in names)).alias("raw"), *names)


def skip(known_id: str | None, raw_id: str | None, same_interval: bool, n_known: int, n_raw: int, is_valid: bool) -> bool:
    """Whether an enriched dataset is up to date: made of this raw one, whole and valid."""
    return known_id is not None and known_id == raw_id and same_interval and n_known == n_raw and is_valid


