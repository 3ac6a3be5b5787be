"""Settings of the indicators, the calendar and the exchanges."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# Scores of candle patterns between 0 (bearish) and 1 (bullish).
SINGLE_SCORES = {
    "shooting_star_bearish": 0.0, "gravestone_doji": 0.05, "hammer_bearish": 0.1, "marubozu_bearish": 0.15, "long_upper_shadow": 0.18,
    "hanging_man": 0.2, "shooting_star_bullish": 0.25, "bearish": 0.3, "spinning_top_bearish": 0.4, "doji": 0.5,
    "spinning_top_bullish": 0.6, "bullish": 0.7, "inverted_hammer": 0.75, "long_lower_shadow": 0.8, "dragonfly_doji": 0.85,
    "marubozu_bullish": 0.9, "hammer_bullish": 1.0,
}
MULTI_SCORES = {
    "bearish_engulfing": 0.0, "evening_star": 0.05, "dark_cloud_cover": 0.1, "three_black_crows": 0.15, "tweezer_top": 0.2,
    "tweezer_bottom": 0.8, "piercing_line": 0.9, "morning_star": 0.95, "three_white_soldiers": 0.98, "bullish_engulfing": 1.0,
}
# Days of history that a first load asks for, by bar interval; weekdays; columns of a bar; features of the model.
FALLBACK_DAYS = {
    "1m": 7, "2m": 59, "5m": 59, "15m": 59, "30m": 59, "60m": 59, "90m": 59, "1h": 729, "1d": 3000, "5d": 3000, "1wk": 3000, "1mo": 3000, "3mo": 3000,
}
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
RAW_COLUMNS = ("datetime", "adj_close", "close", "high", "low", "open", "volume")
MODEL_FEATURES = (
    "atr", "bb_width", "is_fed_event", "is_holiday", "is_post_fed_event", "is_post_holiday", "is_pre_fed_event", "is_pre_holiday", "macd", "obv",
    "price_derivative", "rsi", "smoothed_derivative", "stoch_rsi", "time_of_day", "time_of_month", "time_of_week", "time_of_year",
    "open_close_result", "volume", "williams_r",
)


# Default thresholds of candles and windows of indicators.
@dataclass(frozen=True)
class Candles:
    doji_body: float = 0.1
    doji_lower: float = 0.1
    doji_upper: float = 0.1
    hammer_body: float = 0.3
    hammer_shadow: float = 2.0
    lower_ratio: float = 0.3
    star_body: float = 0.3
    star_shadow: float = 2.0
    upper_ratio: float = 0.3


@dataclass(frozen=True)
class Settings:
    atr_window: int = 14
    bollinger_window: int = 20
    bollinger_sigmas: float = 2.0
    rsi_window: int = 6
    stoch_rsi_window: int = 14
    macd_fast: int = 12
    macd_slow: int = 26
    macd_signal: int = 9
    volume_window: int = 20
    williams_window: int = 14
    derivative_window: int = 5
    correlation_window: int = 5
    rvol_days: int = 20
    event_days: int = 5
    stale_days: int = 7
    cutoff_minutes: int = 75
    history_days: int = 365
    up_threshold: float = 0.4
    down_threshold: float = 0.4
    raw_interval: str = "1h"
    enriched_interval: str = "1d"
    market_tz: str = "America/New_York"
    n_splits: int = 5
    candles: Candles = field(default_factory=Candles)

    def as_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class Exchange:
    """Trading days and session hours ("HH:MM", local time) of an exchange; open = close = "00:00" is all day."""

    code: str
    timezone: str
    days: tuple[bool, ...]
    regular: tuple[str, str]
    pre: tuple[str, str] | None = None
    post: tuple[str, str] | None = None
    country: str = "US"

    def __post_init__(self) -> None:
        if len(self.days) != 7 or not all(isinstance(d, bool) for d in self.days):
            raise ValueError("days are seven booleans, Monday first")
        for part in (self.pre, self.regular, self.post):
            if part is None:
                continue
            for t in part:
                hh, _, mm = t.partition(":")
                if not (len(t) == 5 and hh.isdigit() and mm.isdigit() and int(hh) < 24 and int(mm) < 60):
                    raise ValueError(f"not HH:MM: {t}")
            if part[0] > part[1] and part[1] != "00:00":
                raise ValueError(f"opens after it closes: {part}")
        if self.pre and self.pre[1] != self.regular[0] or self.post and self.post[0] != self.regular[1]:
            raise ValueError("sessions must follow each other")

    def is_trading_day(self, weekday: int) -> bool:
        return self.days[weekday]

    def open_days(self) -> list[str]:
        return [name for name, is_open in zip(WEEKDAYS, self.days, strict=True) if is_open]


_WEEK, _ALL = (True,) * 5 + (False,) * 2, (True,) * 7
_HOURS = {"pre": ("04:00", "09:30"), "regular": ("09:30", "16:00"), "post": ("16:00", "20:00")}
# The exchanges that symbols refer to.
EXCHANGES = {
    "NGM": Exchange("NGM", "America/New_York", _WEEK, **_HOURS),
    "NMS": Exchange("NMS", "America/New_York", _WEEK, **_HOURS),
    "PCX": Exchange("PCX", "America/New_York", _WEEK, **_HOURS),
    "CCC": Exchange("CCC", "UTC", _ALL, ("00:00", "00:00")),
    "CCY": Exchange("CCY", "America/New_York", _WEEK, ("00:00", "00:00")),
}
EXCHANGE_DEFAULT = "NMS"


def exchange(code: str | None) -> Exchange:
    """The exchange of a code; a blank code is the default, an unknown one an error."""
    if not (code or "").strip():
        return EXCHANGES[EXCHANGE_DEFAULT]
    if code not in EXCHANGES:
        raise KeyError(f"unknown exchange {code}")
    return EXCHANGES[code]
