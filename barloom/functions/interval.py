"""Interval strings such as 15m, 1hour, 4h, 1d, 1wk, 3mo."""

from __future__ import annotations

import math
import re

# Minutes of each unit; a month counts 30 days, a year 365.
MINUTES = {"min": 1, "m": 1, "hour": 60, "h": 60, "day": 1440, "d": 1440, "week": 10080, "wk": 10080, "month": 43200, "mo": 43200, "year": 525600, "y": 525600}
# Units by length, longest first, with the words that a simplified interval uses for long and short spellings.
_LADDER = [("year", "y"), ("month", "mo"), ("week", "wk"), ("day", "d"), ("hour", "h"), ("min", "m")]
_SHAPE = re.compile(r"(\d+)(min|hour|day|week|month|year|mo|wk|m|h|d|y)")


def parts(interval: str) -> tuple[int, str]:
    found = _SHAPE.fullmatch(interval.strip())
    if not found or not int(found[1]):
        raise ValueError(f"not an interval: {interval!r}")
    return int(found[1]), found[2]


def is_valid(interval: str) -> bool:
    return bool(_SHAPE.fullmatch(interval.strip()))


def to_minutes(interval: str | None) -> int:
    """Minutes of an interval; a blank one has none."""
    if not (interval or "").strip():
        return 0
    n, unit = parts(interval)
    return n * MINUTES[unit]


def simplify(interval: str) -> str:
    """The same length in the largest unit that divides it, in the spelling (long or short) of the one given."""
    minutes, (_, unit) = to_minutes(interval), parts(interval)
    short = all(unit != long for long, _ in _LADDER)
    for long, brief in _LADDER:
        if minutes % MINUTES[long] == 0:
            return f"{minutes // MINUTES[long]}{brief if short else long}"
    return interval


def ratio(a: str, b: str) -> str:
    x, y = to_minutes(a), to_minutes(b)
    g = math.gcd(x, y)
    return f"{x // g}:{y // g}"


def floor_unit(interval: str) -> str:
    """The unit that timestamps are floored to: minutes, hours, or days for anything longer."""
    _, unit = parts(interval)
    return {1: "minute", 60: "hour"}.get(MINUTES[unit], "day")


def is_intraday(interval: str) -> bool:
    return to_minutes(interval) < MINUTES["day"]


def fits(raw: str, enriched: str) -> bool:
    """Whether bars of the raw interval make whole bars of the enriched one."""
    x, y = to_minutes(raw), to_minutes(enriched)
    return 0 < x <= y and y % x == 0


def resolve(settings: dict, key: str, default: str) -> str:
    """The interval under a key, or the default where it is blank or none."""
    found = settings.get(key) or ""
    return found if is_valid(found) else default
