"""Exponential and Wilder smoothing: linear recurrences, run over each symbol's bars in order.

The bars are dealt by symbol and sorted, as the windows of all other indicators need them too, and go through in batches:
what a recurrence keeps from one batch to the next are a few numbers, so a task's memory doesn't grow with a symbol's history,
and recurrences of recurrences (MACD's signal, ADX) need no second pass. Inside a batch they are matrix products.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .indicators import by_time, true_range, whole_days

#: Bars that are smoothed at once.
BLOCK = 4096
_STEP = 128


@lru_cache(maxsize=256)
def _kernel(a: float) -> tuple[np.ndarray, np.ndarray]:
    """What _STEP inputs add to the _STEP outputs after them, and how much of the state before is left in each."""
    decay = (1 - a) ** np.arange(_STEP + 1)
    i = np.arange(_STEP)
    lag = i[:, None] - i
    return np.where(lag >= 0, a * decay[np.maximum(lag, 0)], 0.0), decay[1:]


def _smooth(x: np.ndarray, a: float, y: float) -> np.ndarray:
    """y = (1 - a) * y + a * x, from the state y on."""
    own, left = _kernel(a)
    out = np.empty(len(x))
    whole = len(x) // _STEP * _STEP
    added = x[:whole].reshape(-1, _STEP) @ own.T
    for k, row in enumerate(added):
        out[k * _STEP : (k + 1) * _STEP] = row + left * y
        y = out[(k + 1) * _STEP - 1]
    rest = len(x) - whole
    if rest:
        out[whole:] = own[:rest, :rest] @ x[whole:] + left[:rest] * y
    return out


@dataclass
class Mean:
    """A running mean: it starts with the plain mean of the first `seed` values; missing ones leave it as it is."""

    factor: float
    seed: int = 1
    seen: int = 0
    total: float = 0.0
    value: float = float("nan")

    def add(self, x: np.ndarray) -> np.ndarray:
        """The mean after each of x, in parts of any length; not a number: missing, or no mean yet."""
        known = ~np.isnan(x)
        values, start = x[known], self.value
        y = np.full(len(values), np.nan)
        k = min(max(0, self.seed - self.seen), len(values))
        if k:
            self.total += float(values[:k].sum())
            self.seen += k
            if self.seen == self.seed:
                self.value = y[k - 1] = self.total / self.seed
        if len(values) > k:
            y[k:] = _smooth(values[k:], self.factor, self.value)
            self.value = float(y[-1])
        return np.concatenate([[start], y])[np.cumsum(known)]


def _by_symbol(rows: DataFrame, names: list[str], make: Callable[[dict[str, np.ndarray]], Callable], inputs: list[str], block: int) -> DataFrame:
    """rows with the columns `names`; make: a symbol's first inputs -> a function of inputs, batch after batch, to those columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, step, started = None, None, False
        for whole in batches:
            for lo in range(0, whole.num_rows, block):
                batch = whole.slice(lo, block)
                symbols = batch["symbol"].to_pylist()
                cuts = [0, *(k for k in range(1, len(symbols)) if symbols[k] != symbols[k - 1]), len(symbols)]
                values = {c: batch[c].cast(pa.float64()).to_numpy(zero_copy_only=False) for c in inputs}
                out: dict[str, list] = {c: [] for c in names}
                for s, e in zip(cuts, cuts[1:]):
                    part = {c: v[s:e] for c, v in values.items()}
                    if not started or symbols[s] != now:
                        now, step, started = symbols[s], make(part), True
                    for c, y in step(part).items():
                        out[c].append(y)
                added = [np.concatenate(out[c]) for c in names]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(y, pa.float64(), mask=np.isnan(y)) for y in added)], [*batch.schema.names, *names])

    result = T.StructType([*rows.schema.fields, *(T.StructField(c, T.DoubleType()) for c in names)])
    return rows.repartition("symbol").sortWithinPartitions("symbol", "datetime").mapInArrow(run, result)


def scan(bars: DataFrame, inputs: dict[str, tuple[str, Column]], block: int = BLOCK) -> DataFrame:
    """bars with a column for each of inputs: name -> (input column, factor a).

    A series starts at its first non-null input with that value; later nulls leave the value as it is. The factor
    must be the same for all bars of a symbol.
    """
    rows = bars.withColumns({f"__a_{k}": a.cast("double") for k, (_, a) in inputs.items()})
    sources = {k: x for k, (x, _) in inputs.items()}

    def make(first: dict[str, np.ndarray]):
        means = {k: Mean(float(first[f"__a_{k}"][0])) for k in sources}
        return lambda part: {k: means[k].add(part[x]) for k, x in sources.items()}

    out = _by_symbol(rows, list(sources), make, sorted({*sources.values(), *(f"__a_{k}" for k in sources)}), block)
    return out.drop(*(f"__a_{k}" for k in sources))


@dataclass
class Smoother:
    """MACD's histogram, Wilder's mean true range and average directional index of one symbol, batch after batch."""

    wanted: tuple[str, ...]
    window: float
    spans: tuple[int, int, int]

    def __post_init__(self):
        self.fast, self.slow, self.signal = (Mean(2 / (n + 1)) for n in self.spans)
        n = int(self.window) if self.window >= 1 else 0  # not a number: no window, and no value
        self.tr, self.up, self.down, self.dx = (Mean(1 / max(n, 1), n if n else 1 << 60) for _ in range(4))

    def __call__(self, part: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        out = {}
        if "macd" in self.wanted:
            line = self.fast.add(part["close"]) - self.slow.add(part["close"])
            out["macd"] = line - self.signal.add(line)
        if "atr_14d" in self.wanted or "adx_14d" in self.wanted:
            atr = out["atr_14d"] = self.tr.add(part["__tr"])
        if "adx_14d" in self.wanted:
            ratio = lambda a, b: np.divide(a, b, out=np.full(len(a), np.nan), where=~np.isnan(b) & (b != 0))
            plus, minus = 100 * ratio(self.up.add(part["__up"]), atr), 100 * ratio(self.down.add(part["__down"]), atr)
            out["adx_14d"] = self.dx.add(100 * ratio(np.abs(plus - minus), plus + minus))
        return {c: out[c] for c in self.wanted}


def smoothed(bars: DataFrame, window: str | None, days: int = 14, fast: int = 12, slow: int = 26, signal: int = 9, wanted: tuple[str, ...] = ("macd", "atr_14d", "adx_14d")) -> DataFrame:
    """bars with "macd" (the histogram), "atr_14d" and "adx_14d" (over `window` bars, a column), or those wanted of them.

    Wilder's values are NULL for symbols that span fewer days than `days`.
    """
    wilder = [c for c in wanted if c != "macd"]
    rows = _moves(bars) if wilder else bars
    rows = rows.withColumn("__long", whole_days() >= days) if wilder else rows
    inputs = [*(["close"] if "macd" in wanted else []), *(["__tr", "__up", "__down", window] if wilder else [])]
    spans = (fast, slow, signal)
    out = _by_symbol(rows, list(wanted), lambda first: Smoother(wanted, float(first[window][0]) if wilder else 0.0, spans), inputs, BLOCK)
    out = out.withColumns({c: F.when(F.col("__long"), F.col(c)) for c in wilder})
    return out.drop("__tr", "__up", "__down", "__long")


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """bars with "macd": the histogram of MACD, from exponential means that start at the first value."""
    return smoothed(bars, None, fast=fast, slow=slow, signal=signal, wanted=("macd",))


def _moves(bars: DataFrame) -> DataFrame:
    """bars with the true range and the directed moves."""
    up = F.col("high") - F.lag("high").over(by_time())
    down = F.lag("low").over(by_time()) - F.col("low")
    zero = F.lit(0.0)
    return bars.withColumns({
        "__tr": true_range(),
        "__up": F.when((up > down) & (up > 0), up).otherwise(zero),
        "__down": F.when((down > up) & (down > 0), down).otherwise(zero),
    })


def wilder_atr(bars: DataFrame, window: str, days: int = 14) -> DataFrame:
    """bars with "atr_14d", over `window` bars (a column); NULL for symbols that span fewer days."""
    return smoothed(bars, window, days, wanted=("atr_14d",))


def adx(bars: DataFrame, window: str, days: int = 14) -> DataFrame:
    """bars with "adx_14d": Wilder's average directional index over `window` bars (a column)."""
    return smoothed(bars, window, days, wanted=("adx_14d",))
