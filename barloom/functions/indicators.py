"""Price, trend and volume indicators as columns over bars (symbol, datetime, open, high, low, close, adj_close, volume).

All share one window (a symbol's bars in order), so that a select of many of them costs one exchange and one sort.
A missing or undefined value is NULL, never NaN; a division by zero gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F



def by_time():
    """A symbol's bars in order."""
    return Window.partitionBy("symbol").orderBy("datetime")


def last(n: int):
    """The frame of a bar and the n - 1 before it."""
    return by_time().rowsBetween(-(n - 1), 0)


def full(aggregate, x: Column, n: int) -> Column:
    """An aggregate over the last n bars, NULL unless all n have a value."""
    return F.when(F.count(x).over(last(n)) >= n, aggregate(x).over(last(n)))


def change(x: Column | str) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return x - F.lag(x).over(by_time())


def pct_change(x: str) -> Column:
    return F.try_divide(F.col(x), F.lag(x).over(by_time())) - 1


def intraday_return() -> Column:
    return F.try_divide(F.col("close"), F.col("open")) - 1


def price_change() -> Column:
    return F.col("close") - F.col("open")


def price_range() -> Column:
    return F.col("high") - F.col("low")


def volatility() -> Column:
    return F.try_divide(price_range(), F.col("open"))


def typical_price() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


def average_price() -> Column:
    return (F.col("high") + F.col("low")) / 2


def smoothed_derivative(n: int = 5) -> Column:
    """Mean of the last n changes of the close; needs the "price_derivative" column."""
    return full(F.avg, F.col("price_derivative"), n)


def overnight_return() -> Column:
    return F.coalesce(pct_change("open"), F.lit(0.0))


def bb_width(n: int = 20) -> Column:
    c = F.col("close")
    return full(F.max, c, n) - full(F.min, c, n)


def bollinger_pct_b(n: int = 20, sigmas: float = 2.0) -> Column:
    c = F.col("close")
    mean, sd = full(F.avg, c, n), full(F.stddev_pop, c, n)
    return F.when(sd > 0, F.try_divide(c - (mean - sigmas * sd), 2 * sigmas * sd))


def true_range() -> Column:
    before = F.lag("close").over(by_time())
    return F.greatest(price_range(), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def williams_r(n: int = 14) -> Column:
    top, low = full(F.max, F.col("high"), n), full(F.min, F.col("low"), n)
    return -100 * F.try_divide(top - F.col("close"), top - low)


def rsi_from(gain: str, loss: str, n: int) -> Column:
    """RSI of plain means over n bars; the first bar's change counts as zero. No losses: 100, neither: NULL."""
    up, down = F.avg(gain).over(last(n)), F.avg(loss).over(last(n))
    value = F.when(down > 0, 100 - 100 / (1 + F.try_divide(up, down))).when(up > 0, F.lit(100.0))
    return F.when(F.count(F.lit(1)).over(last(n)) >= n, value)


def gains_and_losses(bars):
    """bars with "gain" and "loss": the rise or fall of the close, zero where there is none."""
    d = change("close")
    zero = F.lit(0.0)
    return bars.withColumns({"gain": F.coalesce(F.greatest(d, zero), zero), "loss": F.coalesce(F.greatest(-d, zero), zero)})


def stoch(x: str, n: int = 14) -> Column:
    """Place of x between its least and greatest value in the last n bars; fewer will do."""
    low, top = F.min(x).over(last(n)), F.max(x).over(last(n))
    return F.try_divide(F.col(x) - low, top - low)


def obv(ties_count: bool = True) -> Column:
    """Running volume: minus where the close falls, plus elsewhere; first bar and ties count unless told otherwise."""
    v, d = F.col("volume"), change("close")
    rest = v if ties_count else F.when(d > 0, v).otherwise(F.lit(0.0))
    return F.sum(F.when(d < 0, -v).otherwise(rest)).over(by_time().rowsBetween(Window.unboundedPreceding, 0))


def relative_volume(n: int = 20) -> Column:
    return F.try_divide(F.col("volume"), F.avg("volume").over(last(n)))


def open_close_result(scaled: bool = False) -> Column:
    up, down, flat = (F.lit(x) for x in ((1.0, 0.0, 0.5) if scaled else ("UP", "DOWN", "NEUTRAL")))
    o, c = F.col("open"), F.col("close")
    return F.when(c > o, up).when(c < o, down).when(c == o, flat)


def whole_days() -> Column:
    """Whole days between a symbol's first and last bar."""
    all_of = Window.partitionBy("symbol")
    return F.floor((F.unix_seconds(F.max("datetime").over(all_of)) - F.unix_seconds(F.min("datetime").over(all_of))) / 86400)


def min_max(x: Column, low: Column, high: Column) -> Column:
    """Place of x between low and high; 0 where they are equal."""
    return F.when(high == low, F.lit(0.0)).otherwise(F.try_divide(x - low, high - low))


def volume_rvol(bars, per_session: str = "bars_per_session", days: int = 20):
    """bars with "volume_rvol": volume over its mean of days * per_session bars.

    The frame differs by symbol, so the mean is a difference of running sums, fetched that many bars back by an
    equi-join. NULL until the frame is full, and for symbols that span fewer days.
    """
    n = (F.col(per_session) * days).cast("long")
    run = bars.withColumns({
        "__n": n,
        "__row": F.row_number().over(by_time()).cast("long"),
        "__sum": F.sum("volume").over(by_time().rowsBetween(Window.unboundedPreceding, 0)),
        "__span": whole_days(),
    })
    before = run.select(F.col("symbol"), (F.col("__row") + F.col("__n")).alias("__row"), F.col("__sum").alias("__before"))
    out = run.join(before, ["symbol", "__row"], "left")
    mean = (F.col("__sum") - F.coalesce("__before", F.lit(0.0))) / F.col("__n")
    value = F.when((F.col("__row") >= F.col("__n")) & (F.col("__span") >= days), F.try_divide(F.col("volume"), mean))
    return out.withColumn("volume_rvol", value).drop("__n", "__row", "__sum", "__span", "__before")


def volume_repaired() -> Column:
    """Volume with zeros filled by row: linear between neighbours, the last value after them, the first one before them.

    Needs the columns that `with_volume_neighbours` adds.
    """
    v, a, b = F.col("__v"), F.col("__prev"), F.col("__next")
    between = a["v"] + (b["v"] - a["v"]) * (F.col("__row") - a["row"]) / (b["row"] - a["row"])
    return F.coalesce(v, between, a["v"], b["v"])


def with_volume_neighbours(bars):
    row = bars.withColumns({"__row": F.row_number().over(by_time()), "__v": F.when(F.col("volume") != 0, F.col("volume"))})
    known = F.when(F.col("__v").isNotNull(), F.struct(F.col("__v").alias("v"), F.col("__row").alias("row")))
    back, ahead = by_time().rowsBetween(Window.unboundedPreceding, 0), by_time().rowsBetween(0, Window.unboundedFollowing)
    return row.withColumns({"__prev": F.last(known, True).over(back), "__next": F.first(known, True).over(ahead)})


def repair_volume(bars):
    """bars with zero volumes interpolated by row; a symbol without any volume keeps NULL."""
    out = with_volume_neighbours(bars)
    return out.withColumn("volume", volume_repaired()).drop("__row", "__v", "__prev", "__next")
