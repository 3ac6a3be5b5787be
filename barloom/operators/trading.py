"""Cross-asset features, targets, signals, simulated trading and their measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.indicators import by_time, last

DOWN, NEUTRAL, UP = 0, 1, 2
# Horizons of growth, name -> SQL interval before the last date; last_year is everything.
HORIZONS = {
    "last_nine_months": "9 months", "last_six_months": "6 months", "last_three_months": "3 months", "last_one_month": "1 month",
    "last_three_weeks": "21 days", "last_two_weeks": "14 days", "last_one_week": "7 days",
}


def cross_features(bars: DataFrame, base: str, n: int = 5, x: str = "ret") -> DataFrame:
    """bars (with the return x) with "base_ret" (that of a benchmark symbol at the same time), "spread" and "corr"."""
    bench = bars.where(F.col("symbol") == base).select("datetime", F.col(x).alias("base_ret"))
    out = bars.join(bench, "datetime", "left").withColumn("spread", F.col(x) - F.col("base_ret"))
    both = F.count(F.when(F.col(x).isNotNull() & F.col("base_ret").isNotNull(), 1)).over(last(n))
    flat = (F.stddev_pop(x).over(last(n)) == 0) | (F.stddev_pop("base_ret").over(last(n)) == 0)
    return out.withColumn("corr", F.when((both >= n) & ~flat, F.corr(x, "base_ret").over(last(n))))


def target(threshold: float = 0.0) -> Column:
    """0, 1 or 2: whether the next bar's close is lower, about equal or higher, by more than the threshold."""
    move = F.try_divide(F.lead("close").over(by_time()), F.col("close")) - 1
    return F.when(move > threshold, UP).when(move < -threshold, DOWN).when(move.isNotNull(), NEUTRAL)


def cutoff(bars: DataFrame, as_of: str, lo: str | None = None, hi: str | None = None, minutes: int = 75, tz: str = "America/New_York") -> DataFrame:
    """Bars in (lo, hi] that are older than so many minutes at `as_of`, with their local date."""
    out = bars.where(F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("datetime") > minutes * 60)
    out = out.where(F.col("datetime") > F.lit(lo).cast("timestamp")) if lo else out
    out = out.where(F.col("datetime") <= F.lit(hi).cast("timestamp")) if hi else out
    return out.withColumn("date", F.to_date(F.from_utc_timestamp("datetime", tz)))


def closed_days(bars: DataFrame, as_of: str, minutes: int = 75) -> DataFrame:
    """Bars (with date) of days whose last bar is older than so many minutes at `as_of`."""
    ends = F.max("datetime").over(Window.partitionBy("symbol", "date"))
    rows = bars.withColumn("__ends", ends)
    return rows.where(F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("__ends") > minutes * 60).drop("__ends")


def trailing(rows: DataFrame, days: int = 365) -> DataFrame:
    """Rows (date) of the last so many days before the latest date."""
    top = rows.agg(F.max("date").alias("__top"))
    return rows.join(F.broadcast(top), F.col("date") >= F.date_sub("__top", days)).drop("__top")


def dense_rows(rows: DataFrame, columns: list[str], share: float = 0.8) -> DataFrame:
    """Rows with a value in at least int(share * columns) of the columns."""
    return rows.where(reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns]) >= int(share * len(columns)))


def frequent_keys(rows: DataFrame, key: str, least: int) -> DataFrame:
    """Rows whose key has at least so many rows: counted first, so that no key is gathered in one place."""
    keys = rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") >= least).select(key)
    return rows.join(keys, key, "left_semi")


def informative_columns(rows: DataFrame, columns: list[str]) -> list[str]:
    """Columns that are neither all null nor constant (nulls aside): one pass of counts."""
    got = rows.agg(*(F.min(c).eqNullSafe(F.max(c)).alias(c) for c in columns)).first()
    return [c for c in columns if not got[c]]


def valid_features(rows: DataFrame, columns: list[str], least: int = 500) -> DataFrame:
    """(column, n, is_valid): how many values each column has, and whether they are enough."""
    counts = rows.agg(*(F.count(c).alias(c) for c in columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns))
    return counts.select(F.inline(pairs)).withColumn("is_valid", F.col("n") >= least)


def as_of(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """For each (symbol, date) of `dates` the last of rows (symbol, datetime, ...) up to that date, as "r"; without one, no row.

    Both are one series ordered by time, in which each date takes the last row before it: a window, not a join of all pairs.
    """
    fields = [c for c in rows.columns if c != "symbol"]
    have = rows.select("symbol", F.struct(*fields).alias("r"), F.to_date("datetime").alias("date"), F.lit(0).alias("k"))
    want = dates.select("symbol", F.lit(None).cast(have.schema["r"].dataType).alias("r"), "date", F.lit(1).alias("k")).distinct()
    before = Window.partitionBy("symbol").orderBy("date", "k", F.col("r.datetime")).rowsBetween(Window.unboundedPreceding, 0)
    found = have.unionByName(want).withColumn("r", F.last("r", True).over(before))
    return found.where("k = 1 and r is not null").select("symbol", "date", "r")


def outcomes(picks: DataFrame, rows: DataFrame) -> DataFrame:
    """picks (symbol, date) with the last row of rows (symbol, date, datetime, ...) on that date."""
    fields = [c for c in rows.columns if c not in ("symbol", "date")]
    last_of_day = rows.groupBy("symbol", "date").agg(F.max_by(F.struct(*fields), "datetime").alias("r")).select("symbol", "date", "r.*")
    return picks.join(last_of_day, ["symbol", "date"], "left")


def signals(rows: DataFrame, up: float = 0.4, down: float = 0.4) -> DataFrame:
    """Rows (symbol, date, p_down, p_neutral, p_up, atr, close) -> the best symbol to buy on each date, if any.

    Rows with neither chance above its threshold are skipped, and only those decided as up stay. Score: the expected
    return times how far up is ahead of the others. next_date: the next day that is no weekend.
    """
    keep = rows.where((F.col("p_up") > up) | (F.col("p_down") > down)).where(decision(up, down) == UP)
    scored = keep.withColumn("score", expected_return() * (F.col("p_up") - F.greatest("p_down", "p_neutral")))
    best = F.max_by(F.struct("symbol", "score"), F.struct("score", "symbol")).alias("r")
    return scored.groupBy("date").agg(best).select("date", next_business_day("date").alias("next_date"), "r.symbol", "r.score")


def decision(up: float = 0.4, down: float = 0.4) -> Column:
    """Up if its chance is above the threshold, else down if its is, else up."""
    return F.when(F.col("p_up") > up, UP).when(F.col("p_down") > down, DOWN).otherwise(UP)


def direction_name(target: str) -> Column:
    return F.when(F.col(target) == UP, "UP").when(F.col(target) == NEUTRAL, "NEUTRAL").otherwise("DOWN")


def expected_return() -> Column:
    """The mean true range by the close; 0 where that is undefined."""
    return F.coalesce(F.try_divide("atr", F.when(F.col("close") != 0, F.col("close"))), F.lit(0.0))


def next_business_day(date: str) -> Column:
    d = F.col(date)
    return F.date_add(d, F.when(F.weekday(d) == 4, 3).when(F.weekday(d) == 5, 2).otherwise(1))


def growth(returns: DataFrame, keys: list[str] = ()) -> DataFrame:
    """A row for each of `keys` (one row without any) of rows (keys, date, ret): the compounded growth over everything and over each horizon before the last date.

    A return of -1 or less loses everything.
    """
    keys = list(keys)
    top = returns.groupBy(*keys).agg(F.max("date").alias("__top"))
    rows = (returns.join(top, keys) if keys else returns.join(F.broadcast(top))).withColumn("__log", F.when(F.col("ret") > -1, F.log1p("ret")))
    inside = lambda span: F.col("date") >= F.to_date(F.col("__top") - F.expr(f"interval {span}"))
    whole = lambda c: F.exp(F.coalesce(F.sum(c), F.lit(0.0)))
    lost = lambda keep: F.coalesce(F.bool_or(keep & (F.col("ret") <= -1)), F.lit(False))
    every = F.lit(True)
    out = {"last_year": F.when(lost(every), F.lit(0.0)).otherwise(whole(F.col("__log")))}
    out |= {k: F.when(lost(inside(s)), F.lit(0.0)).otherwise(whole(F.when(inside(s), F.col("__log")))) for k, s in HORIZONS.items()}
    return rows.groupBy(*keys).agg(*(c.alias(k) for k, c in out.items()))


def drawdown(returns: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, max_drawdown) of rows (keys, date, ret): the deepest fall of the capital from its peak so far, at least 1.

    From a return of -1 or less on the capital is 0.
    """
    w = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    lost = F.coalesce(F.bool_or(F.col("ret") <= -1).over(w), F.lit(False))
    whole = F.exp(F.coalesce(F.sum(F.when(F.col("ret") > -1, F.log1p("ret"))).over(w), F.lit(0.0)))
    rows = returns.withColumn("__cap", F.when(lost, F.lit(0.0)).otherwise(whole))
    rows = rows.withColumn("__peak", F.greatest(F.lit(1.0), F.max("__cap").over(w)))
    return rows.groupBy(*keys).agg(F.max((F.col("__peak") - F.col("__cap")) / F.col("__peak")).alias("max_drawdown"))


def profit_factor(ret: str = "ret") -> Column:
    """Sum of gains over sum of losses; 0 without losses."""
    r = F.col(ret)
    gain, loss = F.sum(F.when(r > 0, r).otherwise(0.0)), F.sum(F.when(r < 0, -r).otherwise(0.0))
    return F.coalesce(F.try_divide(gain, F.when(loss > 0, loss)), F.lit(0.0))


def confusion(rows: DataFrame, truth: str = "target", guess: str = "predicted") -> DataFrame:
    """(truth, guess, n, share): counts, and their share of the true class."""
    n = rows.groupBy(truth, guess).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(truth)))


def class_report(rows: DataFrame, truth: str = "target", guess: str = "predicted") -> DataFrame:
    """(label, precision, recall, f1, support) and, in every row, the accuracy."""
    cells = rows.groupBy(truth, guess).agg(F.count("*").alias("n"))
    labels = cells.select(F.explode(F.array(truth, guess)).alias("label"), truth, guess, "n").distinct()
    hit = (F.col(truth) == F.col("label")) & (F.col(guess) == F.col("label"))
    per = labels.groupBy("label").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("hits"),
        F.coalesce(F.sum(F.when(F.col(guess) == F.col("label"), F.col("n"))), F.lit(0)).alias("guessed"),
        F.coalesce(F.sum(F.when(F.col(truth) == F.col("label"), F.col("n"))), F.lit(0)).alias("support"),
    )
    right = cells.agg((F.sum(F.when(F.col(truth) == F.col(guess), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    zero = F.lit(0.0)
    precision, recall = F.coalesce(F.try_divide("hits", "guessed"), zero), F.coalesce(F.try_divide("hits", "support"), zero)
    per = per.withColumns({"precision": precision, "recall": recall})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero)
    return per.withColumn("f1", f1).join(F.broadcast(right)).select("label", "precision", "recall", "f1", "support", "accuracy")


def simulate_one(rows: DataFrame) -> DataFrame:
    """Rows (symbol, date, predicted, ret) -> (symbol, date, ret): the day's return where a rise was predicted, else none."""
    return rows.withColumn("ret", F.when(F.col("predicted") == UP, F.col("ret")).otherwise(F.lit(0.0)))


def simulate_best(picks: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The return on the next trading day of each date's pick (date, symbol, score); outcomes: (symbol, date, ret)."""
    following = outcomes.withColumn("pick_date", F.lag("date").over(Window.partitionBy("symbol").orderBy("date")))
    return picks.drop("next_date").withColumnRenamed("date", "pick_date").join(following, ["symbol", "pick_date"]).select("symbol", "date", "score", "ret")


#: Parts of a class that are counted, so that only the last one taken is ranked row by row.
PARTS = 4096


def undersample(rows: DataFrame, label: str, seed: int = 42) -> DataFrame:
    """As many rows of every class as the rarest has, drawn by a hash of their values: the same ones however rows are dealt.

    A class's rows are in PARTS by their hash; parts are taken whole until one would be too many, and of that one the rows of
    least hash. No window holds more than a part of a class. Rows with a null label are left out.
    """
    cols = rows.columns
    marked = rows.where(F.col(label).isNotNull()).withColumn("__hash", F.xxhash64(F.lit(seed), *(F.col(f"`{c}`") for c in cols)))
    marked = marked.withColumn("__part", F.pmod("__hash", F.lit(PARTS)))
    parts = marked.groupBy(label, "__part").agg(F.count("*").alias("__n"))
    whole = Window.partitionBy(label)
    parts = parts.withColumns({"__before": F.sum("__n").over(whole.orderBy("__part")) - F.col("__n"), "__of": F.sum("__n").over(whole)})
    least = parts.agg(F.min("__of").alias("__least"))
    room = parts.join(F.broadcast(least)).select(label, "__part", "__n", (F.col("__least") - F.col("__before")).alias("__room")).where("__room > 0")
    out = marked.join(room, [label, "__part"])
    rank = F.row_number().over(Window.partitionBy(label, "__part").orderBy("__hash"))
    edge = out.where("__room < __n").withColumn("__rank", rank).where("__rank <= __room")
    return out.where("__room >= __n").select(*cols).unionByName(edge.select(*cols))


def group_folds(key: str, k: int) -> Column:
    """A fold from 0 to k - 1 that all rows of a key share, by its digest."""
    return (F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % k).cast("int")


def time_folds(dates: DataFrame, k: int) -> DataFrame:
    """(date, fold): k + 1 runs of dates of equal length; fold 0 is only ever trained on. Made on distinct dates."""
    return dates.select("date").distinct().withColumn("fold", F.ntile(k + 1).over(Window.orderBy("date")) - 1)
