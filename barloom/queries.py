"""One query for each operator, and the same in SQL. Daily bars come from orders, hourly ones from events."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import MULTI_SCORES, SINGLE_SCORES, Settings, exchange
from .functions import candles, recursive, temporal
from .functions import indicators as ind
from .operators import bars as ops
from .operators import schedule as sched
from .operators import trading, validate
from .plans import enrich as plan
from .sources import metadata, provider, staging
from .sources.ticks import event_ticks, order_ticks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
S = Settings()

# ---------------------------------------------------------------------------------------------------- shared parts


def size(key: str):
    """The tables have no sizes: a tick trades 1, but nothing if its id is divisible by three, so that there are bars without volume."""
    return (F.col(key) % 3 != 0).cast("double")


def daily(spark: SparkSession, d: str) -> DataFrame:
    return ops.from_ticks(order_ticks(spark, d, size("o_orderkey")), "day")


def hourly(spark: SparkSession, d: str) -> DataFrame:
    return ops.from_ticks(event_ticks(spark, d, size("event_id")), "hour")


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """(symbol, datetime) as strings and the columns, doubles rounded."""
    kinds = dict(df.dtypes)
    cols = [F.round(c, 6).alias(c) if kinds[c] == "double" else F.col(c) for c in columns]
    return df.select("symbol", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"), *cols)


def _bars_sql(table: str, symbol: str, ts: str, price: str, key: str, unit: str) -> str:
    order = f"row({ts}, {key})"
    return (
        f"SELECT {symbol} AS symbol, CAST(date_trunc('{unit}', {ts}) AS TIMESTAMP) AS datetime, arg_min({price}, {order}) AS open, max({price}) AS high, "
        f"min({price}) AS low, arg_max({price}, {order}) AS close, CAST(count(*) FILTER ({key} % 3 <> 0) AS DOUBLE) AS volume, arg_max({price}, {order}) AS adj_close "
        f"FROM {table} GROUP BY 1, 2"
    )


DAILY = f"WITH RECURSIVE daily AS ({_bars_sql('orders', 'o_orderpriority', 'o_orderdate', 'o_totalprice', 'o_orderkey', 'day')})"
HOURLY = f"WITH RECURSIVE hourly AS ({_bars_sql('events', 'event_type', 'ts', 'value', 'event_id', 'hour')})"
W = "(PARTITION BY symbol ORDER BY datetime)"
STAMP = "symbol, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime"


def wn(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY datetime ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def r(x: str, name: str) -> str:
    return f"round({x}, 6) + 0.0 AS {name}"


def full(agg: str, x: str, n: int) -> str:
    return f"CASE WHEN count({x}) OVER {wn(n)} >= {n} THEN {agg}({x}) OVER {wn(n)} END"


def query(sql: str | None, dates: tuple[str, ...] = ()):
    """Registers a query and its SQL; dates: columns that both return as strings."""

    def keep(f):
        @functools.wraps(f)
        def run(spark: SparkSession, d: str) -> DataFrame:
            return f(spark, d).withColumns({c: F.col(c).cast("string") for c in dates})

        QUERIES[f.__name__] = run if dates else f
        if sql:
            SQL[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in dates)}) FROM ({sql})" if dates else sql
        return f

    return keep


# ---------------------------------------------------------------------------------------------------- bars

_OHLCV = ", ".join(r(c, c) for c in ("open", "high", "low", "close", "volume", "adj_close"))
_BAR = ("open", "high", "low", "close", "volume", "adj_close")


@query(f"{DAILY} SELECT {STAMP}, {_OHLCV} FROM daily")
def bars_daily(spark, d):
    return shown(daily(spark, d), *_BAR)


@query(f"{HOURLY} SELECT {STAMP}, {_OHLCV} FROM hourly")
def bars_hourly(spark, d):
    return shown(hourly(spark, d), *_BAR)


@query(
    f"""{HOURLY}, a AS (SELECT *, min(datetime) OVER (PARTITION BY symbol) AS first FROM hourly),
    s AS (SELECT *, first + to_minutes(CAST(420 * floor((epoch(datetime) - epoch(first)) / 25200) AS BIGINT)) AS start FROM a)
    SELECT symbol, strftime(min(datetime), '%Y-%m-%d %H:%M:%S') AS datetime, {r('arg_min(open, datetime)', 'open')}, {r('max(high)', 'high')}, {r('min(low)', 'low')},
    {r('arg_max(close, datetime)', 'close')}, {r('sum(volume)', 'volume')}, {r('arg_max(adj_close, datetime)', 'adj_close')} FROM s GROUP BY symbol, start"""
)
def bars_anchored(spark, d):
    return shown(ops.resample_anchored(hourly(spark, d), 420), *_BAR)


@query(
    f"""{HOURLY}, a AS (SELECT *, epoch(min(datetime) OVER (PARTITION BY symbol)) AS f, epoch(TIMESTAMP '2024-01-20 12:00:00') AS e, epoch(datetime) AS t FROM hourly),
    s AS (SELECT *, f + (e - f) % 25200 AS b FROM a) SELECT symbol, strftime(min(datetime), '%Y-%m-%d %H:%M:%S') AS datetime, {r('max(high)', 'high')}, {r('sum(volume)', 'volume')}
    FROM s WHERE t >= b AND t < e GROUP BY symbol, floor((t - b) / 25200)"""
)
def bars_anchored_at_end(spark, d):
    return shown(ops.resample_anchored(hourly(spark, d), 420, "2024-01-20 12:00:00"), "high", "volume")


@query(f"{DAILY} SELECT {r('min(low)', 'min_price')}, {r('max(high)', 'max_price')}, {r('min(volume)', 'min_volume')}, {r('max(volume)', 'max_volume')} FROM daily")
def global_ranges(spark, d):
    return ops.ranges(daily(spark, d)).select(*(F.round(c, 6).alias(c) for c in ("min_price", "max_price", "min_volume", "max_volume")))


_SCALED = ("open", "low", "high", "close", "adj_close")


@query(
    f"""{DAILY}, g AS (SELECT min(low) AS a, max(high) AS b, min(volume) AS va, max(volume) AS vb FROM daily)
    SELECT {STAMP}, {', '.join(r(f'CASE WHEN a = b THEN 0 ELSE ({c} - a) / (b - a) END', f'scaled_{c}') for c in _SCALED)},
    {r('CASE WHEN volume > 0 THEN CASE WHEN va = vb THEN 0 ELSE (volume - va) / (vb - va) END ELSE 0 END', 'scaled_volume')} FROM daily, g"""
)
def scale_minmax(spark, d):
    bars = daily(spark, d)
    return shown(plan.scale(bars, ops.ranges(bars)), *(f"scaled_{c}" for c in _SCALED), "scaled_volume")


@query(f"{HOURLY}, f AS (SELECT max(m) AS start FROM (SELECT min(datetime) AS m FROM hourly GROUP BY symbol)) SELECT {STAMP}, {r('close', 'close')} FROM hourly, f WHERE datetime >= start")
def align_start(spark, d):
    return shown(ops.align_start(hourly(spark, d)), "close")


@query(
    f"""{DAILY}, x AS (SELECT symbol, datetime, close, CASE WHEN volume = 0 AND day(datetime) = 1 THEN NULL ELSE {full('avg', 'close', 20)} END AS mean20,
      row_number() OVER {W} AS rn, volume FROM daily),
    y AS (SELECT *, max(CASE WHEN mean20 IS NULL OR close IS NULL THEN rn END) OVER (PARTITION BY symbol) AS bad FROM x)
    SELECT {STAMP}, {r('close', 'close')}, {r('mean20', 'mean20')} FROM y WHERE rn > coalesce(bad, 0)"""
)
def null_trim(spark, d):
    hole = (F.col("volume") == 0) & (F.dayofmonth("datetime") == 1)
    bars = daily(spark, d).withColumn("mean20", F.when(~hole, ind.full(F.avg, F.col("close"), 20)))
    return shown(ops.null_trim(bars.select("symbol", "datetime", "close", "volume", "mean20")), "close", "mean20")


@query(
    f"""{DAILY}, x AS (SELECT *, CASE WHEN volume <> 0 THEN volume END AS v, row_number() OVER {W} AS rn FROM daily),
    y AS (SELECT *, last_value(v IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS pr,
      first_value(v IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER a AS nr FROM x
      WINDOW b AS (PARTITION BY symbol ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY symbol ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT {STAMP}, {r('coalesce(v, pv + (nv - pv) * (rn - pr) / (nr - pr), pv, nv)', 'volume')} FROM y"""
)
def volume_repair(spark, d):
    return shown(ind.repair_volume(daily(spark, d)), "volume")


_STORED, _FRESH = "day(datetime) <= 20", "day(datetime) >= 15"


@query(f"{HOURLY} SELECT {STAMP}, {r('close', 'close')} FROM hourly h WHERE {_FRESH} AND NOT EXISTS (SELECT 1 FROM hourly s WHERE day(s.datetime) <= 20 AND s.symbol = h.symbol AND s.datetime = h.datetime)")
def new_rows_anti(spark, d):
    bars = hourly(spark, d)
    return shown(ops.new_rows(bars.where("day(datetime) <= 20"), bars.where("day(datetime) >= 15")), "close")


@query(
    f"""{HOURLY}, f AS (SELECT symbol, datetime, close + 1 AS close, 1 AS batch FROM hourly WHERE {_FRESH} UNION ALL SELECT symbol, datetime, close + 2, 2 FROM hourly WHERE {_FRESH})
    SELECT {STAMP}, {r('close', 'close')} FROM (SELECT symbol, datetime, close FROM hourly WHERE {_STORED} UNION ALL
      SELECT symbol, datetime, close FROM f WHERE batch = 1 AND NOT EXISTS (SELECT 1 FROM hourly s WHERE day(s.datetime) <= 20 AND s.symbol = f.symbol AND s.datetime = f.datetime))"""
)
def upsert_bars(spark, d):
    bars = hourly(spark, d).select("symbol", "datetime", "close")
    late = bars.where("day(datetime) >= 15")
    fresh = late.withColumn("close", F.col("close") + 1).withColumn("batch", F.lit(1)).union(late.withColumn("close", F.col("close") + 2).withColumn("batch", F.lit(2)))
    return shown(ops.upsert(bars.where("day(datetime) <= 20"), fresh, "batch"), "close")


_AGED = "CASE symbol WHEN 'click' THEN day(datetime) <= 10 WHEN 'view' THEN day(datetime) <= 24 ELSE TRUE END"


@query(
    f"""{HOURLY}, b AS (SELECT * FROM hourly WHERE {_AGED}), l AS (SELECT symbol, max(datetime) AS last FROM b GROUP BY symbol),
    u AS (SELECT DISTINCT event_type AS symbol FROM events UNION SELECT 'none')
    SELECT symbol, strftime(last, '%Y-%m-%d %H:%M:%S') AS last, coalesce(floor((epoch((SELECT max(last) FROM l)) - epoch(last)) / 86400) > 7, TRUE) AS is_stale FROM u LEFT JOIN l USING (symbol)"""
)
def stale_symbols(spark, d):
    bars = hourly(spark, d)
    names = bars.select("symbol").distinct().union(spark.createDataFrame([("none",)], "symbol string"))
    out = ops.stale_symbols(names, bars.where(F.expr(_AGED)), S.stale_days)
    return out.withColumn("last", F.date_format("last", "yyyy-MM-dd HH:mm:ss"))


@query(f"{HOURLY} SELECT {STAMP}, {r('close', 'close')}, {r('volume', 'volume')} FROM hourly QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) = 1")
def latest_per_symbol(spark, d):
    return shown(ops.latest(hourly(spark, d)), "close", "volume")


@query(
    """WITH v AS (SELECT 1 AS is_local, 'a' AS id, TIMESTAMP '2024-01-02' AS last_updated, CAST((SELECT count(*) FROM events WHERE day(ts) <= 20) AS BIGINT) AS payload
    UNION ALL SELECT 0, 'b', TIMESTAMP '2024-01-03', CAST((SELECT count(*) FROM events) AS BIGINT))
    SELECT arg_max(payload, row(last_updated, is_local)) AS payload FROM v"""
)
def reconcile_versions(spark, d):
    ticks = event_ticks(spark, d)
    version = lambda id_, at, rows: rows.agg(F.count("*").alias("payload")).select(F.lit(id_).alias("id"), F.lit(at).cast("timestamp").alias("last_updated"), "payload")
    return ops.reconcile(version("a", "2024-01-02", ticks.where("day(ts) <= 20")), version("b", "2024-01-03", ticks))


@query(f"{HOURLY}, t AS (SELECT symbol, datetime FROM hourly UNION ALL SELECT symbol, datetime FROM hourly WHERE hour(datetime) = 5) SELECT {STAMP}, count(*) AS n FROM t GROUP BY symbol, t.datetime HAVING count(*) > 1")
def dup_bars(spark, d):
    bars = hourly(spark, d).select("symbol", "datetime")
    return shown(validate.duplicates(bars.union(bars.where("hour(datetime) = 5"))), "n")


# ---------------------------------------------------------------------------------------------------- indicators


@query(
    f"""{DAILY}, x AS (SELECT *, close - lag(close) OVER {W} AS price_derivative FROM daily)
    SELECT {STAMP}, {r('close / nullif(open, 0) - 1', 'intraday_return')}, {r('close - open', 'price_change')}, {r('high - low', 'range')}, {r('(high - low) / nullif(open, 0)', 'volatility')},
    {r('(high + low + close) / 3', 'typical_price')}, {r('(high + low) / 2', 'average_price')}, {r('price_derivative', 'price_derivative')},
    {r(full('avg', 'price_derivative', 5), 'smoothed_derivative')} FROM x"""
)
def price_features(spark, d):
    out = daily(spark, d).withColumns({
        "intraday_return": ind.intraday_return(), "price_change": ind.price_change(), "range": ind.price_range(), "volatility": ind.volatility(),
        "typical_price": ind.typical_price(), "average_price": ind.average_price(), "price_derivative": ind.change("close"),
    }).withColumn("smoothed_derivative", ind.smoothed_derivative())
    return shown(out, "intraday_return", "price_change", "range", "volatility", "typical_price", "average_price", "price_derivative", "smoothed_derivative")


@query(f"{DAILY} SELECT {STAMP}, {r(f'close / nullif(lag(close) OVER {W}, 0) - 1', 'ret')}, {r(f'coalesce(open / nullif(lag(open) OVER {W}, 0) - 1, 0)', 'overnight_return')} FROM daily")
def returns(spark, d):
    return shown(daily(spark, d).withColumns({"ret": ind.pct_change("close"), "overnight_return": ind.overnight_return()}), "ret", "overnight_return")


TRUE_RANGE = f"greatest(high - low, abs(high - lag(close) OVER {W}), abs(low - lag(close) OVER {W}))"


@query(f"{DAILY}, x AS (SELECT *, {TRUE_RANGE} AS tr FROM daily) SELECT {STAMP}, {r('tr', 'true_range')}, {r(full('avg', 'tr', 14), 'atr')} FROM x")
def atr_sma(spark, d):
    out = daily(spark, d).withColumn("true_range", ind.true_range())
    return shown(out.withColumn("atr", ind.full(F.avg, F.col("true_range"), S.atr_window)), "true_range", "atr")


GAINS = f"SELECT *, coalesce(greatest(close - lag(close) OVER {W}, 0), 0) AS gain, coalesce(greatest(lag(close) OVER {W} - close, 0), 0) AS loss FROM"


def rsi_sql(n: int) -> str:
    up, down = f"avg(gain) OVER {wn(n)}", f"avg(loss) OVER {wn(n)}"
    return f"CASE WHEN count(*) OVER {wn(n)} >= {n} THEN CASE WHEN {down} > 0 THEN 100 - 100 / (1 + {up} / {down}) WHEN {up} > 0 THEN 100.0 END END"


@query(f"{DAILY}, x AS ({GAINS} daily) SELECT {STAMP}, {r(rsi_sql(6), 'rsi')} FROM x")
def rsi_sma(spark, d):
    return shown(ind.gains_and_losses(daily(spark, d)).withColumn("rsi", ind.rsi_from("gain", "loss", S.rsi_window)), "rsi")


@query(f"{DAILY}, x AS ({GAINS} daily), y AS (SELECT *, {rsi_sql(14)} AS k FROM x) SELECT {STAMP}, {r(f'(k - min(k) OVER {wn(14)}) / nullif(max(k) OVER {wn(14)} - min(k) OVER {wn(14)}, 0)', 'stoch_rsi')} FROM y")
def stoch_rsi(spark, d):
    out = ind.gains_and_losses(daily(spark, d)).withColumn("k", ind.rsi_from("gain", "loss", S.stoch_rsi_window))
    return shown(out.withColumn("stoch_rsi", ind.stoch("k", S.stoch_rsi_window)), "stoch_rsi")


@query(f"{DAILY} SELECT {STAMP}, {r(full('max', 'close', 20) + ' - ' + full('min', 'close', 20), 'bb_width')} FROM daily")
def bb_width(spark, d):
    return shown(daily(spark, d).withColumn("bb_width", ind.bb_width()), "bb_width")


@query(f"{DAILY}, x AS (SELECT *, {full('avg', 'close', 20)} AS m, {full('stddev_pop', 'close', 20)} AS s FROM daily) SELECT {STAMP}, {r('CASE WHEN s > 0 THEN (close - (m - 2 * s)) / (4 * s) END', 'bollinger_pct_b')} FROM x")
def bollinger_pct_b(spark, d):
    return shown(daily(spark, d).withColumn("bollinger_pct_b", ind.bollinger_pct_b()), "bollinger_pct_b")


@query(f"{DAILY}, x AS (SELECT *, {full('max', 'high', 14)} AS t, {full('min', 'low', 14)} AS b FROM daily) SELECT {STAMP}, {r('-100 * (t - close) / nullif(t - b, 0)', 'williams_r')} FROM x")
def williams_r(spark, d):
    return shown(daily(spark, d).withColumn("williams_r", ind.williams_r()), "williams_r")


@query(f"{DAILY}, x AS (SELECT *, CASE WHEN close < lag(close) OVER {W} THEN -volume ELSE volume END AS v FROM daily) SELECT {STAMP}, {r(f'sum(v) OVER (PARTITION BY symbol ORDER BY datetime ROWS UNBOUNDED PRECEDING)', 'obv')} FROM x")
def obv(spark, d):
    bars = daily(spark, d)
    falls = bars.withColumn("falls", ind.change("close") < 0)
    signed = F.when(F.col("falls"), -F.col("volume")).otherwise(F.col("volume"))
    return shown(falls.withColumn("obv", F.sum(signed).over(ind.by_time().rowsBetween(Window.unboundedPreceding, 0))), "obv")


@query(f"{DAILY} SELECT {STAMP}, {r(f'volume / nullif(avg(volume) OVER {wn(20)}, 0)', 'relative_volume')} FROM daily")
def relative_volume(spark, d):
    return shown(daily(spark, d).withColumn("relative_volume", ind.relative_volume()), "relative_volume")


@query(f"{DAILY} SELECT {STAMP}, {r(f'volume / nullif(lag(volume) OVER {W}, 0) - 1', 'volume_change')} FROM daily")
def volume_change(spark, d):
    return shown(daily(spark, d).withColumn("volume_change", ind.pct_change("volume")), "volume_change")


SESSIONS = """steps AS (SELECT symbol, epoch(datetime) - epoch(lag(datetime) OVER (PARTITION BY symbol ORDER BY datetime)) AS step FROM hourly),
    modes AS (SELECT symbol, CAST(arg_max(step, row(n, -step)) AS BIGINT) AS bar_seconds FROM (SELECT symbol, step, count(*) AS n FROM steps WHERE step IS NOT NULL GROUP BY ALL) GROUP BY symbol),
    days AS (SELECT symbol, CAST(datetime AS DATE) AS date, max(epoch(datetime)) - min(epoch(datetime)) AS length FROM hourly GROUP BY ALL),
    sessions AS (SELECT symbol, CAST(ceil(median((length + bar_seconds) / bar_seconds)) AS BIGINT) AS n FROM days JOIN modes USING (symbol) GROUP BY symbol)"""


@query(f"{HOURLY}, {SESSIONS} SELECT symbol, bar_seconds, n AS bars_per_session FROM modes JOIN sessions USING (symbol)")
def bars_per_session(spark, d):
    bars = hourly(spark, d)
    return sched.bar_seconds(bars).join(sched.bars_per_session(bars), "symbol").select("symbol", F.col("bar_seconds").cast("bigint").alias("bar_seconds"), "bars_per_session")


@query(
    f"""{HOURLY}, {SESSIONS}, x AS (SELECT h.*, s.n * 20 AS k, row_number() OVER {W} AS rn, sum(volume) OVER (PARTITION BY symbol ORDER BY datetime ROWS UNBOUNDED PRECEDING) AS run,
      floor((epoch(max(datetime) OVER (PARTITION BY symbol)) - epoch(min(datetime) OVER (PARTITION BY symbol))) / 86400) AS span FROM hourly h JOIN sessions s USING (symbol))
    SELECT x.symbol, strftime(x.datetime, '%Y-%m-%d %H:%M:%S') AS datetime, {r('CASE WHEN x.rn >= x.k AND x.span >= 20 THEN x.volume / nullif((x.run - coalesce(y.run, 0)) / x.k, 0) END', 'volume_rvol')}
    FROM x LEFT JOIN x y ON y.symbol = x.symbol AND y.rn = x.rn - x.k"""
)
def rvol_20d(spark, d):
    bars = hourly(spark, d)
    per = F.broadcast(sched.bars_per_session(bars))
    return shown(ind.volume_rvol(bars.join(per, "symbol")), "volume_rvol")


@query(
    f"""{DAILY}, x AS (SELECT *, row_number() OVER {W} AS rn FROM daily),
    e AS (SELECT symbol, datetime, rn, close AS a, close AS b, 0.0::DOUBLE AS s FROM x WHERE rn = 1 UNION ALL
      SELECT symbol, datetime, rn, a, b, s + (2.0 / 10) * ((a - b) - s) FROM (SELECT x.symbol, x.datetime, x.rn, e.a + (2.0 / 13) * (x.close - e.a) AS a, e.b + (2.0 / 27) * (x.close - e.b) AS b, e.s
        FROM e JOIN x ON x.symbol = e.symbol AND x.rn = e.rn + 1))
    SELECT {STAMP}, {r('(a - b) - s', 'macd')} FROM e"""
)
def macd_hist(spark, d):
    return shown(recursive.macd(daily(spark, d), S.macd_fast, S.macd_slow, S.macd_signal), "macd")


def _wilder_sql(name: str, source: str, value: str, n: int, out: str) -> str:
    """CTEs that smooth `value` of `source` (symbol, datetime, rn): the mean of the first n values, then Wilder's recurrence."""
    return f"""{name}_i AS (SELECT symbol, datetime, rn, {value} AS v, count({value}) OVER {W} AS k, sum({value}) OVER (PARTITION BY symbol ORDER BY datetime ROWS UNBOUNDED PRECEDING) AS t FROM {source}),
    {name} AS (SELECT symbol, datetime, rn, t / {n} AS {out} FROM {name}_i WHERE k = {n} AND v IS NOT NULL UNION ALL
      SELECT i.symbol, i.datetime, i.rn, coalesce(({name}.{out} * {n - 1} + i.v) / {n}, {name}.{out}) FROM {name} JOIN {name}_i i ON i.symbol = {name}.symbol AND i.rn = {name}.rn + 1)"""


@query(
    f"""{DAILY}, x AS (SELECT *, {TRUE_RANGE} AS tr, row_number() OVER {W} AS rn FROM daily), {_wilder_sql('w', 'x', 'tr', 14, 'atr')}
    SELECT x.symbol, strftime(x.datetime, '%Y-%m-%d %H:%M:%S') AS datetime, {r('atr', 'atr_14d')} FROM x LEFT JOIN w USING (symbol, rn)"""
)
def atr_wilder(spark, d):
    return shown(recursive.wilder_atr(daily(spark, d).withColumn("n", F.lit(14)), "n"), "atr_14d")


@query(
    f"""{DAILY}, x AS (SELECT *, {TRUE_RANGE} AS tr, high - lag(high) OVER {W} AS up, lag(low) OVER {W} - low AS down, row_number() OVER {W} AS rn FROM daily),
    m AS (SELECT *, CASE WHEN up > down AND up > 0 THEN up ELSE 0 END AS pdm, CASE WHEN down > up AND down > 0 THEN down ELSE 0 END AS mdm FROM x),
    {_wilder_sql('wt', 'm', 'tr', 14, 'atr')}, {_wilder_sql('wp', 'm', 'pdm', 14, 'p')}, {_wilder_sql('wm', 'm', 'mdm', 14, 'q')},
    dx AS (SELECT m.symbol, m.datetime, m.rn, 100 * abs(100 * p / nullif(atr, 0) - 100 * q / nullif(atr, 0)) / nullif(100 * p / nullif(atr, 0) + 100 * q / nullif(atr, 0), 0) AS dx
      FROM m LEFT JOIN wt ON wt.symbol = m.symbol AND wt.rn = m.rn LEFT JOIN wp ON wp.symbol = m.symbol AND wp.rn = m.rn LEFT JOIN wm ON wm.symbol = m.symbol AND wm.rn = m.rn),
    {_wilder_sql('wa', 'dx', 'dx', 14, 'adx')}
    SELECT dx.symbol, strftime(dx.datetime, '%Y-%m-%d %H:%M:%S') AS datetime, {r('adx', 'adx_14d')} FROM dx LEFT JOIN wa ON wa.symbol = dx.symbol AND wa.rn = dx.rn"""
)
def adx(spark, d):
    return shown(recursive.adx(daily(spark, d).withColumn("n", F.lit(14)), "n"), "adx_14d")


@query(f"{DAILY} SELECT {STAMP}, CASE WHEN close > open THEN 'UP' WHEN close < open THEN 'DOWN' ELSE 'NEUTRAL' END AS open_close_result, {r('CASE WHEN close > open THEN 1 WHEN close < open THEN 0 ELSE 0.5 END', 'scaled_result')} FROM daily")
def open_close_result(spark, d):
    out = daily(spark, d).withColumns({"open_close_result": ind.open_close_result(), "scaled_result": ind.open_close_result(scaled=True)})
    return shown(out, "open_close_result", "scaled_result")


# ---------------------------------------------------------------------------------------------------- candles

SHAPE = "SELECT *, abs(close - open) AS body, high - greatest(open, close) AS up, least(open, close) - low AS lo, abs(close - open) / (high - low + 1e-9) AS pct FROM"
_TOP = "pct > 0.1 AND pct < 0.3 AND least(up, lo) / (body + 1e-9) > 1"
PATTERN = f"""CASE WHEN pct < 0.1 AND lo > 2 * body AND up < 0.1 THEN 'dragonfly_doji' WHEN pct < 0.1 AND up > 2 * body AND lo < 0.1 THEN 'gravestone_doji'
    WHEN close > open AND up > 2 * body AND lo < 0.3 * body AND pct < 0.3 THEN 'inverted_hammer' WHEN close < open AND lo > 2 * body AND up < 0.3 * body AND pct < 0.3 THEN 'hanging_man'
    WHEN close > open AND lo > 2 * body AND up < 0.3 * body AND pct < 0.3 THEN 'hammer_bullish' WHEN close < open AND up > 2 * body AND lo < 0.3 * body AND pct < 0.3 THEN 'shooting_star_bearish'
    WHEN close > open AND up < 0.3 * body AND lo < 0.3 * body THEN 'marubozu_bullish' WHEN close < open AND up < 0.3 * body AND lo < 0.3 * body THEN 'marubozu_bearish'
    WHEN close > open AND {_TOP} THEN 'spinning_top_bullish' WHEN close < open AND {_TOP} THEN 'spinning_top_bearish' WHEN pct < 0.1 THEN 'doji'
    WHEN up > 2 * body THEN 'long_upper_shadow' WHEN lo > 2 * body THEN 'long_lower_shadow' WHEN close > open THEN 'bullish' ELSE 'bearish' END"""


def _scores_sql(x: str, scores: dict[str, float]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in scores.items()) + " END"


# Hourly bars hold several ticks each, so that candles have shadows.
CANDLES = f"{HOURLY}, shapes AS ({SHAPE} hourly), named AS (SELECT *, {PATTERN} AS p FROM shapes), scored AS (SELECT *, {_scores_sql('p', SINGLE_SCORES)} AS sc FROM named)"


@query(f"{CANDLES} SELECT {STAMP}, p AS candle_pattern FROM scored")
def candle_pattern(spark, d):
    return shown(candles.with_patterns(hourly(spark, d)), "candle_pattern")


@query(f"{CANDLES} SELECT {STAMP}, {r('sc', 'candle_score')} FROM scored")
def candle_score(spark, d):
    return shown(candles.with_patterns(hourly(spark, d)), "candle_score")


_LAGS = ", ".join(f"lag({c}, {k}) OVER {W} AS {c}{k}" for k in (1, 2) for c in ("open", "high", "low", "close", "body", "up", "lo", "pct", "p", "sc"))
MULTI = f"""{CANDLES}, three AS (SELECT *, {_LAGS} FROM scored),
    multi AS (SELECT *, CASE WHEN p2 IS NULL THEN NULL
      WHEN p1 IN ('bearish', 'marubozu_bearish', 'spinning_top_bearish') AND p IN ('bullish', 'marubozu_bullish') AND open < close1 AND close > open1 THEN 'bullish_engulfing'
      WHEN p1 IN ('bullish', 'marubozu_bullish', 'spinning_top_bullish') AND p IN ('bearish', 'marubozu_bearish') AND open > close1 AND close < open1 THEN 'bearish_engulfing'
      WHEN p2 IN ('bearish', 'marubozu_bearish') AND (pct1 < 0.1 OR (pct1 > 0.1 AND pct1 < 0.3 AND least(up1, lo1) / (body1 + 1e-9) > 1)) AND p IN ('bullish', 'marubozu_bullish') AND close > (open2 + close2) / 2 THEN 'morning_star'
      WHEN p2 IN ('bullish', 'marubozu_bullish') AND (pct1 < 0.1 OR (pct1 > 0.1 AND pct1 < 0.3 AND least(up1, lo1) / (body1 + 1e-9) > 1)) AND p IN ('bearish', 'marubozu_bearish') AND close < (open2 + close2) / 2 THEN 'evening_star'
      WHEN close1 < open1 AND close > open AND open < low1 AND close > (open1 + close1) / 2 AND close < open1 THEN 'piercing_line'
      WHEN close1 > open1 AND close < open AND open > high1 AND close > open1 AND close < (open1 + close1) / 2 THEN 'dark_cloud_cover'
      WHEN close1 < open1 AND close > open AND abs(low - low1) < 1e-3 THEN 'tweezer_bottom' WHEN close1 > open1 AND close < open AND abs(high - high1) < 1e-3 THEN 'tweezer_top'
      WHEN close > open AND close1 > open1 AND close2 > open2 AND open > open1 AND open1 > open2 AND close > close1 AND close1 > close2 AND up < body * 0.5 AND up1 < body1 * 0.5 AND up2 < body2 * 0.5 THEN 'three_white_soldiers'
      WHEN close < open AND close1 < open1 AND close2 < open2 AND open < open1 AND open1 < open2 AND close < close1 AND close1 < close2 AND lo < body * 0.5 AND lo1 < body1 * 0.5 AND lo2 < body2 * 0.5 THEN 'three_black_crows'
      ELSE '' END AS m FROM three)"""


@query(f"{MULTI} SELECT {STAMP}, m AS multi_candle_pattern FROM multi")
def multi_candle_pattern(spark, d):
    return shown(candles.with_multi_patterns(hourly(spark, d)), "multi_candle_pattern")


@query(f"{MULTI} SELECT {STAMP}, {r(f'CASE WHEN m IS NOT NULL THEN coalesce({_scores_sql('m', MULTI_SCORES)}, round(1e-6 + (sc + sc1 + sc2) / 3 * (1 - 2e-6), 3)) END', 'multi_candle_score')} FROM multi")
def multi_candle_score(spark, d):
    return shown(candles.with_multi_patterns(hourly(spark, d)), "multi_candle_score")


# ---------------------------------------------------------------------------------------------------- calendar

_SEC = "(hour(datetime) * 3600 + minute(datetime) * 60 + second(datetime))"
_MONTH = "(epoch(datetime) - epoch(date_trunc('month', datetime))) / (epoch(CAST(last_day(datetime) + INTERVAL 1 DAY AS TIMESTAMP)) - epoch(date_trunc('month', datetime)))"
_YEAR = "(epoch(datetime) - epoch(date_trunc('year', datetime))) / (epoch(CAST(date_trunc('year', datetime) + INTERVAL 1 YEAR AS TIMESTAMP)) - epoch(date_trunc('year', datetime)))"


@query(
    f"""{HOURLY} SELECT {STAMP}, {r(f'{_SEC} / 86400', 'time_of_day')}, {r(f'((isodow(datetime) - 1) * 86400 + {_SEC}) / 604800', 'time_of_week')}, {r(_MONTH, 'time_of_month')}, {r(_YEAR, 'time_of_year')},
    {r(f'{_SEC} / 3600', 'raw_time_of_day')}, {r(f'((isodow(datetime) - 1) * 86400 + {_SEC}) / 86400 + 1', 'raw_time_of_week')},
    {r("(epoch(datetime) - epoch(date_trunc('month', datetime))) / 86400 + 1", 'raw_time_of_month')}, {r("(epoch(datetime) - epoch(date_trunc('year', datetime))) / 86400 + 1", 'raw_time_of_year')} FROM hourly"""
)
def time_fractions(spark, d):
    out = hourly(spark, d)
    cols = temporal.time_fractions(F.col("datetime")) | {f"raw_{k}": v for k, v in temporal.time_fractions(F.col("datetime"), raw=True).items()}
    return shown(out.withColumns(cols), *cols)


EVENTS = [dt.date(2024, 1, 3), dt.date(2024, 1, 5), dt.date(2024, 1, 18), dt.date(2024, 1, 31)]
HOLIDAYS = temporal.us_holidays(1995, 2001) + temporal.us_holidays(2024, 2024)


def _dates_sql(dates) -> str:
    return "(VALUES " + ", ".join(f"(DATE '{x}')" for x in dates) + ") AS v(date)"


@query(f"{DAILY} SELECT {STAMP}, isodow(datetime) <= 5 AS is_weekday, isodow(datetime) > 5 AS is_weekend, isodow(datetime) <= 5 AND CAST(datetime AS DATE) NOT IN (SELECT date FROM {_dates_sql(HOLIDAYS)}) AS is_workday FROM daily")
def weekday_workday(spark, d):
    out = temporal.is_workday(daily(spark, d), temporal.dates_table(spark, HOLIDAYS))
    at = F.col("datetime")
    return shown(out.withColumns({"is_weekday": temporal.is_weekday(at), "is_weekend": ~temporal.is_weekday(at)}), "is_weekday", "is_weekend", "is_workday")


@query(
    f"""{HOURLY}, k AS (SELECT h.symbol, h.datetime, bool_or(v.date = CAST(h.datetime AS DATE)) AS hit, max(CASE WHEN v.date > CAST(h.datetime AS DATE) THEN date_diff('day', CAST(h.datetime AS DATE), v.date) END) AS before,
      max(CASE WHEN v.date < CAST(h.datetime AS DATE) THEN date_diff('day', v.date, CAST(h.datetime AS DATE)) END) AS after
      FROM hourly h LEFT JOIN {_dates_sql(EVENTS)} ON abs(date_diff('day', CAST(h.datetime AS DATE), v.date)) <= 5 GROUP BY ALL)
    SELECT {STAMP}, coalesce(hit, FALSE) AS is_fed_event, {r('coalesce((6 - before) / 5, 0) * 100', 'is_pre_fed_event')}, {r('coalesce((6 - after) / 5, 0) * 100', 'is_post_fed_event')} FROM k"""
)
def event_proximity(spark, d):
    out = temporal.event_features(hourly(spark, d), temporal.dates_table(spark, EVENTS), "fed_event", S.event_days, raw=True)
    return shown(out, "is_fed_event", "is_pre_fed_event", "is_post_fed_event")


_HOURS = [("2024-01-01", "2024-01-20", "09:30", "16:00", 1), ("2024-01-15", "2024-01-25", "10:00", "14:30", 2)]
_HOURS_SQL = "(VALUES " + ", ".join(f"(DATE '{a}', DATE '{b}', '{c}', '{e}', {n})" for a, b, c, e, n in _HOURS) + ") AS s(date_from, date_to, time_from, time_to, ord)"


@query(
    f"""{HOURLY}, j AS (SELECT h.symbol, h.datetime, arg_max(time_from, ord) AS lo, arg_max(time_to, ord) AS hi FROM hourly h LEFT JOIN {_HOURS_SQL} ON CAST(h.datetime AS DATE) BETWEEN date_from AND date_to GROUP BY ALL),
    p AS (SELECT *, coalesce(strftime(datetime, '%H:%M') < lo, FALSE) AS a, coalesce(strftime(datetime, '%H:%M') BETWEEN lo AND hi, FALSE) AS b, coalesce(strftime(datetime, '%H:%M') > hi, FALSE) AS c,
      isodow(datetime) <= 5 AND CAST(datetime AS DATE) NOT IN (SELECT date FROM {_dates_sql(HOLIDAYS)}) AS is_workday FROM j)
    SELECT {STAMP}, a AS is_pre_market_time, b AS is_market_time, c AS is_post_market_time, (a OR b OR c) AND is_workday AS is_market_day FROM p"""
)
def market_phase(spark, d):
    rows = [(dt.date.fromisoformat(a), dt.date.fromisoformat(b), c, e, n) for a, b, c, e, n in _HOURS]
    schedule = spark.createDataFrame(rows, "date_from date, date_to date, time_from string, time_to string, ord int")
    bars = temporal.is_workday(hourly(spark, d), temporal.dates_table(spark, HOLIDAYS))
    out = temporal.market_phase(bars, schedule, intraday=True)
    return shown(out, "is_pre_market_time", "is_market_time", "is_post_market_time", "is_market_day")


# ---------------------------------------------------------------------------------------------------- trading hours

BOUNDS = "bounds AS (SELECT symbol, CAST(datetime AS DATE) AS date, strftime(min(datetime), '%H:%M') AS first, strftime(max(datetime), '%H:%M') AS last FROM (SELECT symbol, CAST(date_trunc('day', datetime) AS TIMESTAMP) + to_hours(8 + hour(datetime) * 10 // 24) AS datetime FROM hourly) GROUP BY ALL)"


def open_hours(spark: SparkSession, d: str) -> DataFrame:
    """All hourly bars, their 24 hours drawn together to those from 8 to 17, as of a market that closes at night."""
    at = F.unix_seconds(F.date_trunc("day", "datetime")) + 3600 * (8 + F.floor(F.hour("datetime") * 10 / 24))
    return hourly(spark, d).withColumn("datetime", F.timestamp_seconds(at))


_TO = "strftime(CAST(date AS TIMESTAMP) + CAST(last || ':00' AS INTERVAL) + INTERVAL 1 HOUR, '%H:%M')"
BLOCKS = f"""{BOUNDS}, dated AS (SELECT symbol, isodow(date) - 1 AS weekday, first AS f, {_TO} AS t, date FROM bounds),
    lengths AS (SELECT symbol, weekday, f, t, count(DISTINCT date) AS dates, (CAST(substr(t, 1, 2) AS INT) * 60 + CAST(substr(t, 4, 2) AS INT)) - (CAST(substr(f, 1, 2) AS INT) * 60 + CAST(substr(f, 4, 2) AS INT)) AS len FROM dated GROUP BY ALL),
    blocks0 AS (SELECT *, round(CASE WHEN len <= 0 THEN len + 1440 ELSE len END / 60, 2) AS hours FROM lengths),
    blocks AS (SELECT *, hours = 24 AS all_day, hours = max(hours) OVER (PARTITION BY symbol, weekday) AND dates >= 0.2 * sum(dates) OVER (PARTITION BY symbol, weekday) AS recurrent FROM blocks0)"""


@query(f"{HOURLY}, {BOUNDS} SELECT * FROM bounds", dates=("date",))
def daily_bounds(spark, d):
    return sched.daily_bounds(open_hours(spark, d))


@query(f"""{HOURLY}, {BLOCKS} SELECT symbol, CAST(weekday AS INTEGER) AS weekday, f AS "from", t AS "to", dates, hours, all_day, recurrent FROM blocks""")
def trading_blocks(spark, d):
    return sched.trading_blocks(sched.daily_bounds(open_hours(spark, d)), 60)


@query(
    """WITH u AS (SELECT DISTINCT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS date FROM orders),
    x AS (SELECT *, coalesce(date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY date), date) > 8, TRUE) AS is_new FROM u),
    y AS (SELECT *, sum(CAST(is_new AS INT)) OVER (PARTITION BY symbol ORDER BY date) AS run FROM x) SELECT symbol, min(date) AS date_from, max(date) AS date_to FROM y GROUP BY symbol, run""", dates=("date_from", "date_to"))
def date_islands(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet")
    return sched.date_islands(rows.select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date")).distinct(), ["symbol"])


# An order's span is open for up to four months, so that some of a customer's spans meet and others leave gaps.
_SPANS = "SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS date_from, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 AS INTEGER) AS date_to FROM orders"
MERGED = f"""spans AS ({_SPANS}), x AS (SELECT *, max(date_to) OVER (PARTITION BY symbol ORDER BY date_from, date_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM spans),
    y AS (SELECT *, sum(CASE WHEN date_diff('day', before, date_from) <= 8 THEN 0 ELSE 1 END) OVER (PARTITION BY symbol ORDER BY date_from, date_to) AS run FROM x),
    merged AS (SELECT symbol, min(date_from) AS date_from, max(date_to) AS date_to FROM y GROUP BY symbol, run)"""


def _spans(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet")
    day = F.to_date("o_orderdate")
    return rows.select(F.col("o_custkey").alias("symbol"), day.alias("date_from"), F.date_add(day, (F.col("o_orderkey") % 120).cast("int")).alias("date_to"))


@query(f"WITH {MERGED} SELECT * FROM merged", dates=("date_from", "date_to"))
def merge_intervals(spark, d):
    return sched.merge_intervals(_spans(spark, d), ["symbol"])


@query(
    f"""WITH {MERGED}, z AS (SELECT *, lag(date_to) OVER w AS pt, lead(date_from) OVER w AS nf FROM merged WINDOW w AS (PARTITION BY symbol ORDER BY date_from))
    SELECT symbol, CASE WHEN date_diff('day', pt, date_from) > 1 THEN pt + CAST(date_diff('day', pt, date_from) // 2 + 1 AS INTEGER) ELSE date_from END AS date_from,
    CASE WHEN date_diff('day', date_to, nf) > 1 THEN date_to + CAST(date_diff('day', date_to, nf) // 2 AS INTEGER) ELSE date_to END AS date_to FROM z""", dates=("date_from", "date_to"))
def close_gaps(spark, d):
    return sched.close_gaps(sched.merge_intervals(_spans(spark, d), ["symbol"]), ["date_from"], ["symbol"]).select("symbol", "date_from", "date_to")


_SUMMARY = f"""{BLOCKS}, kept AS (SELECT d.* FROM dated d JOIN blocks b ON b.symbol = d.symbol AND b.weekday = d.weekday AND b.f = d.f AND b.t = d.t WHERE b.recurrent),
    i1 AS (SELECT *, coalesce(date_diff('day', lag(date) OVER (PARTITION BY symbol, weekday, f, t ORDER BY date), date) > 8, TRUE) AS nw FROM kept),
    i2 AS (SELECT *, sum(CAST(nw AS INT)) OVER (PARTITION BY symbol, weekday, f, t ORDER BY date) AS run FROM i1),
    islands AS (SELECT symbol, weekday, f, t, min(date) AS date_from, max(date) AS date_to FROM i2 GROUP BY symbol, weekday, f, t, run),
    a1 AS (SELECT *, row_number() OVER w AS n, coalesce(lag(f) OVER w = f AND lag(t) OVER w = t, FALSE) AS same FROM islands WINDOW w AS (PARTITION BY symbol, weekday ORDER BY date_from, f, t)),
    a2 AS (SELECT *, sum(CAST(NOT same AS INT)) OVER (PARTITION BY symbol, weekday ORDER BY date_from, f, t) AS run FROM a1),
    adjacent AS (SELECT symbol, f, t, min(date_from) AS date_from, arg_max(date_to, n) AS date_to FROM a2 GROUP BY symbol, weekday, run, f, t),
    m1 AS (SELECT *, max(date_to) OVER (PARTITION BY symbol, f, t ORDER BY date_from, date_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM adjacent),
    m2 AS (SELECT *, sum(CASE WHEN date_diff('day', before, date_from) <= 8 THEN 0 ELSE 1 END) OVER (PARTITION BY symbol, f, t ORDER BY date_from, date_to) AS run FROM m1),
    spans AS (SELECT symbol, f, t, min(date_from) AS date_from, max(date_to) AS date_to FROM m2 GROUP BY symbol, f, t, run),
    summary AS (SELECT s.*, b.hours, b.all_day FROM spans s JOIN (SELECT symbol, f, t, max(hours) AS hours, bool_or(all_day) AS all_day FROM blocks WHERE recurrent GROUP BY ALL) b USING (symbol, f, t))"""


@query(f"""{HOURLY}, {_SUMMARY} SELECT symbol, f AS "from", t AS "to", date_from, date_to, hours, all_day FROM summary""", dates=("date_from", "date_to"))
def symbol_schedule(spark, d):
    return sched.symbol_summary(open_hours(spark, d), 60)


@query(
    f"""{HOURLY}, {_SUMMARY}, c1 AS (SELECT *, max(date_to) OVER (PARTITION BY f, t, hours ORDER BY date_from, date_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM summary WHERE NOT all_day),
    c2 AS (SELECT *, sum(CASE WHEN date_diff('day', before, date_from) <= 8 THEN 0 ELSE 1 END) OVER (PARTITION BY f, t, hours ORDER BY date_from, date_to) AS run FROM c1)
    SELECT f AS "from", t AS "to", min(date_from) AS date_from, max(date_to) AS date_to FROM c2 GROUP BY f, t, hours, run""", dates=("date_from", "date_to"))
def market_schedule(spark, d):
    return sched.consolidated(sched.symbol_summary(open_hours(spark, d), 60))


# ---------------------------------------------------------------------------------------------------- ingestion

_NY = exchange("NMS")


@query(
    """SELECT CAST(d AS DATE) AS date, strftime(timezone('America/New_York', CAST(d AS TIMESTAMP) + INTERVAL '9 hours 30 minutes') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS open,
    strftime(timezone('America/New_York', CAST(d AS TIMESTAMP) + INTERVAL 16 HOUR) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS close
    FROM generate_series(TIMESTAMP '2024-02-20', TIMESTAMP '2024-04-20', INTERVAL 1 DAY) g(d) WHERE isodow(d) <= 5""", dates=("date",))
def session_bounds(spark, d):
    out = provider.sessions(spark, _NY, "2024-02-20", "2024-04-20", temporal.dates_table(spark, HOLIDAYS[:1]))
    return out.select("date", *(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("open", "close")))


@query(
    f"""{HOURLY}, l AS (SELECT event_type AS symbol, date_trunc('hour', max(ts)) + INTERVAL 1 HOUR AS want FROM events GROUP BY 1),
    c AS (SELECT d + INTERVAL 9 HOUR AS o, d + INTERVAL 17 HOUR AS e FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-10', INTERVAL 1 DAY) g(d) WHERE isodow(d) <= 5)
    SELECT symbol, strftime(min(greatest(want, o)), '%Y-%m-%d %H:%M:%S') AS next FROM l JOIN c ON e > want GROUP BY symbol"""
)
def next_bar_time(spark, d):
    from .config import Exchange

    utc = Exchange("X", "UTC", (True,) * 5 + (False,) * 2, ("09:00", "17:00"))
    calendar = provider.sessions(spark, utc, "2024-01-01", "2024-02-10", temporal.dates_table(spark, HOLIDAYS[:1]))
    last = hourly(spark, d).groupBy("symbol").agg(F.max("datetime").alias("last"))
    return provider.next_bar(last, calendar, 60).select("symbol", F.date_format("next", "yyyy-MM-dd HH:mm:ss").alias("next"))


@query(
    f"""{HOURLY}, u AS (SELECT DISTINCT event_type AS symbol FROM events UNION SELECT 'none'), l AS (SELECT symbol, max(datetime) AS last FROM hourly GROUP BY symbol),
    s AS (SELECT symbol, coalesce(last + INTERVAL 1 HOUR, TIMESTAMP '2024-01-30 23:30:00' - INTERVAL 729 DAY) AS start FROM u LEFT JOIN l USING (symbol))
    SELECT symbol, strftime(start, '%Y-%m-%d %H:%M:%S') AS start, start > TIMESTAMP '2024-01-30 23:30:00' AS is_waiting, CAST(greatest(epoch(start) - epoch(TIMESTAMP '2024-01-30 23:30:00'), 0) AS BIGINT) AS wait_seconds FROM s"""
)
def load_cursors(spark, d):
    bars = hourly(spark, d)
    names = bars.select("symbol").distinct().union(spark.createDataFrame([("none",)], "symbol string"))
    out = provider.cursors(names, bars, "2024-01-30 23:30:00")
    return out.select("symbol", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "is_waiting", F.col("wait_seconds").cast("bigint").alias("wait_seconds"))


@query(
    f"""{HOURLY}, l AS (SELECT symbol, max(datetime) AS last FROM hourly WHERE {_AGED} GROUP BY symbol), w AS (SELECT symbol, epoch(last) + 3600 - epoch(TIMESTAMP '2024-01-05 00:00:00') AS s FROM l)
    SELECT arg_min(symbol, row(s, symbol)) AS symbol, CAST(min(s) AS BIGINT) AS wait_seconds FROM w WHERE s > 0"""
)
def shortest_wait(spark, d):
    bars = hourly(spark, d).where(F.expr(_AGED))
    return provider.shortest_wait(provider.cursors(bars.select("symbol"), bars, "2024-01-05 00:00:00")).withColumn("wait_seconds", F.col("wait_seconds").cast("bigint"))


@query(f"{HOURLY} SELECT symbol, coalesce(bool_or({_AGED} AND epoch(TIMESTAMP '2024-01-31') - epoch(datetime) <= 604800), FALSE) AS is_available FROM hourly GROUP BY symbol")
def symbol_availability(spark, d):
    bars = hourly(spark, d)
    return provider.available(bars, bars.where(F.expr(_AGED)), "2024-01-31")


@query(
    """SELECT c_name AS symbol FROM customer c WHERE NOT (NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '5-LOW') AND (c_custkey % 5 = 0 OR trim(CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE c_name END) = ''))"""
)
def symbols_to_process(spark, d):
    names = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.col("c_name").alias("symbol"), F.when(F.col("c_custkey") % 7 == 0, " ").otherwise(F.col("c_name")).alias("name"))
    seen = spark.read.parquet(f"{d}/orders.parquet").where("o_orderpriority = '5-LOW'").join(names, F.col("o_custkey") == F.col("c_custkey")).select("symbol")
    return provider.to_process(names.select("symbol", "name"), seen, names.where("c_custkey % 5 = 0")).select("symbol")


@query(
    """WITH a AS (SELECT DISTINCT o_custkey AS symbol FROM orders WHERE o_orderstatus = 'P'), b AS (SELECT DISTINCT o_custkey AS symbol FROM orders WHERE o_orderpriority = '5-LOW')
    SELECT 'union' AS op, symbol FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'difference', symbol FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'intersection', symbol FROM (SELECT * FROM a INTERSECT SELECT * FROM b)"""
)
def universe_sets(spark, d):
    from .sources import universe

    orders = spark.read.parquet(f"{d}/orders.parquet").withColumnRenamed("o_custkey", "symbol")
    a, b = orders.where("o_orderstatus = 'P'"), orders.where("o_orderpriority = '5-LOW'")
    named = lambda op, df: df.select(F.lit(op).alias("op"), "symbol")
    return named("union", universe.combined(a, b)).union(named("difference", universe.without(a, b))).union(named("intersection", universe.common(a, b)))


@query(
    """SELECT c_name AS symbol, coalesce(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_mktsegment END), ''), c_name) AS name, 'EQUITY' AS type, nullif(trim(lower(c_mktsegment)), '') AS sector,
    CAST(c_nationkey AS VARCHAR) AS industry, CASE WHEN c_custkey % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency, 'NMS' AS exchange FROM customer"""
)
def instrument_metadata(spark, d):
    info = F.create_map(
        F.lit("shortName"), F.when(F.col("c_custkey") % 3 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")), F.lit("longName"), F.col("c_name"), F.lit("quoteType"), F.lit("EQUITY"),
        F.lit("sector"), F.lower("c_mktsegment"), F.lit("industryKey"), F.col("c_nationkey").cast("string"), F.lit("currency"), F.when(F.col("c_custkey") % 2 == 0, F.lit("EUR")).otherwise(F.lit("")),
    )
    return metadata.describe(spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_name").alias("symbol"), info.alias("info")))


@query(
    """SELECT c_custkey, CAST(c_custkey * 2 AS BIGINT) AS full_time_employees, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey / 4 END AS trailing_pe,
    CASE c_custkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE END AS is_open, CASE WHEN c_custkey % 2 = 0 THEN 'a,' || CAST(c_custkey AS VARCHAR) END AS tags FROM customer"""
)
def typed_metadata(spark, d):
    key = F.col("c_custkey").cast("string")
    info = F.create_map(
        F.lit("fullTimeEmployees"), (F.col("c_custkey") * 2).cast("string"), F.lit("trailingPe"), F.when(F.col("c_custkey") % 5 == 0, F.lit("n/a")).otherwise((F.col("c_custkey") / 4).cast("string")),
        F.lit("isOpen"), F.element_at(F.array(F.lit("1.0"), F.lit("no"), F.lit(" True "), F.lit(" ")), (F.col("c_custkey") % 4 + 1).cast("int")),
        F.lit("tags"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("['a', '"), key, F.lit("']"))),
    )
    rows = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", info.alias("info"))
    out = metadata.typed(rows, {"full_time_employees": "int", "trailing_pe": "float", "is_open": "bool", "tags": "list"})
    return out.withColumn("tags", F.when(F.col("tags").isNotNull(), F.array_join("tags", ",")))


# ---------------------------------------------------------------------------------------------------- validation

BROKEN = "(SELECT symbol, datetime, open, CASE WHEN symbol = 'click' AND day(datetime) = 3 THEN low - 1 ELSE high END AS high, CASE WHEN symbol = 'view' THEN -low ELSE low END AS low, close, volume, adj_close FROM {} WHERE NOT (symbol = 'error' AND day(datetime) = 10))"


def broken(bars: DataFrame) -> DataFrame:
    high = F.when((F.col("symbol") == "click") & (F.dayofmonth("datetime") == 3), F.col("low") - 1).otherwise(F.col("high"))
    bars = bars.where(~((F.col("symbol") == "error") & (F.dayofmonth("datetime") == 10)))
    return bars.withColumn("high", high).withColumn("low", F.when(F.col("symbol") == "view", -F.col("low")).otherwise(F.col("low")))


_RULES = " ".join(f"WHEN bool_or({a} {op} {b}) THEN '{a} {op} {b}'" for a, op, b in validate.RANGE_RULES)
_SIGN = "concat_ws(', ', " + ", ".join(f"CASE WHEN bool_or({c} <= 0) THEN '{c}' END" for c in validate.PRICES) + ")"


@query(f"{HOURLY}, b AS {BROKEN.format('hourly')} SELECT * FROM (SELECT symbol, CASE {_RULES} END AS issue FROM b GROUP BY symbol) WHERE issue IS NOT NULL")
def price_range_check(spark, d):
    return validate.price_range(broken(hourly(spark, d)))


@query(f"{HOURLY}, b AS {BROKEN.format('hourly')} SELECT * FROM (SELECT symbol, {_SIGN} AS issue FROM b GROUP BY symbol) WHERE issue <> ''")
def price_sign_check(spark, d):
    return validate.price_sign(broken(hourly(spark, d)))


@query(f"{DAILY} SELECT symbol, count(*) FILTER (volume < 0) AS n_negative, count(*) FILTER (volume = 0) AS n_zero, CASE WHEN bool_or(volume < 0) THEN 'Negative volume found' END AS issue FROM daily GROUP BY symbol")
def volume_check(spark, d):
    return validate.volume(daily(spark, d))


UNEVEN = """gaps AS (SELECT symbol, CAST(datetime AS DATE) AS date, epoch(datetime) - epoch(lag(datetime) OVER (PARTITION BY symbol, CAST(datetime AS DATE) ORDER BY datetime)) AS step FROM hourly),
    uneven AS (SELECT symbol, date, stddev_pop(step) AS spread FROM gaps GROUP BY ALL HAVING stddev_pop(step) > 1800)"""


@query(f"{HOURLY}, {UNEVEN} SELECT symbol, date, {r('spread', 'spread')} FROM uneven", dates=("date",))
def delta_std_check(spark, d):
    return validate.uneven_days(hourly(spark, d), 1800).withColumn("spread", F.round("spread", 6))


@query(
    f"""{DAILY}, e AS (SELECT symbol, CAST(min(datetime) AS DATE) AS lo, CAST(max(datetime) AS DATE) AS hi FROM daily GROUP BY symbol),
    g AS (SELECT symbol, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM e)
    SELECT symbol, date FROM g WHERE isodow(date) <= 5 AND date NOT IN (SELECT date FROM {_dates_sql(HOLIDAYS)}) AND NOT EXISTS (SELECT 1 FROM daily x WHERE x.symbol = g.symbol AND CAST(x.datetime AS DATE) = g.date)""", dates=("date",))
def missing_days(spark, d):
    return validate.missing_days(daily(spark, d), temporal.dates_table(spark, HOLIDAYS))


@query(
    f"""{DAILY}, e AS (SELECT symbol, CAST(min(datetime) AS DATE) AS lo, CAST(max(datetime) AS DATE) AS hi FROM daily GROUP BY symbol),
    g AS (SELECT symbol, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 3 DAY)) AS DATE) AS date FROM e)
    SELECT symbol, date FROM g WHERE isodow(date) <= 5 AND date NOT IN (SELECT date FROM {_dates_sql(HOLIDAYS)}) AND NOT EXISTS (SELECT 1 FROM daily x WHERE x.symbol = g.symbol AND CAST(x.datetime AS DATE) = g.date)""", dates=("date",))
def missing_steps(spark, d):
    return validate.missing_steps(daily(spark, d), 3, temporal.dates_table(spark, HOLIDAYS))


REPORT = f"""b AS {BROKEN.format('hourly')}, u AS (SELECT symbol FROM (VALUES ('click'), ('view'), ('signup'), ('error'), ('none')) AS v(symbol)), {UNEVEN},
    ends AS (SELECT symbol, CAST(min(datetime) AS DATE) AS lo, CAST(max(datetime) AS DATE) AS hi FROM b GROUP BY symbol),
    grid AS (SELECT symbol, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM ends),
    gone AS (SELECT symbol, date FROM grid WHERE isodow(date) <= 5 AND date NOT IN (SELECT date FROM {_dates_sql(HOLIDAYS)}) AND NOT EXISTS (SELECT 1 FROM b x WHERE x.symbol = grid.symbol AND CAST(x.datetime AS DATE) = grid.date)),
    issues AS (SELECT DISTINCT symbol, 'Symbol not in registry' AS issue, 0 AS k FROM b WHERE symbol NOT IN (SELECT symbol FROM u)
      UNION ALL SELECT symbol, 'Historical prices are empty', 1 FROM u WHERE symbol NOT IN (SELECT symbol FROM b)
      UNION ALL SELECT symbol, 'Missing ' || count(*) || ' trading days: [' || string_agg('''' || CAST(date AS VARCHAR) || '''', ', ' ORDER BY date) || ']', 3 FROM gone GROUP BY symbol
      UNION ALL SELECT * FROM (SELECT symbol, CASE {_RULES} END AS issue, 4 FROM b GROUP BY symbol) WHERE issue IS NOT NULL
      UNION ALL SELECT * FROM (SELECT symbol, {_SIGN} AS issue, 5 FROM b GROUP BY symbol) WHERE issue <> ''
      UNION ALL SELECT symbol, 'Inconsistent intervals within ' || CAST(min(date) AS VARCHAR), 7 FROM uneven GROUP BY symbol),
    report AS (SELECT symbol, arg_min(issue, k) AS issue FROM (SELECT symbol FROM u UNION SELECT symbol FROM b) LEFT JOIN issues USING (symbol) GROUP BY symbol)"""


def _report(spark, d):
    names = spark.createDataFrame([(s,) for s in ("click", "view", "signup", "error", "none")], "symbol string")
    return validate.report(names, broken(hourly(spark, d)), temporal.dates_table(spark, HOLIDAYS), interval_seconds=1800)


@query(f"{HOURLY}, {REPORT} SELECT symbol, issue FROM report")
def validation_report(spark, d):
    return _report(spark, d)


@query(f"{HOURLY}, {REPORT} SELECT count(*) - count(issue) AS n_passed, count(issue) AS n_failed, count(issue) = 0 AS is_valid FROM report")
def validation_verdict(spark, d):
    return validate.verdict(_report(spark, d))


# ---------------------------------------------------------------------------------------------------- cross, signals, backtest

RETURNS = f"rets AS (SELECT *, close / nullif(lag(close) OVER {W}, 0) - 1 AS ret FROM daily)"


def _returns(spark, d):
    return daily(spark, d).withColumn("ret", ind.pct_change("close"))


@query(f"{DAILY}, {RETURNS} SELECT a.symbol, strftime(a.datetime, '%Y-%m-%d %H:%M:%S') AS datetime, {r('b.ret', 'base_ret')}, {r('a.ret - b.ret', 'spread')} FROM rets a LEFT JOIN rets b ON b.symbol = '1-URGENT' AND b.datetime = a.datetime")
def cross_spread(spark, d):
    return shown(trading.cross_features(_returns(spark, d), "1-URGENT"), "base_ret", "spread")


@query(
    f"""{DAILY}, {RETURNS}, j AS (SELECT a.symbol, a.datetime, a.ret AS x, b.ret AS y FROM rets a LEFT JOIN rets b ON b.symbol = '1-URGENT' AND b.datetime = a.datetime)
    SELECT {STAMP}, {r(f'CASE WHEN count(x + y) OVER {wn(5)} >= 5 THEN corr(x, y) OVER {wn(5)} END', 'corr')} FROM j WHERE symbol <> '1-URGENT'"""
)
def cross_corr(spark, d):
    return shown(trading.cross_features(_returns(spark, d), "1-URGENT").where("symbol <> '1-URGENT'"), "corr")


_NEXT = f"lead(close) OVER {W} / nullif(close, 0) - 1"
TARGET = f"CASE WHEN {_NEXT} > 0.05 THEN 2 WHEN {_NEXT} < -0.05 THEN 0 WHEN {_NEXT} IS NOT NULL THEN 1 END"


@query(f"{DAILY} SELECT {STAMP}, CAST({TARGET} AS DOUBLE) AS target FROM daily")
def label_target(spark, d):
    return shown(daily(spark, d).withColumn("target", trading.target(0.05).cast("double")), "target")


@query(f"{HOURLY} SELECT {STAMP}, CAST(timezone('America/New_York', timezone('UTC', datetime)) AS DATE) AS date FROM hourly WHERE datetime > TIMESTAMP '2024-01-05' AND datetime <= TIMESTAMP '2024-01-20' AND epoch(TIMESTAMP '2024-01-19 12:00:00') - epoch(datetime) > 4500", dates=("date",))
def cutoff_filter(spark, d):
    out = trading.cutoff(hourly(spark, d), "2024-01-19 12:00:00", "2024-01-05", "2024-01-20", S.cutoff_minutes, S.market_tz)
    return out.select("symbol", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"), "date")


@query(f"{HOURLY} SELECT {STAMP} FROM (SELECT *, max(datetime) OVER (PARTITION BY symbol, CAST(datetime AS DATE)) AS e FROM hourly) WHERE epoch(TIMESTAMP '2024-01-30 23:30:00') - epoch(e) > 4500")
def closed_days(spark, d):
    return shown(trading.closed_days(hourly(spark, d).withColumn("date", F.to_date("datetime")), "2024-01-30 23:30:00", S.cutoff_minutes))


@query(f"{DAILY} SELECT {STAMP}, {r('close', 'close')} FROM daily WHERE CAST(datetime AS DATE) >= (SELECT max(CAST(datetime AS DATE)) FROM daily) - 365")
def trailing_history(spark, d):
    return shown(trading.trailing(daily(spark, d).withColumn("date", F.to_date("datetime")), S.history_days), "close")


@query(
    f"""{DAILY}, {RETURNS}, f AS (SELECT *, {full('avg', 'close', 20)} AS m20, {full('avg', 'close', 10)} AS m10, CASE WHEN volume > 0 THEN volume END AS v FROM rets)
    SELECT {STAMP} FROM f WHERE (ret IS NOT NULL)::INT + (m20 IS NOT NULL)::INT + (m10 IS NOT NULL)::INT + (v IS NOT NULL)::INT >= 3"""
)
def null_density(spark, d):
    out = _returns(spark, d).withColumns({"m20": ind.full(F.avg, F.col("close"), 20), "m10": ind.full(F.avg, F.col("close"), 10), "v": F.when(F.col("volume") > 0, F.col("volume"))})
    return shown(trading.dense_rows(out, ["ret", "m20", "m10", "v"]))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 12)")
def min_rows_per_key(spark, d):
    return trading.frequent_keys(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey"), "o_custkey", 12)


@query(
    f"""{DAILY}, {RETURNS} SELECT 'long' AS "column", (SELECT count(x) FROM (SELECT {full('avg', 'close', 1700)} AS x FROM daily)) AS n, (SELECT count(x) FROM (SELECT {full('avg', 'close', 1700)} AS x FROM daily)) >= 500 AS is_valid
    UNION ALL SELECT 'short', (SELECT count(x) FROM (SELECT {full('avg', 'close', 20)} AS x FROM daily)), (SELECT count(x) FROM (SELECT {full('avg', 'close', 20)} AS x FROM daily)) >= 500"""
)
def feature_validity(spark, d):
    rows = daily(spark, d).withColumns({"long": ind.full(F.avg, F.col("close"), 1700), "short": ind.full(F.avg, F.col("close"), 20)})
    return trading.valid_features(rows, ["long", "short"])


@query(f"{HOURLY} SELECT p.symbol, CAST(p.date AS VARCHAR) AS date, {r('close', 'close')} FROM (SELECT DISTINCT symbol, CAST(datetime AS DATE) AS date FROM hourly WHERE day(datetime) % 2 = 0) p LEFT JOIN (SELECT symbol, CAST(datetime AS DATE) AS date, arg_max(close, datetime) AS close FROM hourly GROUP BY ALL) c USING (symbol, date)")
def outcome_lookup(spark, d):
    rows = hourly(spark, d).withColumn("date", F.to_date("datetime"))
    picks = rows.where("day(datetime) % 2 = 0").select("symbol", "date").distinct()
    return trading.outcomes(picks, rows).select("symbol", F.col("date").cast("string").alias("date"), F.round("close", 6).alias("close"))


# Chances made from the bars themselves, so that both engines have the same.
CHANCES = f"""chances AS (SELECT symbol, datetime, CAST(datetime AS DATE) AS date, close, {full('avg', 'tr', 14)} AS atr, ((CAST(floor(close) AS BIGINT) * 7919) % 101) / 100 AS u,
    ((CAST(floor(open) AS BIGINT) * 104729) % 97) / 100 AS w FROM (SELECT *, {TRUE_RANGE} AS tr FROM daily)), probs AS (SELECT *, u * w AS p_down, (1 - u) * w AS p_neutral, 1 - w AS p_up FROM chances)"""
SIGNALS = f"""{CHANCES}, kept AS (SELECT *, coalesce(atr / nullif(close, 0), 0) * (p_up - greatest(p_down, p_neutral)) AS score FROM probs WHERE p_up > 0.4), best AS (SELECT date, arg_max(symbol, row(score, symbol)) AS symbol, max(score) AS score FROM kept GROUP BY date)"""


def _signals(spark, d):
    bars = daily(spark, d).withColumn("tr", ind.true_range())
    share = lambda c, k, m: (F.floor(c).cast("bigint") * k % m) / 100
    rows = bars.withColumns({"atr": ind.full(F.avg, F.col("tr"), 14), "date": F.to_date("datetime"), "u": share("close", 7919, 101), "w": share("open", 104729, 97)})
    rows = rows.withColumns({"p_down": F.col("u") * F.col("w"), "p_neutral": (1 - F.col("u")) * F.col("w"), "p_up": 1 - F.col("w")})
    return trading.signals(rows, S.up_threshold, S.down_threshold)


@query(f"{DAILY}, {SIGNALS} SELECT date, CAST(date + CASE isodow(date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE) AS next_date, symbol, {r('score', 'score')} FROM best", dates=("date", "next_date"))
def best_signal(spark, d):
    return _signals(spark, d).withColumn("score", F.round("score", 6))


NEXT_DAY = "nexts AS (SELECT symbol, CAST(datetime AS DATE) AS date, ret, lag(CAST(datetime AS DATE)) OVER (PARTITION BY symbol ORDER BY datetime) AS pick FROM rets)"
TRADES = f"{RETURNS}, {SIGNALS}, {NEXT_DAY}, trades AS (SELECT b.symbol, n.date, b.score, n.ret FROM best b JOIN nexts n ON n.symbol = b.symbol AND n.pick = b.date)"


def _trades(spark, d):
    outcomes = _returns(spark, d).select("symbol", F.to_date("datetime").alias("date"), "ret")
    return trading.simulate_best(_signals(spark, d), outcomes)


@query(f"{DAILY}, {TRADES} SELECT symbol, date, {r('score', 'score')}, {r('ret', 'ret')} FROM trades", dates=("date",))
def simulate_best(spark, d):
    return _trades(spark, d).select("symbol", "date", F.round("score", 6).alias("score"), F.round("ret", 6).alias("ret"))


# Returns of these bars multiply to huge numbers: a thousandth of each is traded. One symbol loses everything on one day a year.
THOUSANDTH = "thousandth AS (SELECT symbol, CAST(datetime AS DATE) AS date, CASE WHEN symbol = '5-LOW' AND dayofyear(datetime) = 200 THEN -1.0 ELSE ret / 1000 END AS ret FROM rets WHERE ret IS NOT NULL)"
_LN = "CASE WHEN ret > -1 THEN ln(1 + ret) END"


def _thousandth(spark, d):
    ret = F.when((F.col("symbol") == "5-LOW") & (F.dayofyear("datetime") == 200), F.lit(-1.0)).otherwise(F.col("ret") / 1000)
    return _returns(spark, d).where("ret is not null").select("symbol", F.to_date("datetime").alias("date"), ret.alias("ret"))


_SPAN_SQL = {"last_nine_months": "9 MONTH", "last_six_months": "6 MONTH", "last_three_months": "3 MONTH", "last_one_month": "1 MONTH", "last_three_weeks": "21 DAY", "last_two_weeks": "14 DAY", "last_one_week": "7 DAY"}


def _growth_sql(inside: str, name: str) -> str:
    return r(f"CASE WHEN coalesce(bool_or({inside} AND ret <= -1), FALSE) THEN 0 ELSE exp(coalesce(sum(CASE WHEN {inside} THEN {_LN} END), 0)) END", name)


@query(
    f"{DAILY}, {RETURNS}, {THOUSANDTH}, u AS (SELECT *, max(date) OVER (PARTITION BY symbol) AS top FROM thousandth) SELECT symbol, {_growth_sql('TRUE', 'last_year')}, "
    + ", ".join(_growth_sql(f"date >= CAST(top - INTERVAL {s} AS DATE)", k) for k, s in _SPAN_SQL.items())
    + " FROM u GROUP BY symbol"
)
def growth_horizons(spark, d):
    out = trading.growth(_thousandth(spark, d), ["symbol"])
    return out.select("symbol", *(F.round(c, 6).alias(c) for c in out.columns[1:]))


@query(
    f"""{DAILY}, {RETURNS}, {THOUSANDTH}, c AS (SELECT symbol, date, CASE WHEN bool_or(ret <= -1) OVER w THEN 0 ELSE exp(coalesce(sum({_LN}) OVER w, 0)) END AS cap FROM thousandth WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)),
    p AS (SELECT *, greatest(1, max(cap) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)) AS peak FROM c) SELECT symbol, {r('max((peak - cap) / peak)', 'max_drawdown')} FROM p GROUP BY symbol"""
)
def max_drawdown(spark, d):
    return trading.drawdown(_thousandth(spark, d), ["symbol"]).withColumn("max_drawdown", F.round("max_drawdown", 6))


@query(f"{DAILY}, {RETURNS}, {THOUSANDTH} SELECT symbol, {r('coalesce(sum(CASE WHEN ret > 0 THEN ret ELSE 0 END) / nullif(sum(CASE WHEN ret < 0 THEN -ret ELSE 0 END), 0), 0)', 'profit_factor')} FROM thousandth GROUP BY symbol")
def profit_factor(spark, d):
    return _thousandth(spark, d).groupBy("symbol").agg(F.round(trading.profit_factor(), 6).alias("profit_factor"))


@query(
    f"""{DAILY}, {RETURNS}, t AS (SELECT symbol, CAST(datetime AS DATE) AS date, ret, CASE WHEN lag(ret) OVER {W} < 0 THEN 2 ELSE 0 END AS predicted FROM rets)
    SELECT symbol, date, predicted, {r('CASE WHEN predicted = 2 THEN ret ELSE 0 END', 'ret')} FROM t""", dates=("date",))
def simulate_one(spark, d):
    rows = _returns(spark, d).withColumn("predicted", F.when(F.lag("ret").over(ind.by_time()) < 0, trading.UP).otherwise(trading.DOWN))
    rows = rows.select("symbol", F.to_date("datetime").alias("date"), "predicted", "ret")
    return trading.simulate_one(rows).withColumn("ret", F.round("ret", 6)).select("symbol", "date", "predicted", "ret")


GUESSES = f"{RETURNS}, guesses AS (SELECT {TARGET} AS target, CASE WHEN ret > 0.05 THEN 0 WHEN ret < -0.05 THEN 2 ELSE 1 END AS predicted FROM rets), known AS (SELECT * FROM guesses WHERE target IS NOT NULL)"


def _guesses(spark, d):
    rows = _returns(spark, d).withColumn("target", trading.target(0.05))
    guess = F.when(F.col("ret") > 0.05, 0).when(F.col("ret") < -0.05, 2).otherwise(1)
    return rows.select("target", guess.alias("predicted")).where("target is not null")


@query(f"{DAILY}, {GUESSES} SELECT target, predicted, count(*) AS n, {r('count(*) / sum(count(*)) OVER (PARTITION BY target)', 'share')} FROM known GROUP BY target, predicted")
def confusion_matrix(spark, d):
    return trading.confusion(_guesses(spark, d)).withColumn("share", F.round("share", 6))


@query(
    f"""{DAILY}, {GUESSES}, l AS (SELECT target AS label FROM known UNION SELECT predicted FROM known),
    c AS (SELECT label, count(*) FILTER (target = label AND predicted = label) AS hits, count(*) FILTER (predicted = label) AS guessed, count(*) FILTER (target = label) AS support FROM known, l GROUP BY label),
    q AS (SELECT *, coalesce(hits / nullif(guessed, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS rc FROM c)
    SELECT label, {r('p', 'precision')}, {r('rc', 'recall')}, {r('coalesce(2 * p * rc / nullif(p + rc, 0), 0)', 'f1')}, support, {r('(SELECT count(*) FILTER (target = predicted) / count(*) FROM known)', 'accuracy')} FROM q"""
)
def class_report(spark, d):
    out = trading.class_report(_guesses(spark, d))
    return out.select("label", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")), "support", F.round("accuracy", 6).alias("accuracy"))


# ---------------------------------------------------------------------------------------------------- learning, streaming, all together


@query(f"{DAILY}, {GUESSES} SELECT target, min(count(*)) OVER () AS n, min(count(*)) OVER () AS n_different FROM known GROUP BY target")
def undersample(spark, d):
    rows = daily(spark, d).withColumn("target", trading.target(0.05))
    some = trading.undersample(rows, "target")
    return some.groupBy("target").agg(F.count("*").alias("n"), F.count_distinct("symbol", "datetime").alias("n_different"))


@query(f"{DAILY} SELECT DISTINCT symbol, CAST(CAST('0x' || md5(symbol)[1:8] AS BIGINT) % 3 AS INTEGER) AS fold FROM daily")
def group_folds(spark, d):
    return daily(spark, d).select("symbol", trading.group_folds("symbol", 3).alias("fold")).distinct()


@query(f"{DAILY} SELECT date, CAST(ntile(6) OVER (ORDER BY date) - 1 AS INTEGER) AS fold FROM (SELECT DISTINCT CAST(datetime AS DATE) AS date FROM daily)", dates=("date",))
def time_folds(spark, d):
    return trading.time_folds(daily(spark, d).select(F.to_date("datetime").alias("date")), S.n_splits)


@query(None)
def ml_pipeline(spark, d):
    from .operators import learning

    rows = plan.window_features(daily(spark, d), S).withColumn("target", trading.target(0.05).cast("double"))
    names = ["intraday_return", "volatility", "williams_r", "rsi", "bollinger_pct_b", "stoch_rsi"]
    rows = rows.dropna(subset=[*names, "target"]).select("symbol", "datetime", "target", *names)
    before = rows.where("datetime < '2000-06-01'")
    model = learning.fit(before, names, ["symbol"], numTrees=10)
    return model.transform(rows.where("datetime >= '2000-06-01'")).select("symbol", "datetime", "target", "prediction")


@query(None)
def train_and_evaluate(spark, d):
    from .operators import learning

    rows = plan.window_features(daily(spark, d), S).withColumn("target", trading.target(0.05).cast("double"))
    names = ["intraday_return", "volatility", "williams_r", "rsi"]
    rows = rows.dropna(subset=[*names, "target"]).select("symbol", "datetime", "target", *names)
    return learning.train_and_evaluate(rows, "2000-06-01", names, numTrees=10)[1]


@query(f"{HOURLY} SELECT {STAMP}, {_OHLCV} FROM hourly")
def stream_bars(spark, d):
    """Hourly bars of a stream that reads the table as files, run to its end; each batch's changes go to a table."""
    from .streaming.bars import stream_bars as bars_of

    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    ticks = stream.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.col("event_id").alias("id"), size("event_id").alias("size"))
    table = staging.new_folder(spark, "stream")
    # Every trigger's changed bars are written, not kept in memory; of a bar's versions the last batch's counts.
    keep = lambda rows, batch: rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{table}/bars/batch_of={batch}")
    run = bars_of(ticks).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{table}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    rows = spark.read.parquet(f"{table}/bars")
    last = F.max_by(F.struct(*_BAR), "batch").alias("r")
    return shown(rows.groupBy("symbol", "datetime").agg(last).select("symbol", "datetime", "r.*"), *_BAR)


_EASE = "CASE WHEN a = b THEN 0 ELSE ({} - a) / (b - a) END"


@query(
    f"""{DAILY}, g AS (SELECT min(low) AS a, max(high) AS b, min(volume) AS va, max(volume) AS vb FROM daily),
    sc AS (SELECT symbol, datetime, {', '.join(f'{_EASE.format(c)} AS {c}' for c in ('open', 'high', 'low', 'close'))},
      CASE WHEN volume > 0 THEN CASE WHEN va = vb THEN 0 ELSE (volume - va) / (vb - va) END ELSE 0 END AS volume, close AS raw_close FROM daily, g),
    x AS ({GAINS} sc), y AS ({GAINS.replace('gain', 'raw_gain').replace('loss', 'raw_loss').replace('close', 'raw_close')} x),
    z AS (SELECT symbol, datetime, {r('close', 'close')}, {r('volume', 'volume')}, {r(rsi_sql(6), 'rsi')}, {r(rsi_sql(6).replace('gain', 'raw_gain').replace('loss', 'raw_loss'), 'raw_rsi')}, {r('raw_close', 'raw_close')},
      {r(f"-100 * ({full('max', 'high', 14)} - close) / nullif({full('max', 'high', 14)} - {full('min', 'low', 14)}, 0)", 'williams_r')},
      {r('CASE WHEN close > open THEN 1 WHEN close < open THEN 0 ELSE 0.5 END', 'open_close_result')}, {r(_YEAR, 'time_of_year')} FROM y),
    kept AS (SELECT * FROM z WHERE isodow(datetime) <= 5 AND CAST(datetime AS DATE) NOT IN (SELECT date FROM {_dates_sql(HOLIDAYS)})),
    f AS (SELECT max(m) AS start FROM (SELECT min(datetime) AS m FROM kept GROUP BY symbol))
    SELECT * REPLACE (strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime) FROM kept WHERE datetime >= (SELECT start FROM f)"""
)
def enrich_untrimmed(spark, d):
    out = plan.enrich(daily(spark, d), temporal.dates_table(spark, HOLIDAYS), temporal.dates_table(spark, EVENTS), trim=False)
    out = out.withColumns({"raw_close": F.col("raw.close"), "raw_rsi": F.col("raw.rsi")})
    return shown(out, "close", "volume", "rsi", "raw_rsi", "raw_close", "williams_r", "open_close_result", "time_of_year")


_NAMED = MULTI.removeprefix(HOURLY).replace(f"{SHAPE} hourly", f"{SHAPE} m")
_FLAT = "(max({0}) OVER f - min({0}) OVER f)"
#: Raw and scaled bars as two series, with every recurrence; a row is bad if any feature that counts for the trim has no value.
ENRICHED = f"""{DAILY}, g AS (SELECT min(low) AS a, max(high) AS b, min(volume) AS va, max(volume) AS vb FROM daily),
    u AS (SELECT symbol AS name, 0 AS scaled, symbol || '#0' AS symbol, datetime, open, high, low, close, volume FROM daily UNION ALL
      SELECT symbol, 1, symbol || '#1', datetime, {', '.join(_EASE.format(c) for c in ('open', 'high', 'low', 'close'))}, CASE WHEN volume > 0 THEN CASE WHEN va = vb THEN 0 ELSE (volume - va) / (vb - va) END ELSE 0 END FROM daily, g),
    gl AS ({GAINS} u), x AS (SELECT *, {TRUE_RANGE} AS tr, high - lag(high) OVER {W} AS upm, lag(low) OVER {W} - low AS downm, row_number() OVER {W} AS rn, lag(close) OVER {W} AS before FROM gl),
    m AS (SELECT *, CASE WHEN upm > downm AND upm > 0 THEN upm ELSE 0 END AS pdm, CASE WHEN downm > upm AND downm > 0 THEN downm ELSE 0 END AS mdm, {rsi_sql(14)} AS q FROM x),
    {_wilder_sql('wt', 'm', 'tr', 14, 'atr')}, {_wilder_sql('wp', 'm', 'pdm', 14, 'p')}, {_wilder_sql('wm', 'm', 'mdm', 14, 'q')},
    dx AS (SELECT m.symbol, m.datetime, m.rn, 100 * abs(100 * wp.p / nullif(wt.atr, 0) - 100 * wm.q / nullif(wt.atr, 0)) / nullif(100 * wp.p / nullif(wt.atr, 0) + 100 * wm.q / nullif(wt.atr, 0), 0) AS dx
      FROM m LEFT JOIN wt ON wt.symbol = m.symbol AND wt.rn = m.rn LEFT JOIN wp ON wp.symbol = m.symbol AND wp.rn = m.rn LEFT JOIN wm ON wm.symbol = m.symbol AND wm.rn = m.rn),
    {_wilder_sql('wa', 'dx', 'dx', 14, 'adx')},
    e AS (SELECT symbol, rn, close AS fast, close AS slow, 0.0::DOUBLE AS s FROM m WHERE rn = 1 UNION ALL
      SELECT symbol, rn, a, b, s + (2.0 / 10) * ((a - b) - s) FROM (SELECT m.symbol, m.rn, e.fast + (2.0 / 13) * (m.close - e.fast) AS a, e.slow + (2.0 / 27) * (m.close - e.slow) AS b, e.s
        FROM e JOIN m ON m.symbol = e.symbol AND m.rn = e.rn + 1)){_NAMED},
    joined AS (SELECT multi.*, wt.atr AS atr_14d, wa.adx AS adx_14d, (e.fast - e.slow) - e.s AS macd FROM multi LEFT JOIN wt ON wt.symbol = multi.symbol AND wt.rn = multi.rn
      LEFT JOIN wa ON wa.symbol = multi.symbol AND wa.rn = multi.rn LEFT JOIN e ON e.symbol = multi.symbol AND e.rn = multi.rn),
    every AS (SELECT *, {rsi_sql(6)} AS rsi, {full('avg', 'tr', 14)} AS atr,
      sum(CASE WHEN close < before THEN -volume ELSE volume END) OVER (PARTITION BY symbol ORDER BY datetime ROWS UNBOUNDED PRECEDING) AS obv,
      (q - min(q) OVER f) / nullif({_FLAT.format('q')}, 0) AS stoch_rsi, CASE WHEN m IS NOT NULL THEN coalesce({_scores_sql('m', MULTI_SCORES)}, round(1e-6 + (sc + sc1 + sc2) / 3 * (1 - 2e-6), 3)) END AS msc,
      max(high) OVER f - min(low) OVER f AS reach, stddev_pop(close) OVER {wn(20)} AS sd
      FROM joined WINDOW f AS {wn(14)}),
    flagged AS (SELECT *, rn < 20 OR open = 0 OR before = 0 OR reach = 0 OR sd = 0 OR rsi IS NULL OR stoch_rsi IS NULL OR atr_14d IS NULL OR adx_14d IS NULL OR m IS NULL AS bad FROM every),
    last_bad AS (SELECT name, max(rn) FILTER (bad) AS bad FROM flagged GROUP BY name),
    kept AS (SELECT a.*, b.close AS s_close, b.volume AS s_volume, b.atr AS s_atr, b.rsi AS s_rsi, b.macd AS s_macd, b.obv AS s_obv, b.adx_14d AS s_adx, b.atr_14d AS s_atr_14d, b.sc AS s_sc, b.msc AS s_msc, b.stoch_rsi AS s_stoch
      FROM flagged a JOIN flagged b ON b.name = a.name AND b.datetime = a.datetime AND a.scaled = 0 AND b.scaled = 1 JOIN last_bad l ON l.name = a.name
      WHERE a.rn > coalesce(l.bad, 0) AND isodow(a.datetime) <= 5 AND CAST(a.datetime AS DATE) NOT IN (SELECT date FROM {_dates_sql(HOLIDAYS)})),
    st AS (SELECT max(m) AS start FROM (SELECT min(datetime) AS m FROM kept GROUP BY name)),
    near AS (SELECT k.name, k.datetime, max(date_diff('day', CAST(k.datetime AS DATE), v.date)) AS ahead FROM kept k JOIN {_dates_sql(HOLIDAYS)} ON date_diff('day', CAST(k.datetime AS DATE), v.date) BETWEEN 1 AND 5 GROUP BY ALL)"""


@query(
    f"""{ENRICHED} SELECT name AS symbol, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, {r('s_close', 'close')}, {r('s_volume', 'volume')}, {r('s_atr', 'atr')}, {r('s_rsi', 'rsi')}, {r('s_macd', 'macd')}, {r('s_obv', 'obv')},
    {r('s_adx', 'adx_14d')}, {r('s_atr_14d', 'atr_14d')}, {r('s_sc', 'candle_pattern')}, {r('s_msc', 'multi_candle_pattern')}, {r('s_stoch', 'stoch_rsi')}, {r(_YEAR, 'time_of_year')}, {r('coalesce((6 - ahead) / 5, 0)', 'is_pre_holiday')},
    {r('close', 'raw_close')}, p AS raw_candle_pattern, m AS raw_multi_candle_pattern, {r('rsi', 'raw_rsi')}, round(macd, 3) + 0.0 AS raw_macd, {r('adx_14d', 'raw_adx_14d')} FROM kept LEFT JOIN near USING (name, datetime) WHERE datetime >= (SELECT start FROM st)"""
)
def enrich(spark, d):
    out = plan.enrich(daily(spark, d), temporal.dates_table(spark, HOLIDAYS), temporal.dates_table(spark, EVENTS))
    names = ("close", "volume", "atr", "rsi", "macd", "obv", "adx_14d", "atr_14d", "candle_pattern", "multi_candle_pattern", "stoch_rsi", "time_of_year", "is_pre_holiday")
    raw = {f"raw_{c}": F.col(f"raw.{c}") for c in ("close", "candle_pattern", "multi_candle_pattern", "rsi", "adx_14d")} | {"raw_macd": F.round("raw.macd", 3)}
    return shown(out.withColumns(raw), *names, *raw)


_HEADS = """CASE WHEN c_custkey % 3 = 0 THEN '  ' WHEN c_custkey % 3 = 1 THEN concat(' ', c_name, ' ') END AS id, CASE WHEN c_custkey % 4 > 1 THEN concat('2024-01-1', CAST(c_nationkey % 10 AS VARCHAR(1)), 'T00:00:00') WHEN c_custkey % 4 = 1 THEN 'never' END AS last_updated,
    CASE WHEN c_custkey % 5 > 2 THEN concat('2024-02-1', CAST(c_nationkey % 10 AS VARCHAR(1)), 'T12:30:00') END AS last_check"""


@query(
    f"""WITH h AS (SELECT c_custkey AS k, {_HEADS} FROM customer), x AS (SELECT *, nullif(trim(id), '') AS known, coalesce(try_cast(last_check AS TIMESTAMP), TIMESTAMP '2024-03-01 00:00:00') AS ck FROM h)
    SELECT coalesce(known, 'new') AS id, strftime(CASE WHEN known IS NULL THEN TIMESTAMP '2024-03-01 00:00:00' ELSE coalesce(try_cast(last_updated AS TIMESTAMP), ck) END, '%Y-%m-%d %H:%M:%S') AS last_updated,
    strftime(ck, '%Y-%m-%d %H:%M:%S') AS last_check, 0 AS n_symbols FROM x"""
)
def raw_defaults(spark, d):
    """Headers with blank, absent and unreadable fields, as a load completes them."""
    from .sources import dataset

    heads = spark.read.parquet(f"{d}/customer.parquet").selectExpr(*(x.strip() for x in _HEADS.replace("AS id, ", "AS id;").replace("AS last_updated,", "AS last_updated;").split(";")))
    documents = heads.select("*", F.lit("1h").alias("interval"), F.lit(None).cast(dataset.DOCUMENT["symbols"].dataType).alias("symbols"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return dataset.with_defaults(documents, "2024-03-01 00:00:00", "new").select("id", stamp("last_updated"), stamp("last_check"), F.size("symbols").alias("n_symbols"))


@query(
    f"""WITH ticks AS (SELECT event_type AS symbol, ts, event_id AS id, value FROM events), want AS (SELECT DISTINCT symbol, CAST(ts AS DATE) + 1 AS date FROM ticks)
    SELECT w.symbol, w.date, arg_max(id, row(ts, id)) AS id, {r('arg_max(value, row(ts, id))', 'value')} FROM want w JOIN ticks t ON t.symbol = w.symbol AND CAST(t.ts AS DATE) <= w.date GROUP BY 1, 2""", dates=("date",))
def last_as_of(spark, d):
    """For the day after each day with ticks, the last tick up to it."""
    rows = event_ticks(spark, d)
    last = rows.groupBy("symbol", "ts").agg(F.max_by(F.struct("id", "price"), "id").alias("t")).select("symbol", F.col("ts").alias("datetime"), "t.*")
    days = rows.select("symbol", F.date_add(F.to_date("ts"), 1).alias("date")).distinct()
    return trading.as_of(last, days).select("symbol", "date", "r.id", F.round("r.price", 6).alias("value"))
