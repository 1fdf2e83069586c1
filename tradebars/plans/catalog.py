"""Registered queries, one for each operator and for the composed jobs, each with its DuckDB counterpart.

Every query works on trades derived from a whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradebars.functions import trades as X
from tradebars.functions.tables import written
from tradebars.operators import bars as B
from tradebars.operators import incremental as I
from tradebars.operators import quality as Q
from tradebars.operators import thresholds as H
from tradebars.plans import jobs, sql
from tradebars.plans.fixtures import from_busy, from_lineitem, from_sparse
from tradebars.plans.registry import METRICS, QUERIES, SQL, Query, query

def _limits(t: DataFrame) -> DataFrame:
    return H.thresholds(t, sql.WINDOW, sql.CAPACITY, sql.BOOTSTRAP)


def _bars(t: DataFrame) -> DataFrame:
    return B.hourly_bars(H.classify(t, _limits(t)))


def _filled(t: DataFrame) -> DataFrame:
    return Q.fill_gaps(written(_bars(t)), sql.MAX_GAP)


def _plain(*columns: str) -> tuple[Callable[[DataFrame], DataFrame], str]:
    shown = ", ".join(c if c in B.SUMS and ("count" in c or c == "n_trades") else f"round({c}, 4) AS {c}" for c in columns)
    return (lambda t: B.hourly_bars(t).select("symbol", "time", *columns)), sql.whale(f"SELECT symbol, time, {shown} FROM bars")


# Scalar functions and filters

_EPOCH = "CASE WHEN agg_id % 2 = 0 THEN epoch_us(time) // 1000 ELSE epoch_us(time) END"


@query("p1_epoch_unit", sql.say(f"SELECT agg_id, {_EPOCH} AS epoch, CASE WHEN {_EPOCH} > 1000000000000000 THEN make_timestamp({_EPOCH}) ELSE make_timestamp({_EPOCH} * 1000) END AS time FROM t"))
def _p1(t):
    epoch = F.when(F.col("agg_id") % 2 == 0, F.unix_millis("time")).otherwise(F.unix_micros("time"))
    return t.select("agg_id", epoch.alias("epoch")).withColumn("time", X.epoch_to_time(F.col("epoch")))


@query("p2_taker_side", sql.say("SELECT agg_id, NOT is_buyer_maker AS is_buy, is_buyer_maker AS is_sell FROM t"))
def _p2(t):
    return t.select("agg_id", X.is_buy().alias("is_buy"), (~X.is_buy()).alias("is_sell"))


@query("p3_notional", sql.say("SELECT agg_id, round(price * qty, 4) AS notional FROM t"))
def _p3(t):
    return t.select("agg_id", X.notional().alias("notional"))


@query("p4_calendar", sql.say("SELECT agg_id, date_trunc('hour', time) AS hour, CAST(time AS DATE) AS date, minute(time) AS minute FROM t"))
def _p4(t):
    return t.select("agg_id", X.hour_of().alias("hour"), X.day_of().alias("date"), X.minute_of().alias("minute"))


@query("p5_month_bars", sql.whale(f"SELECT {METRICS}, strftime(time, '%Y-%m') AS month FROM bars WHERE strftime(time, '%Y-%m') = (SELECT min(strftime(time, '%Y-%m')) FROM t)"))
def _p5(t):
    first = t.agg(F.min(X.month_of())).first()[0]
    return I.bars_of_month(_bars(t), first or "1970-01").withColumn("month", X.month_of())


@query("p6_months", sql.say("SELECT strftime(unnest(generate_series(date_trunc('month', min(time)), date_trunc('month', max(time)), INTERVAL 1 MONTH)), '%Y-%m') AS month FROM t", source="lineitem"), source=from_lineitem)
def _p6(t):
    ends = t.agg(F.min(X.month_of()).alias("low"), F.max(X.month_of()).alias("high")).first()
    return I.months(t.sparkSession, ends.low, ends.high)


@query("p7_volumes", sql.whale("SELECT symbol, time, round(buy_vol - sell_vol, 4) AS net_volume, round(buy_vol + sell_vol, 4) AS total_volume FROM bars"))
def _p7(t):
    return B.hourly_bars(t).select("symbol", "time", X.net_volume().alias("net_volume"), X.total_volume().alias("total_volume"))


@query("p8_lerp", sql.say("SELECT agg_id, round(price + 0.25 * (qty - price), 4) AS between_double, CAST(trunc(agg_id + 0.25::DOUBLE * (minute(time) - agg_id)) AS BIGINT) AS between_int FROM t"))
def _p8(t):
    return t.select("agg_id", X.lerp(F.col("price"), F.col("qty"), F.lit(0.25)).alias("between_double"), X.lerp_int(F.col("agg_id"), X.minute_of(), F.lit(0.25)).alias("between_int"))


# Joins


@query("j1_classify", sql.say("SELECT t.symbol, agg_id, l.date, qty >= p99 AS is_whale_p99, qty >= p999 AS is_whale_p999 FROM t JOIN limits l ON l.symbol = t.symbol AND l.date = CAST(t.time AS DATE)", sql.limits()))
def _j1(t):
    return H.classify(t, _limits(t)).select("symbol", "agg_id", "date", "is_whale_p99", "is_whale_p999")


@query("j2_lookback", sql.say("SELECT n.symbol, n.date, p.date AS prior FROM numbered n JOIN numbered p ON p.symbol = n.symbol AND p.day BETWEEN n.day - 7 AND n.day - 1", sql.limits(), source="lineitem"), source=from_lineitem)
def _j2(t):
    return H.lookback(H.dated(t))


_COMPLETED = "m AS (SELECT DISTINCT symbol, strftime(time, '%Y-%m') AS month FROM t), done AS (SELECT symbol, month FROM m WHERE month < '1995-07')"


@query("j3_pending_months", sql.say("SELECT symbol, month FROM m WHERE (symbol, month) NOT IN (SELECT (symbol, month) FROM done)", _COMPLETED, source="lineitem"), source=from_lineitem)
def _j3(t):
    wanted = t.select("symbol", X.month_of().alias("month")).distinct()
    return I.pending(wanted, wanted.where("month < '1995-07'"))


@query("j4_hour_spine", sql.whale("SELECT s.symbol, s.time, coalesce(b.n_trades, 0) AS n_trades, b.n_trades IS NOT NULL AS has_bar FROM hours s LEFT JOIN bars b ON b.symbol = s.symbol AND b.time = s.time", sql.filled()))
def _j4(t):
    bars = B.hourly_bars(t)
    joined = Q.spine(bars).join(bars.select("symbol", "time", "n_trades"), ["symbol", "time"], "left")
    return joined.select("symbol", "time", F.coalesce("n_trades", F.lit(0)).alias("n_trades"), F.col("n_trades").isNotNull().alias("has_bar"))


# Aggregations

for _name, _columns in {
    "a1_hourly_flow": ("buy_vol", "sell_vol", "n_trades", "buy_count", "sell_count", "buy_vol_usd", "sell_vol_usd"),
    "a3_half_hours": ("vol_first_30min", "vol_last_30min"),
    "a4_largest_trade": ("max_trade_size",),
    "a5_vwap": ("vwap",),
    "a6_price_std": ("price_std",),
}.items():
    _f, _oracle = _plain(*_columns)
    query(_name, _oracle)(_f)

_WHALE = [m for m in B.SUMS if m.startswith("whale")]


@query("a2_whale_flow", sql.whale("SELECT symbol, time, " + ", ".join(m if "count" in m else f"round({m}, 4) AS {m}" for m in _WHALE) + " FROM bars"))
def _a2(t):
    return _bars(t).select("symbol", "time", *_WHALE)


@query("a7_percentiles", sql.say("SELECT symbol, CAST(time AS DATE) AS date, round(quantile_cont(qty, 0.99), 6) AS p99, round(quantile_cont(qty, 0.999), 6) AS p999 FROM t GROUP BY 1, 2"), digits=6)
def _a7(t):
    return H.percentiles(H.histogram(t), ["symbol", "date"], freq="freq")


@query("a8_merge_bars", sql.whale(f"SELECT {METRICS} FROM bars"))
def _a8(t):
    flagged = H.classify(t, _limits(t))
    return B.finish(B.merge_bars(*[B.partial_bars(flagged.where(F.col("agg_id") % 3 == k)) for k in range(3)]))


@query("a9_daily_sample", sql.say('SELECT s.symbol, s.date, s.agg_id, round(s.qty, 6) AS qty, c."count" FROM sample s JOIN (SELECT symbol, CAST(time AS DATE) AS date, count(*) AS "count" FROM t GROUP BY 1, 2) c USING (symbol, date)', sql.limits()), digits=6)
def _a9(t):
    return H.daily_sample(t, sql.CAPACITY).join(H.day_counts(t), ["symbol", "date"])


@query("a10_merge_samples", sql.say("SELECT symbol, date, agg_id, round(qty, 6) AS qty FROM sample", sql.limits()), digits=6)
def _a10(t):
    halves = [H.daily_sample(t.where(F.col("agg_id") % 2 == k), sql.CAPACITY) for k in (0, 1)]
    return H.merge_samples(*halves, sql.CAPACITY)


@query("a11_rolling_thresholds", sql.say("SELECT symbol, date, round(p99, 6) AS p99, round(p999, 6) AS p999 FROM rolling", sql.limits(None), source="lineitem"), source=from_lineitem, digits=6)
def _a11(t):
    return H.rolling(H.histogram(t), H.dated(t), sql.WINDOW)


@query("a12_bootstrap", sql.say("SELECT symbol, date, round(p99, 6) AS p99, round(p999, 6) AS p999 FROM boot", sql.limits(bootstrap=60)), digits=6)
def _a12(t):
    return H.bootstrap(t, 60)


@query("a13_thresholds", sql.say("SELECT symbol, date, round(p99, 6) AS p99, round(p999, 6) AS p999, source FROM limits", sql.limits()), digits=6)
def _a13(t):
    return _limits(t)


@query("a14_whale_flags", sql.say("SELECT t.symbol, CAST(time AS DATE) AS date, count(*) FILTER (qty >= p99) AS n_p99, count(*) FILTER (qty >= p999) AS n_p999 FROM t JOIN limits l ON l.symbol = t.symbol AND l.date = CAST(t.time AS DATE) GROUP BY 1, 2", sql.limits(), source="lineitem"), source=from_lineitem)
def _a14(t):
    flagged = H.classify(t, _limits(t))
    return flagged.groupBy("symbol", "date").agg(F.count_if("is_whale_p99").alias("n_p99"), F.count_if("is_whale_p999").alias("n_p999"))


@query("a15_state_stats", sql.say("SELECT symbol, count(*) AS n_dates, CAST(sum(least(c, 20)) AS BIGINT) AS n_samples FROM (SELECT symbol, CAST(time AS DATE) AS date, count(*) AS c FROM t GROUP BY 1, 2) GROUP BY 1"))
def _a15(t):
    return H.state_stats(H.day_counts(t), sql.CAPACITY)


@query("a16_summary", sql.whale("SELECT symbol, min(time) AS first_time, max(time) AS last_time, count(*) AS n_hours, CAST(sum(n_trades) AS BIGINT) AS n_trades, round(sum(buy_vol + sell_vol), 4) AS volume FROM bars GROUP BY 1"))
def _a16(t):
    return B.summary(B.hourly_bars(t))


@query("a17_progress", sql.whale("SELECT b.symbol, count(*) FILTER (d.month IS NULL) AS n_pending, count(*) FILTER (d.month IS NOT NULL) AS n_finalized, CAST(min(time) AS DATE) AS first_date, CAST(max(time) AS DATE) AS last_date FROM bars b LEFT JOIN done d ON d.symbol = b.symbol AND d.month = strftime(b.time, '%Y-%m') GROUP BY 1", _COMPLETED, source="lineitem"), source=from_lineitem)
def _a17(t):
    bars = B.hourly_bars(t)
    return B.progress(bars, bars.select("symbol", X.month_of().alias("month")).distinct().where("month < '1995-07'"))


@query("a18_month_results", sql.whale("SELECT symbol, strftime(time, '%Y-%m') AS month, count(*) AS n_hours, CAST(sum(n_trades) AS BIGINT) AS n_trades FROM bars GROUP BY 1, 2", source="lineitem"), source=from_lineitem)
def _a18(t):
    return B.month_results(B.hourly_bars(t))


# Data quality


@query("w1_enough_history", sql.say("SELECT symbol, date, day > 7 AS has_enough FROM numbered", sql.limits()))
def _w1(t):
    return H.enough_history(H.dated(t), sql.WINDOW)


@query("w2_retention", sql.say("SELECT symbol, date FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r FROM days) WHERE r <= 8 OR date >= DATE '1998-10-01'", sql.limits(), source="lineitem"), source=from_lineitem)
def _w2(t):
    return H.retained(H.dated(t), F.lit("1998-10-01").cast("date"), sql.WINDOW)


_TWICE = "bars AS (SELECT symbol, date_trunc('hour', time) AS time, count(*) AS n_trades FROM t GROUP BY symbol, date_trunc('hour', time), is_buyer_maker)"


def _repeated(t):
    """A bar for each side, so that hours repeat."""
    return t.groupBy("symbol", X.hour_of().alias("time"), "is_buyer_maker").agg(F.count("*").alias("n_trades"))


@query("w3_duplicates", sql.say("SELECT symbol, count(*) - count(DISTINCT time) AS n_duplicates FROM bars GROUP BY 1", _TWICE))
def _w3(t):
    return Q.duplicates(_repeated(t))


@query("w4_coverage", sql.say("SELECT symbol, date_diff('hour', min(time), max(time)) + 1 AS n_expected, count(DISTINCT time) AS n_hours, date_diff('hour', min(time), max(time)) + 1 - count(DISTINCT time) AS n_missing FROM bars GROUP BY 1", _TWICE))
def _w4(t):
    return Q.coverage(_repeated(t))


@query("w5_gaps", sql.whale('SELECT symbol, start, "end", duration_hours FROM gaps', sql.VERDICT))
def _w5(t):
    return Q.gaps(B.hourly_bars(t))


@query("w6_low_activity", sql.whale(f"SELECT symbol, count(*) FILTER (n_trades < {sql.MIN_TRADES}) AS n_low_activity FROM bars GROUP BY 1"))
def _w6(t):
    return Q.low_activity(B.hourly_bars(t), sql.MIN_TRADES)


_REPORT = "symbol, n_expected, n_hours, n_missing, n_duplicates, n_gaps, n_low_activity, is_valid, issues"


@query("w7_verdict", sql.say(f"SELECT {_REPORT} FROM verdict", _TWICE, sql.VERDICT))
def _w7(t):
    return Q.verdict(_repeated(t), sql.MIN_TRADES)


@query("w8_gap_places", sql.whale("SELECT symbol, time, gap AS gap_hours, place AS gap_place FROM gapped WHERE gap IS NOT NULL", sql.filled()))
def _w8(t):
    return Q.neighbours(B.hourly_bars(t)).where("gap_hours is not null").select("symbol", "time", "gap_hours", "gap_place")


@query("w9_fill", sql.whale(f"SELECT {METRICS}, fill_kind FROM filled", sql.filled()))
def _w9(t):
    return _filled(t)


@query("w10_fill_counts", sql.whale("SELECT symbol, count(*) FILTER (fill_kind = 'interpolated') AS n_small_filled, count(*) FILTER (fill_kind = 'zero') AS n_large_hours FROM filled GROUP BY 1", sql.filled()))
def _w10(t):
    return Q.fill_counts(_filled(t))


@query("w11_trim", sql.whale(f"SELECT {METRICS}, fill_kind FROM trimmed", sql.filled(), sql.TRIMMED))
def _w11(t):
    return Q.trim_warmup(_filled(t))


@query("w12_order", sql.whale("SELECT symbol, time, row_number() OVER (PARTITION BY symbol ORDER BY time) AS place FROM bars"))
def _w12(t):
    return B.hourly_bars(t).select("symbol", "time", F.row_number().over(Window.partitionBy("symbol").orderBy("time")).alias("place"))


# Sets of months and composed jobs


@query("i1_union_bars", sql.whale(f"SELECT {METRICS} FROM bars"))
def _i1(t):
    bars = _bars(t)
    half = F.lit("2024-01-16").cast("timestamp")
    return I.union_bars(bars.where(F.col("time") < half), bars.where(F.col("time") >= half))


@query("hourly_bars", sql.say(f"SELECT {METRICS} FROM bars", "limits AS (SELECT DISTINCT symbol, CAST(time AS DATE) AS date, CAST('inf' AS DOUBLE) AS p99, CAST('inf' AS DOUBLE) AS p999 FROM t)", sql.bars(), source="lineitem"), source=from_lineitem)
def _hourly(t):
    return B.hourly_bars(t)


@query("whale_bars", sql.whale(f"SELECT {METRICS} FROM bars"))
def _whale(t):
    return _bars(t)


@query("whale_bars_exact", sql.say(f"SELECT {METRICS} FROM bars", sql.limits(None), sql.bars(), source="lineitem"), source=from_lineitem)
def _whale_exact(t):
    return B.hourly_bars(H.classify(t, H.thresholds(t, sql.WINDOW, None, sql.BOOTSTRAP)))


@query("quality_report", sql.whale(f"SELECT {_REPORT} FROM verdict", sql.VERDICT))
def _quality(t):
    return Q.verdict(_bars(t), sql.MIN_TRADES)


@query("full_build", sql.whale(f"SELECT {METRICS}, fill_kind FROM trimmed", sql.filled(), sql.TRIMMED))
def _full(t):
    return jobs.build(t, sql.WINDOW, sql.CAPACITY, sql.BOOTSTRAP, sql.MAX_GAP, sql.WARMUP)


# The jobs' own sizes: samples of 10,000 and a bootstrap of 50,000 over days that hold more, activity below 100 and gaps of 6
# hours over trades with short and long gaps.

_DEFAULT_LIMITS = sql.limits(H.CAPACITY, H.BOOTSTRAP_TRADES)
_DEFAULT_FILLED = sql.filled(Q.MAX_GAP_HOURS)


def _default_bars(t: DataFrame) -> DataFrame:
    return B.hourly_bars(H.classify(t, H.thresholds(t)))


@query("a9_default_sample", sql.say("SELECT symbol, date, agg_id, round(qty, 6) AS qty FROM sample", _DEFAULT_LIMITS, source="busy"), source=from_busy, digits=6)
def _a9_default(t):
    return H.daily_sample(t)


@query("a13_default_thresholds", sql.say("SELECT symbol, date, round(p99, 6) AS p99, round(p999, 6) AS p999, source FROM limits", _DEFAULT_LIMITS, source="busy"), source=from_busy, digits=6)
def _a13_default(t):
    return H.thresholds(t)


@query("w6_default_low_activity", sql.say(f"SELECT symbol, count(*) FILTER (n_trades < {Q.MIN_TRADES}) AS n_low_activity FROM bars GROUP BY 1", _DEFAULT_LIMITS, sql.bars(), source="sparse"), source=from_sparse)
def _w6_default(t):
    return Q.low_activity(B.hourly_bars(t))


@query("w8_default_gap_places", sql.say("SELECT symbol, time, gap AS gap_hours, place AS gap_place FROM gapped WHERE gap IS NOT NULL", _DEFAULT_LIMITS, sql.bars(), _DEFAULT_FILLED, source="sparse"), source=from_sparse)
def _w8_default(t):
    return Q.neighbours(written(B.hourly_bars(t))).where("gap_hours is not null").select("symbol", "time", "gap_hours", "gap_place")


@query("w9_default_fill", sql.say(f"SELECT {METRICS}, fill_kind FROM filled", _DEFAULT_LIMITS, sql.bars(), _DEFAULT_FILLED, source="sparse"), source=from_sparse)
def _w9_default(t):
    return Q.fill_gaps(written(_default_bars(t)))


@query("w10_default_fill_counts", sql.say("SELECT symbol, count(*) FILTER (fill_kind = 'interpolated') AS n_small_filled, count(*) FILTER (fill_kind = 'zero') AS n_large_hours FROM filled GROUP BY 1", _DEFAULT_LIMITS, sql.bars(), _DEFAULT_FILLED, source="sparse"), source=from_sparse)
def _w10_default(t):
    return Q.fill_counts(Q.fill_gaps(written(_default_bars(t))))


@query("full_build_default", sql.say(f"SELECT {METRICS}, fill_kind FROM trimmed", _DEFAULT_LIMITS, sql.bars(), _DEFAULT_FILLED, sql.TRIMMED, source="sparse"), source=from_sparse)
def _full_default(t):
    return jobs.build(t)


from tradebars.plans import stored  # noqa: E402, F401  registers the queries of sources, increments and streams


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
