"""Hourly order-flow bars: one aggregation with map-side sums, and what is derived from bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebars.functions.schema import ACCUMULATORS, METRICS, SUMS
from tradebars.functions.trades import hour_of, is_buy, minute_of, month_of, notional

KEYS = ["symbol", "time"]


def bar_sums() -> list[Column]:
    """Every metric that adds up, over trades with is_whale_p99 and is_whale_p999."""
    sums = []
    buy = is_buy()
    vol = lambda c: F.sum(F.when(c, F.col("qty")).otherwise(0.0))
    usd = lambda c: F.sum(F.when(c, notional()).otherwise(0.0))
    sums += [vol(buy).alias("buy_vol"), vol(~buy).alias("sell_vol"), F.count("*").alias("n_trades"), F.count_if(buy).alias("buy_count"), F.count_if(~buy).alias("sell_count")]
    for p in ("p99", "p999"):
        whale = F.col(f"is_whale_{p}")
        sums += [vol(whale & buy).alias(f"whale_buy_vol_{p}"), vol(whale & ~buy).alias(f"whale_sell_vol_{p}"), F.count_if(whale & buy).alias(f"whale_buy_count_{p}"), F.count_if(whale & ~buy).alias(f"whale_sell_count_{p}")]
    early = minute_of() < 30
    sums += [vol(early).alias("vol_first_30min"), vol(~early).alias("vol_last_30min"), usd(buy).alias("buy_vol_usd"), usd(~buy).alias("sell_vol_usd")]
    sums += [F.greatest(F.lit(0.0), F.max("qty")).alias("max_trade_size")]
    price = F.col("price")
    return [*sums, F.sum(price * F.col("qty")).alias("sum_pq"), F.sum("qty").alias("sum_q"), F.sum(price * price * F.col("qty")).alias("sum_ppq")]


def with_flags(trades: DataFrame) -> DataFrame:
    """Trades that were not classified count as no whales."""
    missing = {c: F.lit(False) for c in ("is_whale_p99", "is_whale_p999") if c not in trades.columns}
    return trades.withColumns(missing) if missing else trades


def partial_bars(trades: DataFrame) -> DataFrame:
    """Bars with their accumulators, to be merged and finished."""
    return with_flags(trades).groupBy("symbol", hour_of().alias("time")).agg(*bar_sums())


def merge_bars(*parts: DataFrame) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in (*SUMS, *ACCUMULATORS)], F.max("max_trade_size").alias("max_trade_size"))


def finish(parts: DataFrame) -> DataFrame:
    """Volume-weighted price and its deviation, 0 where there is no volume."""
    traded = F.col("sum_q") > 0
    vwap = F.when(traded, F.col("sum_pq") / F.col("sum_q")).otherwise(0.0)
    done = parts.withColumn("vwap", vwap)
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("sum_ppq") / F.col("sum_q") - F.col("vwap") * F.col("vwap")))
    return done.withColumn("price_std", F.when(traded, spread).otherwise(0.0)).select(*KEYS, *METRICS)


def reopen(bars: DataFrame) -> DataFrame:
    """Partial bars from finished ones."""
    q, pq = F.col("buy_vol") + F.col("sell_vol"), F.col("buy_vol_usd") + F.col("sell_vol_usd")
    return bars.select(*KEYS, *SUMS, "max_trade_size", pq.alias("sum_pq"), q.alias("sum_q"), ((F.pow("price_std", F.lit(2)) + F.pow("vwap", F.lit(2))) * q).alias("sum_ppq"))


def hourly_bars(trades: DataFrame) -> DataFrame:
    return finish(partial_bars(trades))


def summary(bars: DataFrame) -> DataFrame:
    """First and last hour, hours, trades and volume of each symbol."""
    return bars.groupBy("symbol").agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.count("*").alias("n_hours"), F.sum("n_trades").alias("n_trades"), F.sum(F.col("buy_vol") + F.col("sell_vol")).alias("volume"))


def month_results(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol", month_of().alias("month")).agg(F.count("*").alias("n_hours"), F.sum("n_trades").alias("n_trades"))


def progress(bars: DataFrame, completed: DataFrame) -> DataFrame:
    """Bars of months not yet completed, of completed ones, and the first and last date."""
    marked = bars.withColumn("month", month_of()).join(completed.select("symbol", "month", F.lit(True).alias("done")), ["symbol", "month"], "left")
    done = F.coalesce("done", F.lit(False))
    return marked.groupBy("symbol").agg(F.count_if(~done).alias("n_pending"), F.count_if(done).alias("n_finalized"), F.min(F.to_date("time")).alias("first_date"), F.max(F.to_date("time")).alias("last_date"))
