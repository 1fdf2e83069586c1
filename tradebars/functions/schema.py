"""Schemas of trades, bars and stored state."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

TRADES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("agg_id", T.LongType()),
    T.StructField("time", T.TimestampType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("qty", T.DoubleType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
])

#: The bar metrics in output order, each with its key in the JSON form.
METRICS = {
    "buy_vol": "bv", "sell_vol": "sv", "n_trades": "nt", "buy_count": "bc", "sell_count": "sc",
    "whale_buy_vol_p99": "wbv99", "whale_sell_vol_p99": "wsv99", "whale_buy_count_p99": "wbc99", "whale_sell_count_p99": "wsc99",
    "whale_buy_vol_p999": "wbv999", "whale_sell_vol_p999": "wsv999", "whale_buy_count_p999": "wbc999", "whale_sell_count_p999": "wsc999",
    "vol_first_30min": "vf30", "vol_last_30min": "vl30", "buy_vol_usd": "bvu", "sell_vol_usd": "svu", "max_trade_size": "mts", "vwap": "vwap", "price_std": "pstd",
}
COUNTS = tuple(m for m in METRICS if "count" in m or m == "n_trades")
SUMS = tuple(m for m in METRICS if m not in ("max_trade_size", "vwap", "price_std"))
ACCUMULATORS = ("sum_pq", "sum_q", "sum_ppq")


def metric_type(name: str) -> T.DataType:
    return T.LongType() if name in COUNTS else T.DoubleType()


BARS = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("time", T.TimestampType()), *[T.StructField(m, metric_type(m)) for m in METRICS]])
SHORT_BARS = T.StructType([T.StructField("t", T.LongType()), *[T.StructField(k, metric_type(m)) for m, k in METRICS.items()]])
SAMPLES = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()), T.StructField("samples", T.ArrayType(T.DoubleType())), T.StructField("count", T.LongType())])
BOOTSTRAP = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("p99", T.DoubleType()), T.StructField("p999", T.DoubleType()), T.StructField("bootstrapped", T.BooleanType())])


def utc(spark: SparkSession) -> SparkSession:
    """Days and hours are those of UTC, whatever the session came with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
