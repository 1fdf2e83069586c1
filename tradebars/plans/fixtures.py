"""Trades derived from the event and order tables, in Spark and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebars.functions.schema import utc

EVENTS_SQL = """
SELECT event_type AS symbol, event_id AS agg_id, ts AS time, 100.0 + CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS price,
  value AS qty, (user_id % 2 = 1) AS is_buyer_maker FROM events"""

#: The same, four times as long, so that it spans several months.
STRETCHED_SQL = """
SELECT event_type AS symbol, event_id AS agg_id, make_timestamp(4 * epoch_us(ts) - 3 * 1704067200000000) AS time, 100.0 + CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS price,
  value AS qty, (user_id % 2 = 1) AS is_buyer_maker FROM events"""

#: The same, spread over sixteen times the time, so that hours are missing for short and for long.
SPARSE_SQL = STRETCHED_SQL.replace("4 * epoch_us(ts) - 3 *", "16 * epoch_us(ts) - 15 *")

LINEITEM_SQL = """
SELECT l_returnflag AS symbol, l_orderkey * 10 + l_linenumber AS agg_id,
  l_shipdate + to_hours(CAST(l_orderkey % 24 AS INT)) + to_minutes(CAST(l_partkey % 60 AS INT)) AS time,
  l_extendedprice / l_quantity AS price, CAST(l_quantity AS DOUBLE) AS qty, (l_linestatus = 'F') AS is_buyer_maker FROM lineitem"""

#: All items as the trades of one symbol on few days, of which the first has seven eighths: enough for full samples and a full bootstrap.
BUSY_SQL = """
SELECT 'BUSY' AS symbol, l_orderkey * 10 + l_linenumber AS agg_id,
  TIMESTAMP '2024-01-01' + to_days(CAST(CASE WHEN l_orderkey % 8 = 0 THEN 1 + l_partkey % 5 ELSE 0 END AS INT)) + to_hours(CAST(l_orderkey % 24 AS INT)) + to_minutes(CAST(l_partkey % 60 AS INT)) AS time,
  l_extendedprice / l_quantity AS price, CAST(l_extendedprice AS DOUBLE) AS qty, (l_linestatus = 'F') AS is_buyer_maker FROM lineitem"""


def _trades(events: DataFrame) -> DataFrame:
    price = F.lit(100.0) + F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    return events.select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("agg_id"), F.col("ts").cast("timestamp").alias("time"), price.alias("price"), F.col("value").alias("qty"), (F.col("user_id") % 2 == 1).alias("is_buyer_maker")
    )


def from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trades(utc(spark).read.parquet(f"{sf_dir}/events.parquet"))


def from_stretched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark, sf_dir).withColumn("time", F.timestamp_micros(4 * F.unix_micros("time") - F.lit(3 * 1704067200000000)))


def from_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark, sf_dir).withColumn("time", F.timestamp_micros(16 * F.unix_micros("time") - F.lit(15 * 1704067200000000)))


def from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = utc(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    shift = F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 24).cast("int"), (F.col("l_partkey") % 60).cast("int"), F.lit(0))
    return items.select(
        F.col("l_returnflag").alias("symbol"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("agg_id"), (F.col("l_shipdate").cast("timestamp") + shift).alias("time"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("price"), F.col("l_quantity").cast("double").alias("qty"), (F.col("l_linestatus") == "F").alias("is_buyer_maker"),
    )


def from_busy(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = utc(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    day = F.when(F.col("l_orderkey") % 8 == 0, 1 + F.col("l_partkey") % 5).otherwise(0).cast("int")
    shift = F.make_dt_interval(day, (F.col("l_orderkey") % 24).cast("int"), (F.col("l_partkey") % 60).cast("int"), F.lit(0))
    return items.select(
        F.lit("BUSY").alias("symbol"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("agg_id"), (F.lit("2024-01-01").cast("timestamp") + shift).alias("time"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("price"), F.col("l_extendedprice").cast("double").alias("qty"), (F.col("l_linestatus") == "F").alias("is_buyer_maker"),
    )
