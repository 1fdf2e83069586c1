"""Hand-made trades and bars."""

import datetime as dt

from pyspark.sql import functions as F

from tradebars.functions.schema import BARS, COUNTS, METRICS, TRADES

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(hours=0.0, days=0):
    return START + dt.timedelta(days=days, hours=hours)


def trades(spark, rows):
    """rows: (symbol, agg_id, time, price, qty, is_buyer_maker)"""
    return spark.createDataFrame(rows, TRADES)


def bars(spark, hours, symbol="S", **values):
    """A bar for each hour; metrics are 0 unless given as functions of the hour."""
    out = []
    for h in hours:
        row = [symbol, at(h)]
        for m in METRICS:
            v = values[m](h) if m in values else 0
            row.append(int(v) if m in COUNTS else float(v))
        out.append(tuple(row))
    return spark.createDataFrame(out, BARS)


def many(spark, n=4000, days=12, symbols=2):
    """Trades made by a rule: ids in order of time, spread over some days."""
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("S"), (i % symbols).cast("string")).alias("symbol"),
        i.alias("agg_id"),
        F.timestamp_micros(F.lit(1704067200000000) + (i * (days * 86_400_000_000 // n)).cast("bigint")).alias("time"),
        (100 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 100).alias("price"),
        (F.pmod(F.hash("id"), F.lit(5000)) / 100).alias("qty"),
        (F.pmod(F.xxhash64("id", "id"), F.lit(2)) == 1).alias("is_buyer_maker"),
    )


def rows_of(df, *order, digits=6):
    """Sorted rows with rounded doubles."""
    out = [tuple(round(x, digits) if isinstance(x, float) else x for x in r) for r in df.collect()]
    return sorted(out, key=str)
