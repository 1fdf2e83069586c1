"""Column expressions over single trades and bars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_to_time(epoch: Column) -> Column:
    """Epoch numbers above 1e15 are microseconds, others milliseconds."""
    return F.when(epoch > F.lit(10**15), F.timestamp_micros(epoch)).otherwise(F.timestamp_millis(epoch))


def is_buy(is_buyer_maker: Column | str = "is_buyer_maker") -> Column:
    """The taker bought where the buyer was not the maker."""
    return ~(F.col(is_buyer_maker) if isinstance(is_buyer_maker, str) else is_buyer_maker)


def notional() -> Column:
    return F.col("price") * F.col("qty")


def hour_of(time: Column | str = "time") -> Column:
    return F.date_trunc("hour", time)


def day_of(time: Column | str = "time") -> Column:
    return F.to_date(time)


def minute_of(time: Column | str = "time") -> Column:
    return F.minute(time)


def month_of(time: Column | str = "time") -> Column:
    return F.date_format(time, "yyyy-MM")


def net_volume() -> Column:
    return F.col("buy_vol") - F.col("sell_vol")


def total_volume() -> Column:
    return F.col("buy_vol") + F.col("sell_vol")


def lerp(a: Column, b: Column, weight: Column) -> Column:
    return a + weight * (b - a)


def lerp_int(a: Column, b: Column, weight: Column) -> Column:
    """Interpolated and truncated toward zero."""
    return (a.cast("double") + weight * (b - a).cast("double")).cast("bigint")


def between(rows: DataFrame, low: dt.datetime, high: dt.datetime) -> DataFrame:
    """Rows of a half-open range of time, which the scan can prune; both ends in the session's zone, not the machine's."""
    ends = [F.lit(x.isoformat(sep=" ")).cast(rows.schema["time"].dataType) for x in (low, high)]
    return rows.where((F.col("time") >= ends[0]) & (F.col("time") < ends[1]))
