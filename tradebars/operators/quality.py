"""Gaps, duplicates and low activity of an hourly series; filling and trimming."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradebars.functions.schema import COUNTS, METRICS
from tradebars.functions.trades import lerp, lerp_int

MIN_TRADES = 100
MAX_GAP_HOURS = 6
WARMUP_HOURS = 168


def _hour():
    return F.expr("interval 1 hour")


def _hours(later, earlier):
    return ((F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 3600).cast("bigint")


def duplicates(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg((F.count("*") - F.count_distinct("time")).alias("n_duplicates"))


def coverage(bars: DataFrame) -> DataFrame:
    """Expected hours between the first and the last, distinct ones, and how many are missing."""
    found = bars.groupBy("symbol").agg((_hours(F.max("time"), F.min("time")) + 1).alias("n_expected"), F.count_distinct("time").alias("n_hours"))
    return found.withColumn("n_missing", F.col("n_expected") - F.col("n_hours"))


def gaps(bars: DataFrame) -> DataFrame:
    """(symbol, start, end, duration_hours) of every run of missing hours."""
    by = Window.partitionBy("symbol").orderBy("time")
    steps = bars.select("symbol", "time").distinct().withColumn("prev", F.lag("time").over(by))
    start = F.col("prev") + _hour()
    return steps.where(F.col("time") > start).select("symbol", start.alias("start"), (F.col("time") - _hour()).alias("end"), _hours(F.col("time"), start).alias("duration_hours"))


def low_activity(bars: DataFrame, min_trades: int = MIN_TRADES) -> DataFrame:
    return bars.groupBy("symbol").agg(F.count_if(F.col("n_trades") < min_trades).alias("n_low_activity"))


def verdict(bars: DataFrame, min_trades: int = MIN_TRADES) -> DataFrame:
    """One row a symbol (null is one) with all counts, is_valid and the issues, from one pass over the bars; an empty series
    gives one invalid row, "No data"."""
    steps = bars.select("symbol", "time", "n_trades").withColumn("prev", F.lag("time").over(Window.partitionBy("symbol").orderBy("time")))
    distinct = F.col("prev").isNull() | (F.col("time") > F.col("prev"))
    counts = steps.groupBy("symbol").agg(
        (_hours(F.max("time"), F.min("time")) + 1).alias("n_expected"), F.count_if(distinct).alias("n_hours"), (F.count("*") - F.count_if(distinct)).alias("n_duplicates"),
        F.count_if(F.col("time") > F.col("prev") + _hour()).alias("n_gaps"), F.count_if(F.col("n_trades") < min_trades).alias("n_low_activity"),
    ).withColumn("n_missing", F.col("n_expected") - F.col("n_hours"))
    issue = lambda n, what: F.when(F.col(n) > 0, F.concat(F.col(n).cast("string"), F.lit(f" {what}")))
    issues = F.array_compact(F.array(issue("n_duplicates", "duplicate hours"), issue("n_missing", "missing hours"), issue("n_low_activity", "hours with low activity")))
    found = counts.select("symbol", "n_expected", "n_hours", "n_missing", "n_duplicates", "n_gaps", "n_low_activity", ((F.col("n_missing") == 0) & (F.col("n_duplicates") == 0)).alias("is_valid"), F.array_join(issues, "; ").alias("issues"))
    none = bars.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("symbol"), *[F.lit(0).cast("bigint").alias(c) for c in found.columns[1:7]], F.lit(False).alias("is_valid"), F.lit("No data").alias("issues")
    )
    return found.unionByName(none.join(found.limit(1).select(F.lit(1).alias("one")), F.lit(True), "left_anti"))


def spine(bars: DataFrame) -> DataFrame:
    """Every hour of each symbol from its first to its last bar."""
    ends = bars.groupBy("symbol").agg(F.min("time").alias("low"), F.max("time").alias("high"))
    return ends.select("symbol", F.explode(F.sequence("low", "high", _hour())).alias("time"))


def neighbours(bars: DataFrame) -> DataFrame:
    """The spine with each hour's bar (null if missing), the bars before and after, and for missing hours the gap's length and
    the hour's place in it, from 1. Of repeated hours one bar must be left (see `merge_bars`). Bars that are still to be
    computed should be written first, as they are used twice."""
    whole = bars.select(F.col("symbol").alias("_symbol"), F.col("time").alias("_time"), F.struct("time", *METRICS).alias("bar"))
    by = Window.partitionBy("symbol").orderBy("time")
    same = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("time") == F.col("_time"))
    found = spine(bars).join(whole, same, "left").drop("_symbol", "_time").withColumns({
        "prev": F.last("bar", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)),
        "next": F.first("bar", ignorenulls=True).over(by.rowsBetween(0, Window.unboundedFollowing)),
    })
    missing = F.col("bar").isNull()
    return found.withColumns({
        "gap_hours": F.when(missing, _hours(F.col("next.time"), F.col("prev.time")) - 1),
        "gap_place": F.when(missing, _hours(F.col("time"), F.col("prev.time"))),
    })


def fill_gaps(bars: DataFrame, max_gap: int = MAX_GAP_HOURS) -> DataFrame:
    """The whole spine: gaps of `max_gap` hours at most are interpolated, others are zero; `fill_kind` says which."""
    rows = neighbours(bars)
    small = F.col("gap_hours") <= max_gap
    kind = F.when(F.col("bar").isNotNull(), "actual").when(small, "interpolated").otherwise("zero")
    weight = F.col("gap_place") / (F.col("gap_hours") + 1)
    metrics = []
    for m in METRICS:
        between = (lerp_int if m in COUNTS else lerp)(F.col(f"prev.{m}"), F.col(f"next.{m}"), weight)
        zero = F.lit(0).cast("bigint") if m in COUNTS else F.lit(0.0)
        metrics.append(F.when(F.col("bar").isNotNull(), F.col(f"bar.{m}")).when(small, between).otherwise(zero).alias(m))
    return rows.select("symbol", "time", *metrics, kind.alias("fill_kind"))


def fill_counts(filled: DataFrame) -> DataFrame:
    return filled.groupBy("symbol").agg(F.count_if(F.col("fill_kind") == "interpolated").alias("n_small_filled"), F.count_if(F.col("fill_kind") == "zero").alias("n_large_hours"))


def trim_warmup(bars: DataFrame, hours: int = WARMUP_HOURS) -> DataFrame:
    """Without the first `hours` rows of each symbol; a symbol with no more than these stays whole."""
    by = Window.partitionBy("symbol")
    ranked = bars.withColumns({"_rank": F.row_number().over(by.orderBy("time")), "_rows": F.count("*").over(by)})
    return ranked.where((F.col("_rank") > hours) | (F.col("_rows") <= hours)).drop("_rank", "_rows")
