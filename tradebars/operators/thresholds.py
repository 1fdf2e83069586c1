"""Large-trade thresholds from the trading days before, and the labels that they give trades."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradebars.functions.tables import written
from tradebars.functions.trades import between, day_of

WINDOW_DAYS = 7
CAPACITY = 10_000
BOOTSTRAP_TRADES = 50_000
#: Thresholds where nothing else is known.
DEFAULT_P99, DEFAULT_P999 = 5.0, 20.0
PERCENTS = (0.99, 0.999)
SEED = "42"
#: Keys that a day's trades are dealt out over where the limits are too large to broadcast.
SALT = 32

_DAY = ["symbol", "date"]


def dated(trades: DataFrame) -> DataFrame:
    return trades.withColumn("date", day_of())


def percentiles(groups: DataFrame, keys: list[str], value: str = "qty", freq: str | None = None) -> DataFrame:
    """Exact p99 and p999 with linear interpolation, of values that count `freq` times."""
    both = F.percentile(value, F.array(*map(F.lit, PERCENTS)), F.col(freq) if freq else F.lit(1))
    return groups.groupBy(*keys).agg(both.alias("p")).select(*keys, F.col("p")[0].alias("p99"), F.col("p")[1].alias("p999"))


def day_numbers(days: DataFrame) -> DataFrame:
    """(symbol, date, day): the place of each present date among those of its symbol, from 1."""
    distinct = days.select(*_DAY).distinct()
    return distinct.withColumn("day", F.row_number().over(Window.partitionBy("symbol").orderBy("date")))


def sample_rank(by: list[str]):
    return F.row_number().over(Window.partitionBy(*by).orderBy(F.md5(F.concat(F.lit(f"{SEED}:"), F.col("agg_id").cast("string"))), "qty"))


def daily_sample(trades: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(symbol, date, agg_id, qty): for each day the trades of least hash, `capacity` of them at most.

    The hash doesn't depend on the quantity, so this is a uniform sample without replacement; the rank limit is applied
    before the exchange too, so a task sends no more than `capacity` trades a day.
    """
    return dated(trades).select(*_DAY, "agg_id", "qty").withColumn("rank", sample_rank(_DAY)).where(F.col("rank") <= capacity).drop("rank")


def merge_samples(a: DataFrame, b: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The sample of both inputs' trades, from their samples."""
    return a.unionByName(b).withColumn("rank", sample_rank(_DAY)).where(F.col("rank") <= capacity).drop("rank")


def day_counts(trades: DataFrame) -> DataFrame:
    return dated(trades).groupBy(*_DAY).agg(F.count("*").alias("count"))


def histogram(trades: DataFrame) -> DataFrame:
    """(symbol, date, qty, freq) of all trades: what exact percentiles need, pre-aggregated."""
    return dated(trades).groupBy(*_DAY, "qty").agg(F.count("*").alias("freq"))


def lookback(days: DataFrame, window: int = WINDOW_DAYS) -> DataFrame:
    """(symbol, date, prior): each date with the `window` present dates before it."""
    numbered = day_numbers(days)
    targets = numbered.select("symbol", "date", F.explode(F.sequence(F.col("day") - window, F.col("day") - 1)).alias("day")).where("day > 0")
    return targets.join(numbered.withColumnRenamed("date", "prior"), ["symbol", "day"]).select("symbol", "date", "prior")


def rolling(values: DataFrame, days: DataFrame, window: int = WINDOW_DAYS) -> DataFrame:
    """(symbol, date, p99, p999) over values(symbol, date, qty, freq) pooled from the `window` present dates before.

    Only a pool's largest values decide its percentiles. How many, its size tells, so a day passes on to the pools that it is
    in what the largest demand among them needs, some hundredths of its values, and the rest is shuffled once at most.
    """
    by = Window.partitionBy("symbol").orderBy("day")
    counts = values.groupBy(*_DAY).agg(F.sum("freq").alias("n"))
    pools = day_numbers(days).join(counts, _DAY, "left").withColumn("pool", F.sum("n").over(by.rowsBetween(-window, -1)))
    demand = F.col("pool") - F.floor((F.col("pool") - 1) * min(PERCENTS))
    pools = written(pools.withColumn("need", F.max(demand).over(by.rowsBetween(1, window))).select(*_DAY, "day", "pool", "need"))
    larger = F.sum("freq").over(Window.partitionBy(*_DAY).orderBy(F.desc("qty")).rowsBetween(Window.unboundedPreceding, -1))
    top = values.join(pools.select(*_DAY, "day", "need").where("need > 0"), _DAY).withColumn("larger", F.coalesce(larger, F.lit(0))).where("larger < need")
    pooled = top.select("symbol", "qty", "freq", F.explode(F.sequence(F.col("day") + 1, F.col("day") + window)).alias("day")).join(pools.drop("need").where("pool > 0"), ["symbol", "day"])
    upto = F.sum("freq").over(Window.partitionBy("symbol", "day").orderBy(F.desc("qty")).rowsBetween(Window.unboundedPreceding, 0))
    ranked = pooled.withColumn("upto", upto)

    def at(q: float) -> Column:
        """Linear between the values at the places around q."""
        place = (F.col("pool") - 1) * F.lit(q)
        value = lambda i: F.max(F.when(F.col("upto") > F.col("pool") - 1 - i, F.col("qty")))
        low, high = value(F.floor(place)), value(F.ceil(place))
        part = F.max(place - F.floor(place))
        return F.when(part == 0, low).otherwise((1 - part) * low + part * high)

    return ranked.groupBy(*_DAY, "day").agg(at(PERCENTS[0]).alias("p99"), at(PERCENTS[1]).alias("p999")).select(*_DAY, "p99", "p999")


def bootstrap(trades: DataFrame, n: int = BOOTSTRAP_TRADES, days: DataFrame | None = None) -> DataFrame:
    """(symbol, date, p99, p999) over the first n trades of a symbol's first date, where it has so many.

    With `days`, the (symbol, date) that the trades have, the scan is pruned to the range of first dates.
    """
    first = (dated(trades) if days is None else days).groupBy("symbol").agg(F.min("date").alias("date"))
    if days is not None:
        low, high = first.agg(F.min("date"), F.max("date")).first()
        midnight = lambda d: dt.datetime(d.year, d.month, d.day)
        trades = trades.limit(0) if low is None else between(trades, midnight(low), midnight(high) + dt.timedelta(days=1))
    early = dated(trades).join(first, _DAY).withColumn("rank", F.row_number().over(Window.partitionBy("symbol").orderBy("time", "agg_id", "qty"))).where(F.col("rank") <= n)
    full = early.groupBy(*_DAY).agg(F.percentile("qty", F.array(*map(F.lit, PERCENTS))).alias("p"), F.count("*").alias("m")).where(F.col("m") >= n)
    return full.select(*_DAY, F.col("p")[0].alias("p99"), F.col("p")[1].alias("p999"))


def day_values(trades: DataFrame, capacity: int | None = CAPACITY) -> DataFrame:
    """(symbol, date, qty, freq): what a day gives to later thresholds, its sample or, with `capacity` None, all its trades."""
    if capacity is None:
        return histogram(trades)
    return daily_sample(trades, capacity).select(*_DAY, "qty", F.lit(1).cast("bigint").alias("freq"))


def limits_of(values: DataFrame, days: DataFrame, early: DataFrame, window: int = WINDOW_DAYS, stored: DataFrame | None = None) -> DataFrame:
    """(symbol, date, p99, p999, source) of the given days, from the day values of these and earlier ones, the bootstrap
    thresholds(symbol, date, p99, p999) of first dates, and stored ones(symbol, p99, p999) for days that have neither."""
    before = rolling(values, values.select(*_DAY).distinct(), window).withColumnsRenamed({"p99": "r99", "p999": "r999"})
    both = days.join(before, _DAY, "left").join(early.select(*_DAY, F.col("p99").alias("b99"), F.col("p999").alias("b999")), _DAY, "left")
    if stored is not None:
        both = both.join(stored.select("symbol", F.col("p99").alias("s99"), F.col("p999").alias("s999")), "symbol", "left")
        both = both.withColumns({"b99": F.coalesce("b99", "s99"), "b999": F.coalesce("b999", "s999")})
    source = F.when(F.col("r99").isNotNull(), "rolling").when(F.col("b99").isNotNull(), "bootstrap").otherwise("default")
    return both.select(*_DAY, F.coalesce("r99", "b99", F.lit(DEFAULT_P99)).alias("p99"), F.coalesce("r999", "b999", F.lit(DEFAULT_P999)).alias("p999"), source.alias("source"))


def thresholds(
    trades: DataFrame, window: int = WINDOW_DAYS, capacity: int | None = CAPACITY, bootstrap_n: int = BOOTSTRAP_TRADES,
    prior: DataFrame | None = None, stored: DataFrame | None = None, values: DataFrame | None = None,
) -> DataFrame:
    """(symbol, date, p99, p999, source) of every date of the trades, written to the shared folder.

    So are the day values, unless they are given: both are small against the trades, which are so read once for the values and
    again only where the first trades of each symbol are, and the planner knows the true size of what trades are joined with.

    `prior` holds values(symbol, date, qty, freq) of dates before those of the trades, in which case the first date is no
    beginning; `stored` holds bootstrap thresholds(symbol, p99, p999) of an earlier run, for dates without either.
    """
    values = written(day_values(trades, capacity)) if values is None else values
    days = values.select(*_DAY).distinct()
    early = bootstrap(trades, bootstrap_n, days)
    if prior is not None:
        values = values.unionByName(prior.select(*_DAY, "qty", "freq"))
    return written(limits_of(values, days, early, window, stored))


def _fits(table: DataFrame) -> bool:
    """Whether the planner will broadcast the table, by the size it knows and the session's limit."""
    most = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= most


def classify(trades: DataFrame, limits: DataFrame) -> DataFrame:
    """The trades with date, is_whale_p99 and is_whale_p999; a date without limits takes the defaults.

    The limits hold a row for each symbol and day, and should be a written table, as `thresholds` gives. While Spark's own
    limit lets it broadcast them, the trades stay where they are. Beyond, a day's trades are dealt out over `SALT` keys, each
    with a copy of the day's limits, so that no busy day falls to one task.
    """
    mine, held = dated(trades), limits.select(*_DAY, "p99", "p999")
    if trades.isStreaming or _fits(held):
        joined = mine.join(held, _DAY, "left")
    else:
        copies = held.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        joined = mine.withColumn("_salt", F.pmod(F.xxhash64("agg_id", "time"), F.lit(SALT)).cast("int")).join(copies, [*_DAY, "_salt"], "left").drop("_salt")
    flags = {"is_whale_p99": F.col("qty") >= F.coalesce("p99", F.lit(DEFAULT_P99)), "is_whale_p999": F.col("qty") >= F.coalesce("p999", F.lit(DEFAULT_P999))}
    return joined.withColumns(flags).drop("p99", "p999")


def enough_history(days: DataFrame, window: int = WINDOW_DAYS) -> DataFrame:
    """(symbol, date, has_enough): whether `window` present dates lie before."""
    return day_numbers(days).select(*_DAY, (F.col("day") > window).alias("has_enough"))


def retained(days: DataFrame, current, window: int = WINDOW_DAYS) -> DataFrame:
    """(symbol, date) to keep: the last window + 1 dates, and every date from `current` on."""
    newest = Window.partitionBy("symbol").orderBy(F.desc("date"))
    ranked = days.select(*_DAY).distinct().withColumn("rank", F.row_number().over(newest))
    return ranked.where((F.col("rank") <= window + 1) | (F.col("date") >= current)).select(*_DAY)


def state_stats(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(symbol, n_dates, n_samples) held, from (symbol, date, count)."""
    return counts.groupBy("symbol").agg(F.count_distinct("date").alias("n_dates"), F.sum(F.least("count", F.lit(capacity))).alias("n_samples"))
