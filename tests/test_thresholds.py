import datetime as dt

from helpers import at, many, rows_of, trades
from pyspark.sql import functions as F

from tradebars.operators import thresholds as H


def daily(spark, days, n=3, symbol="S"):
    """n trades on each of the days, of quantity day * 10 + k."""
    return trades(spark, [(symbol, d * 100 + k, at(k, d), 1.0, float(d * 10 + k), False) for d in days for k in range(n)])


def test_percentile_definition(spark):
    t = trades(spark, [("S", i, at(0), 1.0, float(i), False) for i in range(1, 1000)])
    row = H.percentiles(H.histogram(t), ["symbol", "date"], freq="freq").first()
    assert (round(row.p99, 6), round(row.p999, 6)) == (989.02, 998.002)


def test_window_counts_present_dates_and_excludes_the_day(spark):
    t = daily(spark, [0, 5, 6, 20], n=1)
    out = {r.date.day: r for r in H.thresholds(t, window=2, capacity=None, bootstrap_n=50).collect()}
    assert (out[1].p99, out[1].p999, out[1].source) == (5.0, 20.0, "default")
    assert out[6].p99 == 0.0 and out[6].source == "rolling"
    assert round(out[7].p99, 6) == 49.5  # of 0 and 50
    assert round(out[21].p99, 6) == 59.9  # of 50 and 60, not of the day itself


def test_bootstrap_needs_enough_trades_of_the_first_date(spark):
    t = daily(spark, [0, 1], n=3)
    by = lambda n: {r.date.day: r.source for r in H.thresholds(t, bootstrap_n=n).collect()}
    assert by(3) == {1: "bootstrap", 2: "rolling"} and by(4) == {1: "default", 2: "rolling"}
    row = H.bootstrap(t, 2).first()
    assert round(row.p99, 6) == 0.99


def test_equal_to_the_threshold_is_a_whale(spark):
    t = trades(spark, [("S", 1, at(0), 1.0, 5.0, False), ("S", 2, at(0), 1.0, 4.999, False), ("S", 3, at(0), 1.0, 20.0, True)])
    out = {r.agg_id: (r.is_whale_p99, r.is_whale_p999) for r in H.classify(t, H.thresholds(t)).collect()}
    assert out == {1: (True, False), 2: (False, False), 3: (True, True)}


def test_samples(spark):
    t = many(spark)
    counts = {(r.symbol, r.date): r["count"] for r in H.day_counts(t).collect()}
    sample = H.daily_sample(t, 40)
    sizes = {(r.symbol, r.date): r["count"] for r in sample.groupBy("symbol", "date").count().collect()}
    assert sizes == {k: min(40, n) for k, n in counts.items()}
    assert H.dated(t).select("symbol", "date", "agg_id", "qty").exceptAll(sample).count() == 4000 - sum(sizes.values())
    halves = [H.daily_sample(t.where(F.col("agg_id") % 2 == k), 40) for k in (0, 1)]
    assert rows_of(H.merge_samples(*halves, 40)) == rows_of(sample) == rows_of(H.daily_sample(t.repartition(9), 40))


def test_sampled_equals_exact_while_days_fit(spark):
    t = many(spark)
    a = H.thresholds(t, capacity=10_000, bootstrap_n=100)
    assert rows_of(a) == rows_of(H.thresholds(t, capacity=None, bootstrap_n=100))


def test_history_retention_and_state(spark):
    t = daily(spark, range(10), n=2)
    assert [r.has_enough for r in H.enough_history(H.dated(t)).orderBy("date").collect()] == [False] * 7 + [True] * 3
    kept = sorted(r.date.day for r in H.retained(H.dated(t), F.lit(dt.date(2024, 1, 10))).collect())
    assert kept == list(range(3, 11))
    kept = sorted(r.date.day for r in H.retained(H.dated(t), F.lit(dt.date(2024, 1, 2))).collect())
    assert kept == list(range(2, 11))
    s = H.state_stats(H.day_counts(t), 1).first()
    assert (s.n_dates, s.n_samples) == (10, 10)


def test_empty(spark):
    none = trades(spark, [])
    assert H.thresholds(none).count() == 0 and H.classify(none, H.thresholds(none)).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_moves_no_trades(spark, tmp_path):
    """Sampling limits ranks before its exchange; the size of the limits decides on the join, and not that of the day values."""
    many(spark, 60_000, days=60).write.parquet(f"{tmp_path}/trades")
    t = spark.read.parquet(f"{tmp_path}/trades")
    assert plan_of(H.daily_sample(t, 10)).count("WindowGroupLimit") == 2
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "100k")
        values = spark.read.parquet(H.written(H.day_values(t)).inputFiles()[0].rsplit("/", 1)[0])
        assert not H._fits(values)
        flagged = H.classify(t, H.thresholds(t))
        assert flagged.count() == 60_000 and "Exchange hashpartitioning" not in plan_of(flagged) and "BroadcastHashJoin" in plan_of(flagged)
    finally:
        spark.conf.set(conf, before)


def test_a_hot_day_is_dealt_out_where_limits_are_too_large_to_broadcast(spark):
    t = many(spark, 3000, days=1, symbols=1).union(many(spark, 300, days=20))
    limits = H.thresholds(t, capacity=50, bootstrap_n=100)
    want = rows_of(H.classify(t, limits))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        flagged = H.classify(t, limits)
        hot = flagged.where("symbol = 'S0'").groupBy("date", F.spark_partition_id().alias("p")).count().where("date = '2024-01-01'").collect()
        assert len(hot) > 8 and max(r["count"] for r in hot) < 1500
        assert rows_of(flagged) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rolling_equals_pools_one_by_one(spark):
    """Days of very unequal size, repeated values and frequencies: each pool's percentiles by numpy."""
    import numpy as np

    r = np.random.default_rng(4)
    sizes = {d: int(n) for d, n in enumerate([1, 900, 2, 2, 5, 300, 1, 1, 40, 1, 1, 1, 1, 1, 1, 1, 700, 3])}
    rows = [(s, at(0, d).date(), float(q), int(f)) for s in "AB" for d, n in sizes.items() for q, f in zip(r.integers(0, 200, n) / 4, r.integers(1, 4, n), strict=True)]
    values = spark.createDataFrame(rows, "symbol string, date date, qty double, freq bigint")
    got = {(x.symbol, x.date): (x.p99, x.p999) for x in H.rolling(values, values, 7).collect()}
    for s in "AB":
        for d in range(1, len(sizes)):
            pool = np.concatenate([[q] * f for y, day, q, f in rows if y == s and at(0, d - 7).date() <= day < at(0, d).date()])
            assert np.allclose(got.pop((s, at(0, d).date())), np.quantile(pool, [0.99, 0.999]))
    assert not got


def test_rolling_shuffles_values_once_and_few_of_them_again(spark):
    t = many(spark, 40_000, days=20, symbols=1)
    values = H.written(H.histogram(t))
    plan = H.rolling(values, values, 7)
    plan.collect()
    text = plan_of(plan).split("Initial Plan")[0]
    assert "Python" not in text and text.count("Exchange hashpartitioning(symbol") <= 2


def test_jobs_scan_trades_twice(spark, tmp_path):
    """For the day values and for the bars; the first trades are read by a range of time that the scan prunes."""
    from tradebars.operators import bars as B
    from tradebars.operators import quality as Q
    from tradebars.plans import jobs

    many(spark, 3000, days=10).repartition("symbol").write.parquet(f"{tmp_path}/trades")
    t = spark.read.parquet(f"{tmp_path}/trades")
    scans = lambda df: [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x and "/trades" in x]
    bars_ = B.hourly_bars(H.classify(t, H.thresholds(t)))
    found = scans(bars_)
    assert len([x for x in found if "GreaterThanOrEqual(time" not in x]) == 1 and len(found) <= 2
    assert scans(jobs.build(t)) == [] and len(scans(Q.verdict(bars_))) <= 3
