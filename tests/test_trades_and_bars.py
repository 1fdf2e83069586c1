import pytest
from helpers import at, bars, many, rows_of, trades
from pyspark.sql import functions as F

from tradebars.functions import trades as X
from tradebars.operators import bars as B
from tradebars.operators import thresholds as H


def test_epoch_units(spark):
    values = [(1704067200000,), (1704067200000000,), (10**15,), (10**15 + 1,)]
    out = spark.createDataFrame(values, "e bigint").select(F.unix_micros(X.epoch_to_time(F.col("e"))).alias("us"))
    assert [r.us for r in out.collect()] == [1704067200000000, 1704067200000000, 10**18, 10**15 + 1]


def test_interpolation_truncates_whole_numbers(spark):
    row = spark.range(1).select(X.lerp_int(F.lit(10), F.lit(3), F.lit(0.5)).alias("a"), X.lerp_int(F.lit(-10), F.lit(-3), F.lit(0.5)).alias("b"), X.lerp(F.lit(1.0), F.lit(2.0), F.lit(0.25)).alias("c")).first()
    assert (row.a, row.b, row.c) == (6, -6, 1.25)


def test_one_hour_by_hand(spark):
    t = trades(spark, [("S", 1, at(0.0), 10.0, 1.0, False), ("S", 2, at(29.99 / 60), 20.0, 2.0, True), ("S", 3, at(0.5), 30.0, 1.0, False), ("S", 4, at(1.0), 5.0, 0.0, True)])
    first, second = B.hourly_bars(t).orderBy("time").collect()
    assert (first.buy_vol, first.sell_vol, first.n_trades, first.buy_count, first.sell_count) == (2.0, 2.0, 3, 2, 1)
    assert (first.vol_first_30min, first.vol_last_30min, first.buy_vol_usd, first.sell_vol_usd, first.max_trade_size) == (3.0, 1.0, 40.0, 40.0, 2.0)
    assert first.vwap == 20.0 and first.price_std == pytest.approx(50**0.5)
    assert (second.vwap, second.price_std, second.max_trade_size, second.n_trades) == (0.0, 0.0, 0.0, 1)


def test_bar_properties(spark):
    t = many(spark)
    flagged = H.classify(t, H.thresholds(t, capacity=50, bootstrap_n=100))
    assert flagged.where("is_whale_p999 and not is_whale_p99").isEmpty()
    out = B.hourly_bars(flagged)
    assert out.agg(F.sum("n_trades")).first()[0] == 4000
    assert out.where("abs(buy_vol + sell_vol - vol_first_30min - vol_last_30min) > 1e-6 or buy_count + sell_count != n_trades").isEmpty()
    assert rows_of(out) == rows_of(B.hourly_bars(flagged.repartition(13)))


def test_merge_of_parts_and_of_finished_bars(spark):
    t = many(spark)
    whole = rows_of(B.hourly_bars(t), digits=4)
    parts = [B.partial_bars(t.where(F.col("agg_id") % 3 == k)) for k in range(3)]
    assert rows_of(B.finish(B.merge_bars(*parts)), digits=4) == whole
    again = [B.reopen(B.finish(p)) for p in parts]
    assert rows_of(B.finish(B.merge_bars(*again)), digits=4) == whole


def test_session_zone_does_not_matter(spark):
    t = many(spark, 500)
    want = rows_of(B.hourly_bars(t).select("symbol", F.unix_timestamp("time"), "n_trades"))
    from tradebars.functions.schema import utc

    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        utc(spark)
        assert rows_of(B.hourly_bars(many(spark, 500)).select("symbol", F.unix_timestamp("time"), "n_trades")) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_summaries(spark):
    b = bars(spark, [0, 1, 800], n_trades=lambda h: h + 1, buy_vol=lambda h: 2, sell_vol=lambda h: 1)
    s = B.summary(b).first()
    assert (s.n_hours, s.n_trades, s.volume) == (3, 804, 9.0)
    assert {(r.month, r.n_hours, r.n_trades) for r in B.month_results(b).collect()} == {("2024-01", 2, 3), ("2024-02", 1, 801)}
    p = B.progress(b, spark.createDataFrame([("S", "2024-01")], "symbol string, month string")).first()
    assert (p.n_pending, p.n_finalized, str(p.first_date), str(p.last_date)) == (1, 2, "2024-01-01", "2024-02-03")
