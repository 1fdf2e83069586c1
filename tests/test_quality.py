from helpers import at, bars
from pyspark.sql import functions as F

from tradebars.operators import quality as Q


def test_gaps_of_1_6_and_7_hours(spark):
    b = bars(spark, [0, 2, 9, 17], n_trades=lambda h: 100 + h, buy_vol=lambda h: h)
    out = [(r.start, r.end, r.duration_hours) for r in Q.gaps(b.withColumn("time", F.unix_timestamp("time").cast("timestamp"))).orderBy("start").collect()]
    assert [d for *_, d in out] == [1, 6, 7]
    filled = Q.fill_gaps(b).orderBy("time").collect()
    assert len(filled) == 18
    kinds = {int((r.time - filled[0].time).total_seconds() // 3600): r for r in filled}
    assert kinds[1].fill_kind == kinds[8].fill_kind == "interpolated" and kinds[10].fill_kind == kinds[16].fill_kind == "zero"
    assert kinds[1].buy_vol == 1.0 and kinds[1].n_trades == 101
    assert kinds[3].n_trades == 103 and kinds[10].n_trades == 0 and kinds[10].vwap == 0.0
    counts = Q.fill_counts(Q.fill_gaps(b)).first()
    assert (counts.n_small_filled, counts.n_large_hours) == (7, 7)
    assert Q.gaps(Q.fill_gaps(b)).isEmpty()


def test_whole_numbers_truncate(spark):
    b = bars(spark, [0, 3], n_trades=lambda h: 10 if h == 0 else 3)
    assert [r.n_trades for r in Q.fill_gaps(b).orderBy("time").collect()] == [10, 7, 5, 3]


def test_verdict(spark):
    fine = bars(spark, [0, 1, 2], symbol="A", n_trades=lambda h: 100)
    odd = bars(spark, [0, 0, 1, 3], symbol="B", n_trades=lambda h: 99)
    out = {r.symbol: r for r in Q.verdict(fine.union(odd)).collect()}
    assert out["A"].is_valid and out["A"].issues == ""
    assert not out["B"].is_valid and out["B"].issues == "1 duplicate hours; 1 missing hours; 4 hours with low activity" and out["B"].n_gaps == 1
    low = Q.verdict(bars(spark, [0, 1], n_trades=lambda h: 1)).first()
    assert low.is_valid and low.n_low_activity == 2
    none = Q.verdict(fine.limit(0)).collect()
    assert len(none) == 1 and none[0].issues == "No data" and not none[0].is_valid


def test_trim_at_168_and_169(spark):
    assert Q.trim_warmup(bars(spark, range(168))).count() == 168
    left = Q.trim_warmup(bars(spark, range(169)))
    assert left.count() == 1 and left.select(F.unix_timestamp("time")).first()[0] == int(at(168).timestamp())


def test_empty(spark):
    none = bars(spark, [0]).limit(0)
    assert Q.fill_gaps(none).count() == 0 and Q.trim_warmup(none).count() == 0 and Q.gaps(none).count() == 0


def test_null_symbols_are_a_series_of_their_own(spark):
    b = bars(spark, [0, 3], n_trades=lambda h: 120 + h).withColumn("symbol", F.lit(None).cast("string"))
    row = Q.verdict(b).collect()
    assert [(r.symbol, r.n_missing, r.n_gaps, r.issues) for r in row] == [(None, 2, 1, "2 missing hours")]
    assert [r.n_trades for r in Q.fill_gaps(b).orderBy("time").collect()] == [120, 121, 122, 123]
