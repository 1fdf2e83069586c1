import datetime as dt
import os
import subprocess
import sys
from pathlib import Path

import pytest
from helpers import many, rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradebars.functions.trades import month_of
from tradebars.operators import bars as B
from tradebars.operators import incremental as I
from tradebars.operators import thresholds as H
from tradebars.plans import jobs
from tradebars.streaming import hourly
from tradebars.streaming.labelled import LabelledStream


def test_months(spark):
    assert [r.month for r in I.months(spark, "2023-11", "2024-02").collect()] == ["2023-11", "2023-12", "2024-01", "2024-02"]
    with pytest.raises(ValueError, match="before"):
        I.months(spark, "2024-02", "2024-01")


def test_incremental_equals_full(spark, tmp_path):
    t = many(spark, 6000, days=75)
    parameters = {"capacity": 15, "bootstrap_n": 20}
    full = B.hourly_bars(H.classify(t, H.thresholds(t, **parameters)))
    store = I.Store(spark, f"{tmp_path}/store")
    first = I.resume(store, t, "2024-01", "2024-02", **parameters)
    assert sorted({r.month for r in store.completed().collect()}) == ["2024-01", "2024-02"]
    assert rows_of(first.select(*full.columns)) == rows_of(full.where(month_of() < "2024-03"))
    whole = I.resume(store, t, "2024-01", "2024-03", **parameters)
    assert rows_of(whole.select(*full.columns)) == rows_of(full)
    assert rows_of(I.resume(store, t, "2024-02", "2024-02").select(*full.columns)) == rows_of(full.where(month_of() == "2024-02"))


def test_a_month_done_twice_is_the_same(spark, tmp_path):
    t = many(spark, 1000, days=20)
    store = I.Store(spark, f"{tmp_path}/store")
    for _ in range(2):
        I.build_month(store, t, "2024-01", capacity=None, bootstrap_n=20)
    assert store.bars().count() == B.hourly_bars(t).count()


def test_jobs_by_command_line(spark, tmp_path):
    many(spark, 2000, days=20).write.parquet(f"{tmp_path}/trades")
    jobs.main(["build", f"{tmp_path}/trades", f"{tmp_path}/bars"])
    built = spark.read.parquet(f"{tmp_path}/bars")
    assert rows_of(built.select("symbol", F.unix_timestamp("time"), "n_trades")) == rows_of(jobs.build(many(spark, 2000, days=20)).select("symbol", F.unix_timestamp("time"), "n_trades"))
    jobs.main(["resume", f"{tmp_path}/trades", f"{tmp_path}/store", "--start", "2024-01", "--end", "2024-01"])
    jobs.main(["report", f"{tmp_path}/bars"])


def streamed(spark, t, folder):
    t.repartition(4).write.parquet(folder)
    return spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_closed_hours_equal_batch(spark, tmp_path):
    t = many(spark, 2000)
    limits = H.thresholds(t, capacity=20, bootstrap_n=50)
    want = B.hourly_bars(H.classify(t, limits))
    limits.write.parquet(f"{tmp_path}/limits")
    stream = hourly.stream_bars(streamed(spark, t, f"{tmp_path}/in"), "400 hours", spark.read.parquet(f"{tmp_path}/limits"))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("bars_now").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows_of(spark.table("bars_now").select(*want.columns)) == rows_of(want)


def test_append_emits_closed_hours_only(spark, tmp_path):
    t = many(spark, 2000).coalesce(1).sortWithinPartitions("time")
    t.write.parquet(f"{tmp_path}/in")
    stream = hourly.stream_bars(spark.readStream.schema(t.schema).parquet(f"{tmp_path}/in"), "2 hours")
    q = stream.writeStream.outputMode("append").format("memory").queryName("closed").option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True).start()
    q.awaitTermination()
    want = rows_of(B.hourly_bars(t))
    got = rows_of(spark.table("closed"))
    assert 0 < len(got) < len(want) and set(got) <= set(want)


def test_batches_are_kept_and_never_late(spark, tmp_path):
    t = many(spark, 2000)
    q = hourly.upsert_batches(streamed(spark, t, f"{tmp_path}/in"), f"{tmp_path}/parts").option("checkpointLocation", f"{tmp_path}/c3").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows_of(hourly.Batches(spark, f"{tmp_path}/parts").bars(), digits=4) == rows_of(B.hourly_bars(t), digits=4)


def test_callback_sees_every_batch(spark, tmp_path):
    t, seen = many(spark, 500), []
    q = hourly.each_batch(streamed(spark, t, f"{tmp_path}/in"), lambda batch, n: seen.append(batch.count())).option("checkpointLocation", f"{tmp_path}/c4").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(seen) == 500 and len(seen) == 4


ELSEWHERE = """
import sys; sys.path[:0] = [{tests!r}, {repo!r}]
from conftest import SparkSession
from helpers import many, rows_of
from tradebars.operators import bars as B, incremental as I, thresholds as H
spark = SparkSession.builder.master("local[2]").config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {folder!r} + "/shared").config("spark.local.dir", {folder!r} + "/local").getOrCreate()
t = many(spark, 800, days=40)
full = B.hourly_bars(H.classify(t, H.thresholds(t, capacity=15, bootstrap_n=20)))
built = I.resume(I.Store(spark, {folder!r} + "/store"), t, "2024-01", "2024-02", capacity=15, bootstrap_n=20)
assert rows_of(built.select(*full.columns)) == rows_of(full)
print("equal")
"""


def test_incremental_equals_full_on_a_machine_in_another_zone(tmp_path):
    tests = Path(__file__).resolve().parent
    code = ELSEWHERE.format(tests=str(tests), repo=str(tests.parent), folder=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": "America/New_York"}, capture_output=True, text=True, timeout=300)
    assert "equal" in out.stdout, out.stderr[-2000:]


def test_other_versions_count_as_nothing(spark, tmp_path):
    t = many(spark, 1500, days=40)
    store = I.Store(spark, f"{tmp_path}/store")
    want = rows_of(I.resume(store, t, "2024-01", "2024-02", capacity=15, bootstrap_n=20))
    store.snapshots.commit(store.snapshots.current() | {"version": 99})
    assert store.completed().count() == 0
    assert rows_of(I.resume(store, t, "2024-01", "2024-02", capacity=15, bootstrap_n=20)) == want
    assert store.completed().count() == 4 and store.marks().where("last_update is null").isEmpty()


SIZES = {"capacity": 15, "bootstrap_n": 20}


def test_months_in_any_order_equal_the_full_build(spark, tmp_path):
    """A late month makes the months stale whose first dates look back into it, over months of few dates too."""
    t = many(spark, 3000, days=130).where("not (symbol = 'S1' and month(time) = 3 and day(time) > 3)")
    full = B.hourly_bars(H.classify(t, H.thresholds(t, **SIZES)))
    store = I.Store(spark, f"{tmp_path}/store")
    for month in ("2024-04", "2024-01", "2024-03"):
        I.resume(store, t.where(month_of() == month), month, month, **SIZES)
    I.build_month(store, t, "2024-02", **SIZES)
    assert {(r.symbol, r.month) for r in store.stale().collect()} == {(s, m) for s in ("S0", "S1") for m in ("2024-03", "2024-04")}
    assert "2024-03" not in {r.month for r in store.bars().select("month").distinct().collect()}
    I.resume(store, t, "2024-01", "2024-03", **SIZES)
    assert store.stale().isEmpty()
    whole = I.resume(store, t, "2024-01", "2024-05", **SIZES)
    assert rows_of(whole.select(*full.columns)) == rows_of(full)


def test_stale_months_beyond_the_range_are_built_again(spark, tmp_path):
    t = many(spark, 1500, days=60)
    full = B.hourly_bars(H.classify(t, H.thresholds(t, **SIZES)))
    store = I.Store(spark, f"{tmp_path}/store")
    I.resume(store, t, "2024-02", "2024-02", **SIZES)
    I.resume(store, t, "2024-01", "2024-01", **SIZES)
    assert rows_of(store.bars().select(*full.columns)) == rows_of(full)


def test_adjacent_months_of_the_same_symbols_are_built_together(spark, tmp_path, monkeypatch):
    t, built, build = many(spark, 1500, days=100), [], I.build_months
    monkeypatch.setattr(I, "build_months", lambda store, trades, first, last, **p: (built.append((first, last)), build(store, trades, first, last, **p)))
    store = I.Store(spark, f"{tmp_path}/store")
    I.resume(store, t.where("symbol = 'S0'"), "2024-02", "2024-02", **SIZES)
    I.resume(store, t, "2024-01", "2024-04", **SIZES)
    assert built == [("2024-02", "2024-02"), ("2024-01", "2024-01"), ("2024-02", "2024-02"), ("2024-03", "2024-04")] + [("2024-02", "2024-02")]
    built.clear()
    whole = I.resume(I.Store(spark, f"{tmp_path}/other"), t, "2024-01", "2024-04", **SIZES)
    assert built == [("2024-01", "2024-04")]
    assert rows_of(whole) == rows_of(store.bars().drop("month"))


def test_a_build_that_dies_between_writes_leaves_the_state_before(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    t = many(spark, 1200, days=60)
    store = I.Store(spark, f"{tmp_path}/store")
    I.resume(store, t, "2024-01", "2024-01", **SIZES)
    before, marks = rows_of(store.bars()), rows_of(store.marks())
    put = DataFrameWriter.parquet

    def dying(after):
        left = [after]

        def write(self, path, *args, **kwargs):
            if "/store/" in path:
                left[0] -= 1
                if left[0] < 0:
                    raise OSError("killed")
            return put(self, path, *args, **kwargs)

        return write

    for n in range(4):  # before bars, values, marks and bootstrap
        monkeypatch.setattr(DataFrameWriter, "parquet", dying(n))
        with pytest.raises(OSError, match="killed"):
            I.resume(store, t, "2024-02", "2024-02", **SIZES)
        assert rows_of(store.bars()) == before and rows_of(store.marks()) == marks
    monkeypatch.setattr(DataFrameWriter, "parquet", put)
    with pytest.raises(RuntimeError, match="killed"):  # before the manifest
        monkeypatch.setattr(store.snapshots, "commit", lambda content: (_ for _ in ()).throw(RuntimeError("killed")))
        I.resume(store, t, "2024-02", "2024-02", **SIZES)
    assert rows_of(store.bars()) == before
    whole = I.resume(I.Store(spark, f"{tmp_path}/store"), t, "2024-01", "2024-02", **SIZES)
    assert rows_of(whole) == rows_of(I.resume(I.Store(spark, f"{tmp_path}/other"), t, "2024-01", "2024-02", **SIZES))


def test_readers_keep_what_they_began_with(spark, tmp_path):
    t = many(spark, 800, days=20)
    store = I.Store(spark, f"{tmp_path}/store")
    I.build_month(store, t, "2024-01", **SIZES)
    held = store.bars()
    want = rows_of(held)
    I.build_month(store, t.where("agg_id % 3 = 0"), "2024-01", **SIZES)
    assert rows_of(held) == want != rows_of(store.bars())


def test_two_writers_cannot_both_commit(spark, tmp_path):
    from tradebars.functions.snapshots import Snapshots

    one = Snapshots(spark, f"{tmp_path}/s")
    assert one.commit({"a": 1}) == 0 and one.commit({"a": 2}) == 1
    one.numbers = lambda: [0]
    with pytest.raises(RuntimeError, match="another writer"):
        one.commit({"a": 3})
    assert Snapshots(spark, f"{tmp_path}/s").current() == {"a": 2}


def test_only_pending_symbols_are_built(spark, tmp_path):
    t = many(spark, 1500, days=40)
    store = I.Store(spark, f"{tmp_path}/store")
    I.resume(store, t.where("symbol = 'S0'"), "2024-01", "2024-02", capacity=15)
    both = I.resume(store, t, "2024-01", "2024-02", capacity=15)
    assert store.marks().count() == 4 == store.completed().count()
    assert rows_of(both) == rows_of(I.resume(I.Store(spark, f"{tmp_path}/other"), t, "2024-01", "2024-02", capacity=15))


def test_compacted_and_repeated_batches_count_once(spark, tmp_path):
    """Compacting twice, a repeated last batch, and a crash before the manifest change nothing; the last batch stays apart."""
    t, path = many(spark, 2000), f"{tmp_path}/parts"
    q = hourly.upsert_batches(streamed(spark, t, f"{tmp_path}/in"), path).option("checkpointLocation", f"{tmp_path}/c5").trigger(availableNow=True).start()
    q.awaitTermination()
    kept = hourly.Batches(spark, path)
    want = rows_of(B.hourly_bars(t), digits=4)
    last = spark.read.parquet(f"{path}/{kept.entries()[-1]['at']}")
    kept.compact()
    assert [(e["since"], e["upto"]) for e in kept.entries()] == [(0, 2), (3, 3)]
    kept.put(last, 4)  # written, but not committed
    assert rows_of(kept.bars(), digits=4) == want
    kept.keep(last, 3)
    kept.compact()
    assert rows_of(hourly.Batches(spark, path).bars(), digits=4) == want


def test_many_batches_leave_few_folders(spark, tmp_path):
    kept, seen = hourly.Batches(spark, f"{tmp_path}/parts"), []
    t = B.partial_bars(many(spark, 40)).coalesce(1).cache()
    for n in range(36):
        kept.keep(t, n)
        seen.append(len(kept.entries()))
    assert max(seen) <= 3 * 3 + 1 and len(list((tmp_path / "parts" / "parts").iterdir())) <= 3 * max(seen)
    assert [e["upto"] + 1 for e in kept.entries()[:-1]] == [e["since"] for e in kept.entries()[1:]]
    assert kept.bars().agg(F.sum("n_trades")).first()[0] == 36 * 40


# Streams that label by their own days


def in_order(spark, t, folder, parts=4, late=None):
    place = F.ntile(parts).over(Window.orderBy("time")) - 1
    placed = t.withColumn("p", place if late is None else F.when(late, parts - 1).otherwise(place)).cache()
    for k in range(parts):
        placed.where(F.col("p") == k).drop("p").coalesce(1).write.parquet(f"{folder}/{k}")
    return spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def run(writer, folder):
    writer.option("checkpointLocation", folder).trigger(availableNow=True).start().awaitTermination()


def own(spark, path, **sizes):
    return LabelledStream(spark, str(path), **({"capacity": 20, "bootstrap_n": 30, "window": 3} | sizes))


def test_a_stream_that_closes_its_own_days_equals_batch(spark, tmp_path):
    """Three symbols, one of which begins later and with too few trades to bootstrap; trades wait until their limits are known."""
    t = many(spark, 3000, days=40).unionByName(many(spark, 60, days=12).where("symbol = 'S0'").withColumns({"symbol": F.lit("late"), "time": F.col("time") + F.expr("interval 15 days")}))
    limits = H.thresholds(t, window=3, capacity=20, bootstrap_n=30)
    want = B.hourly_bars(H.classify(t, limits))
    stream = own(spark, tmp_path / "s", delay=dt.timedelta(hours=30))
    run(stream.write(in_order(spark, t, f"{tmp_path}/in")), f"{tmp_path}/c")
    half = stream.bars()
    waiting = stream.progress()["n_waiting"]
    assert waiting > 0 and half.agg(F.sum("n_trades")).first()[0] == t.count() - waiting
    stream.close()
    assert rows_of(stream.limits()) == rows_of(limits)
    assert rows_of(stream.bars(), digits=4) == rows_of(want, digits=4)
    assert stream.progress()["n_waiting"] == 0


def test_months_are_handed_over_once_and_amended(spark, tmp_path):
    t = many(spark, 1600, days=75)
    stream = own(spark, tmp_path / "s")
    run(stream.write(in_order(spark, t, f"{tmp_path}/in", 3)), f"{tmp_path}/c")
    assert stream.flushed() == {"2024-01": 1, "2024-02": 1} and stream.month("2024-03") is None
    assert stream.progress()["n_finalized"] == stream.month("2024-01").count() + stream.month("2024-02").count()
    late = t.where("agg_id < 40").withColumn("agg_id", F.col("agg_id") + 10_000)
    stream.take(late, 50)
    assert stream.flushed() == {"2024-01": 2, "2024-02": 1}
    stream.take(late, 50)  # a repeated batch changes nothing
    stream.close()
    counts = lambda df: rows_of(df.select("symbol", F.unix_timestamp("time"), "n_trades", "buy_count", "max_trade_size"))
    assert counts(stream.bars()) == counts(B.hourly_bars(t.unionByName(late)))
    assert set(stream.flushed()) == {"2024-01", "2024-02", "2024-03"}


def test_a_batch_that_dies_is_done_again_from_the_state_before(spark, tmp_path, monkeypatch):
    t = many(spark, 900, days=20)
    stream, halves = own(spark, tmp_path / "s"), [t.where("agg_id < 450"), t.where("agg_id >= 450")]
    stream.take(halves[0], 0)
    before = rows_of(stream.bars())
    with monkeypatch.context() as m:
        m.setattr(LabelledStream, "_progress", lambda self, state: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stream.take(halves[1], 1)
    assert rows_of(stream.bars()) == before
    stream.take(halves[1], 1)
    stream.close()
    assert rows_of(stream.bars(), digits=4) == rows_of(B.hourly_bars(H.classify(t, H.thresholds(t, window=3, capacity=20, bootstrap_n=30))), digits=4)


def test_an_empty_stream(spark, tmp_path):
    stream = own(spark, tmp_path / "s")
    assert stream.bars() is None and stream.progress()["n_pending"] == 0
    stream.take(many(spark, 10).limit(0), 0)
    stream.close()
    assert stream.bars().count() == 0 and stream.limits().count() == 0 and stream.flushed() == {}
