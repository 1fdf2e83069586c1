import random
import zlib

from fixtures import SCHEMA, documents, rows
from pyspark.sql import functions as F

from tradebars.llm import sharding


def check(out, data, shards, balanced=None):
    assert len(out) == len(data)
    bytes_, slots, where = {}, {}, {}
    for r in out:
        bytes_[r.shard] = bytes_.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        where.setdefault(r.text_crc32, set()).add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = {d[0]: (len((d[1] or "").encode()) + 8, zlib.crc32((d[1] or "").encode())) for d in data}
    assert all((r.size, r.text_crc32) == sizes[r.doc_id] for r in out)
    if balanced:
        mean = sum(bytes_.values()) / shards
        assert len(bytes_) == shards and max(bytes_.values()) <= (1 + balanced) * mean and min(bytes_.values()) >= (1 - balanced) * mean
    return where


def test_near_equal_bytes_and_groups(spark):
    r = random.Random(2)
    data = [(i, "é" * r.randint(10, 90), r.choice(["en", "fr"]), r.choice("abc"), 1) for i in range(4000)]
    data = [(i, f"{t}{i // 2}", lang, s, n) for i, t, lang, s, n in data]
    data = [(i, data[i - i % 2][1], *x[2:]) for i, x in enumerate(data)]  # pairs of copies
    where = check(sharding.assign(documents(spark, data), 24).collect(), data, 24, 0.02)
    assert all(len(s) == 1 for s in where.values())


def test_hot_group_is_dealt_out(spark):
    data = [(i, "copy " * 20 if i < 1500 else f"text {i} " * 10, "en", "a", 1) for i in range(4000)]
    check(sharding.assign(documents(spark, data), 24).collect(), data, 24, 0.06)


def test_groups_up_to_a_shard_stay_whole_and_sizes_near(spark):
    """Groups of 0.95, 0.6, 0.6, 0.3 and 0.1 shards stay whole, one of 1.9 shards needs two, and the rest fills the room left."""
    n, r = 6000, random.Random(5)
    share = n * 100 / 12
    data = []
    for k, part in enumerate((0.95, 0.6, 0.6, 0.3, 0.1, 1.9)):
        data += [(len(data) + i, f"copy{k} ".ljust(92, "x"), "en", "a", 1) for i in range(int(part * share / 100))]
    data += [(i, f"text{i} ".ljust(r.randint(40, 144), "y"), r.choice(["en", "fr"]), r.choice("ab"), 1) for i in range(len(data), n)]
    where = check(sharding.assign(documents(spark, data), 12).collect(), data, 12, 0.03)
    hot = zlib.crc32("copy5 ".ljust(92, "x").encode())
    assert len(where[hot]) == 2 and all(len(s) == 1 for t, s in where.items() if t != hot)
    # The bound is a parameter: with half a shard, the three larger groups are dealt out too.
    where = check(sharding.assign(documents(spark, data), 12, whole=0.5).collect(), data, 12, 0.03)
    assert [len(where[zlib.crc32(f"copy{k} ".ljust(92, "x").encode())]) for k in range(6)] == [2, 2, 2, 1, 1, 4]


def test_tree_equals_brute_force(spark, monkeypatch):
    """With no tolerance, every point is where cuts at exact weighted quantiles put it."""
    monkeypatch.setattr(sharding, "TOLERANCE", 0)
    monkeypatch.setattr(sharding, "LARGE", 2)
    r = random.Random(3)
    data = [(i, f"t{i}" + "z" * r.randint(0, 300), r.choice(["en", "fr", "de"]), r.choice("abcd"), 1) for i in range(400)]
    docs = documents(spark, data)
    lots = sharding._lots(sharding._rows(docs, 48 * 7))
    points = [p.asDict() for p in sharding._points(lots, 1e9, 0, 399)[1].collect()]
    spread = lambda ps, k: max(p[k] for p in ps) - min(p[k] for p in ps)
    level, leaves = [(points, 0, 7)], {}
    while level:
        open_ = [x for x in level if x[2] > 1]
        for ps, first, _ in (x for x in level if x[2] == 1):
            leaves.update((p["text_hash"], first) for p in ps)
        every = [p for ps, *_ in open_ for p in ps]
        whole = {k: spread(every, k) for k in sharding._DIMENSIONS} if every else {}
        level = []
        for ps, first, k in open_:
            by = max(sharding._DIMENSIONS, key=lambda d: spread(ps, d) / max(1, whole[d]))  # noqa: B023
            ps = sorted(ps, key=lambda p: p[by])
            wanted = sum(p["weight"] for p in ps) * (k // 2 / k)
            sums = [sum(p["weight"] for p in ps[:i]) for i in range(len(ps) + 1)]
            cut = min(range(len(ps) + 1), key=lambda i: abs(sums[i] - wanted))
            level += [(ps[:cut], first, k // 2), (ps[cut:], first + k // 2, k - k // 2)]
    hashes = {x.doc_id: x.h for x in docs.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    out = sharding.assign(docs, 7).collect()
    assert {x.doc_id: x.shard for x in out} == {d: leaves[h] for d, h in hashes.items()}


def test_large_points_are_cut_by_the_tree(spark, monkeypatch):
    """Of points that are all large, or most of the bytes, shards are near equal; with slack, the first cut keeps the order of its dimension."""
    r = random.Random(6)
    data = [(i, f"big{i} ".ljust(r.randint(1500, 4000), "b"), "en", "a", 1) for i in range(80)]
    check(sharding.assign(documents(spark, data), 8).collect(), data, 8, 0.1)
    with monkeypatch.context() as m:
        m.setattr(sharding, "SLACK", 0.1)
        where = check(sharding.assign(documents(spark, data), 8).collect(), data, 8, 0.25)
    sizes = {zlib.crc32(t.encode()): len(t) for _, t, *_ in data}
    sides = [{n for c, n in sizes.items() if next(iter(where[c])) // 4 == side} for side in (0, 1)]
    assert max(sides[0]) <= min(sides[1])
    data += [(100 + i, f"small{i} ".ljust(r.randint(20, 90), "s"), r.choice(["en", "fr"]), "b", 1) for i in range(2000)]
    check(sharding.assign(documents(spark, data), 8).collect(), data, 8, 0.02)


def test_a_point_beyond_a_shard_leaves_the_others_equal(spark):
    data = [(i, f"text{i} ".ljust(100, "x"), "en", "a", 1) for i in range(2000)] + [(5000, "giant ".ljust(60000, "g"), "fr", "b", 1)]
    out = sharding.assign(documents(spark, data), 8).collect()
    check(out, data, 8)
    sums = {}
    for x in out:
        sums[x.shard] = sums.get(x.shard, 0) + x.size
    light = sorted(sums.values())[:-1]
    assert max(sums.values()) == 60008 and light[0] > 0.98 * light[-1]


def test_odd_rows_and_empty_table(spark):
    data = rows()
    out = sharding.assign(documents(spark).withColumn("shard", F.lit("clash")), 5).collect()
    check(out, data, 5)
    assert sorted(map(str, out)) == sorted(map(str, sharding.assign(documents(spark).repartition(7), 5).collect()))
    assert sharding.assign(spark.createDataFrame([], SCHEMA), 24).count() == 0


def test_written_folders(spark, tmp_path):
    docs = documents(spark, [(i, f"text {i} " * 5, "en", "a", 1) for i in range(300)])
    placed = sharding.write(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 300
    assert back.select("doc_id", "shard").exceptAll(placed.select("doc_id", "shard")).isEmpty()
