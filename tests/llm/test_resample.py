import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from fixtures import SCHEMA, documents, rows
from pyspark.sql import functions as F

from tradebars.llm import resample

TARGET = [(1, "ab cd ab"), (2, None), (3, ""), (4, "h g f e d c b a HG")]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def grams(t, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(data, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for r in data for g in grams(r[1], longest)[1])
    t = Counter(bucket(g) for r in target for g in grams(r[1], longest)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out, fit = [], []
    for k, r in enumerate(data):
        words, found = grams(r[1], longest)
        weight = sum(gain(bucket(g)) for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(found), weight, score, None])
        if len(words) >= least:
            fit.append((-score, r[0] is None, r[0] or 0, -len(found), -weight, k))
    for rank, (*_, k) in enumerate(sorted(fit)[: len(fit) * percent // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(1, 10_000, 10), (2, 97, 50), (3, 10_000, 100)])
def test_equals_brute_force(spark, longest, buckets, percent):
    data = rows()
    docs = documents(spark, data).withColumn("weight", F.lit("own")).withColumn("_fit", F.lit(1)).repartition(3)
    got = resample.resample(docs, spark.createDataFrame(TARGET, "item_id bigint, text string"), longest=longest, buckets=buckets, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(data, TARGET, longest, buckets, percent)


def test_empty_tables(spark):
    nothing, target = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id bigint, text string")
    assert resample.resample(nothing, target).count() == 0
    data = rows()
    assert sorted((tuple(r) for r in resample.resample(documents(spark, data), target).collect()), key=str) == brute(data, [])


def test_hot_scores_and_ranks_without_gaps(spark):
    """A third of the rows share an id and a text: their scores tie, and ranks still go on from 1."""
    r = random.Random(1)
    text = lambda: " ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(25))
    data = [(i, text(), "en", "s", 1) for i in range(200)] + [(7, "x " * 30, "en", "s", 1)] * 100
    got = resample.resample(documents(spark, data).repartition(7), spark.createDataFrame(TARGET, "item_id bigint, text string"), percent=70).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(data, TARGET, percent=70)
    assert sorted(x.rank for x in got if x.rank) == list(range(1, 211))


def test_ngrams_do_not_cross_texts():
    owners, buckets, words = resample.features(pa.array(["a b", None, "c", "b\nd"]), 2)
    pairs = {zlib.crc32(g) % 10_000 for g in (b"a b", b"b d")}
    assert words.tolist() == [2, 0, 1, 2]
    assert {(int(o), int(b)) for o, b in zip(owners, buckets)} == {(o, zlib.crc32(w) % 10_000) for o, w in ((0, b"a"), (0, b"b"), (2, b"c"), (3, b"b"), (3, b"d"), (0, b"a b"), (3, b"b d"))}
    assert pairs <= set(buckets.tolist())


def test_draw_returns_whole_documents(spark):
    data = [r for r in rows() if r[0] is not None]
    target = spark.createDataFrame(TARGET, "item_id bigint, text string")
    docs = documents(spark, data).withColumn("_key2", F.lit(1))
    got = resample.draw(docs, target, percent=40)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == {r[0] for r in brute(data, TARGET, percent=40) if r[4]}
