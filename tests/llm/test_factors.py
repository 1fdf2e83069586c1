import random
import zlib

import numpy as np
import pyarrow as pa
from fixtures import SCHEMA, documents
from pyspark.sql import functions as F

from tradebars.llm import factors

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n=500, seed=2):
    """Good texts, and bad ones whose words are the same but shouted, or cut by signs, or one word again and again."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        t = [r.choice(words) for _ in range(r.randint(10, 150))]
        bad = r.random() < 0.3
        if bad:
            t = [[w.upper() + "!!" for w in t], [w + r.choice(["###", "$$$"]) for w in t], [t[0]] * len(t)][i % 3]
        docs.append((i, " ".join(t), "en" if i % 2 else None, "s", len(" ".join(t))))
        labels.append((i, 0 if bad else 1, 0))
    return docs, labels


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def classify(spark, docs, labels, **options):
    frame = documents(spark, docs).withColumn("score", F.lit("own")).withColumn("_text", F.lit(1))
    return factors.classify(frame, spark.createDataFrame(labels, LABELS), metadata=["n_chars"], keep=["doc_id"], **options).collect()


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    truth = {i: q for i, q, _ in labels}
    got = classify(spark, docs, labels)
    assert len(got) == len(docs)
    out = [(r.score, truth[r.doc_id], r.predicted) for r in got if held(r.doc_id)]
    good, bad = [s for s, q, _ in out if q], [s for s, q, _ in out if not q]
    assert np.mean([[a > b for b in bad] for a in good]) > 0.98
    assert np.mean([p == q for _, q, p in out]) > 0.95
    assert all(0 <= s <= 1 and p == (s >= 0.5) for s, _, p in out)


def test_held_out_labels_language_source_and_toxic_play_no_part(spark):
    docs, labels = corpus(150)
    other = [(i, 1 - q if held(i) else q, 1) for i, q, _ in labels]
    moved = [(i, t, "zz", "elsewhere", n) for i, t, _, _, n in docs]
    assert sorted(classify(spark, docs, labels)) == sorted(classify(spark, moved, other))


def test_odd_rows(spark):
    docs, labels = corpus(120)
    odd = [(1000, None, None, None, None), (1001, "", "en", "s", 0), (1002, "x" * 200_000 + " \n" * 1000, "en", "s", -5), (None, "null id", "en", "s", 7), docs[0], docs[0]]
    got = classify(spark, docs + odd, labels + [(None, 1, 0), (3, None, 0), (5, 0, 0), (5, 1, 0), (9999, 1, 0)])
    assert len(got) == len(docs) + len(odd)
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 0}) == 1


def test_nothing_to_learn_from(spark):
    docs, _ = corpus(20)
    assert {(r.score, r.predicted) for r in classify(spark, docs, [])} == {(0.5, 1)}
    empty = spark.createDataFrame([], SCHEMA)
    assert factors.classify(empty, spark.createDataFrame([(1, 1, 0)], LABELS)).count() == 0


def test_sample_bounds_what_is_learned_from(spark):
    docs, labels = corpus(300)
    table = factors.sampled(documents(spark, docs + docs), spark.createDataFrame(labels, LABELS), 100, ["n_chars", "lang"], "text", "doc_id", "quality")
    assert 60 <= table.num_rows <= 140
    assert len(set(table["id"].to_pylist())) == table.num_rows


def test_sum_of_squares_equals_the_sum_over_pairs():
    own = factors.features(pa.array(["Ab cd!! cd\ncd x", "", "éa ## ##"]))
    r = np.random.default_rng(1)
    wide = len(factors.STATISTICS)
    total = factors.WORD_BUCKETS + wide * factors.BINS + factors.META_BUCKETS
    m = factors.Machine(np.sort(r.random((wide, factors.BINS - 1))), 0.3, r.normal(size=total), r.normal(size=(total, factors.RANK)))
    texts, ids, values = m.rows(own, np.array([[1], [2], [3]]))
    raw, _ = m.raw(texts, ids, values, 3)
    for t in range(3):
        i, x = ids[texts == t], values[texts == t]
        pairs = sum(m.vectors[i[a]] @ m.vectors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert np.isclose(raw[t], m.bias + m.weights[i] @ x + pairs)


def test_word_features_and_statistics():
    own = factors.features(pa.array(["Ab ab!! x", None, "one\none\ntwo"]))
    assert np.bincount(own.owners, minlength=3).tolist() == [3, 0, 2]  # ab, !!, x; one, two
    assert np.allclose(np.bincount(own.owners, own.values**2, 3), [1, 0, 1])
    at = dict(zip(factors.STATISTICS, own.statistics.T))
    assert np.allclose(at["upper"], [1 / 9, 0, 0])
    assert np.allclose(at["distinct"], [3 / 4, 0, 2 / 3])
    assert np.allclose(at["commonest"], [2 / 4, 0, 2 / 3])
    assert np.allclose(at["repeated_lines"], [0, 0, 1 / 3])
