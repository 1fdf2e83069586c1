import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradebars.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(n=400, seed=3, wide=6, labels=4):
    r = random.Random(seed)
    out = []
    for i in range(n):
        length = r.choice([0.2, 1.0, 1.0, 5.0])
        out.append((i, [length * r.gauss(0, 1) for _ in range(wide)], r.randrange(labels)))
    return out


def floored(v, width, scale=256):
    x = [math.floor(scale * float(np.float32(a))) for a in v]
    return x + [0] * (width - len(x))


def brute(rows, anchor, positives=5, negatives_=10, low=30, high=90):
    fit = [(i, v, y) for i, v, y in rows if i is not None and y is not None and v is not None and all(a is not None and math.isfinite(a) for a in v)]
    width = max((len(v) for _, v, _ in fit), default=0)
    fit = [(i, floored(v, width), y) for i, v, y in fit]
    seen, out = set(), []
    for i, q, y in fit:
        if not anchor(i) or (i, y, tuple(q)) in seen:
            continue
        seen.add((i, y, tuple(q)))
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, z) for j, v, z in fit if j != i)
        for s, p, _ in [x for x in scored if x[2] == y][:positives]:
            near = [x for x in scored if x[2] != y and low * -s <= 100 * -x[0] <= high * -s][:negatives_]
            out += [(i, p, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(near)]
    return sorted(out)


def mined(spark, rows, every=7, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("own")).withColumn("bucket", F.lit(1))
    return sorted(tuple(r) for r in negatives.mine(df, anchor=F.col("vec_id") % every == 0, **options).collect())


def test_equals_brute_force_with_small_parts_and_sample(spark):
    rows = vectors()
    got = mined(spark, rows, part=32, block=16, sample=64)
    assert got == brute(rows, lambda i: i % 7 == 0)
    assert len(got) > 500


def test_one_vector_in_a_third_of_the_rows_and_ties(spark):
    rows = vectors(240)
    rows = [(i, rows[0][1] if i % 3 == 0 else v, y) for i, v, y in rows]
    assert mined(spark, rows, every=5, part=32, sample=32) == brute(rows, lambda i: i % 5 == 0)


def test_rows_that_take_no_part_and_odd_ones(spark):
    rows = vectors(80) + [
        (1000, None, 1), (1001, [1.0, None, 1.0], 1), (1002, [math.nan] * 6, 1), (1003, [math.inf] * 6, 1), (1004, [1.0] * 6, None), (None, [1.0] * 6, 1),
        (1050, [], 1), (1051, [0.0] * 6, 2), (1057, [2.0, -1.0], 3), (1061, [1e4] * 9, 0),
    ]
    rows += rows[:8]
    got = mined(spark, rows, part=16, sample=20)
    assert sorted(set(got)) == sorted(set(brute(rows, lambda i: i % 7 == 0)))
    assert not {x for r in got for x in (r[0], r[1], r[3])} & {1000, 1001, 1002, 1003, 1004, None}


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(0, [1.0, 2.0], 1)], [(0, [1.0], 1), (2, [1.0], 2)], [(0, [], 1), (1, [], 1), (2, [], 2)]])
def test_few_rows(spark, rows):
    assert mined(spark, rows) == brute(rows, lambda i: i % 7 == 0)


def test_bands_and_counts_are_parameters(spark):
    rows = vectors(150, labels=2)
    assert mined(spark, rows, positives=2, negatives=3, low=10, high=50) == brute(rows, lambda i: i % 7 == 0, 2, 3, 10, 50)


def test_candidates_hold_all_that_reach_the_threshold_and_fewer_than_all():
    r = np.random.default_rng(5)
    data = np.floor(256 * r.normal(0, 1, (600, 4)))
    data = data[(np.linalg.norm(data, axis=1) > 300) & (np.linalg.norm(data, axis=1) < 330)]
    part, looked_at = negatives.Part(data), 0
    for q in np.floor(256 * r.normal(0, 1, (40, 4))):
        scores = data @ q
        for least in (float(np.quantile(scores, 0.98)), 0.0, float(scores.min()), -1e12):
            near = part.candidates(q, least)
            assert set(np.flatnonzero(scores >= least)) <= set(near)
        looked_at += len(part.candidates(q, float(np.quantile(scores, 0.98))))
    assert looked_at < 0.4 * 40 * len(data)


def test_ragged_and_long_components():
    m = negatives.matrix(pa.array([[0.5, -0.001], [], [1.0]], pa.list_(pa.float32())), 256)
    assert m.tolist() == [[128, -1], [0, 0], [256, 0]]


def test_far_parts_are_not_met(spark):
    """Anchors of great length need no part of short vectors once a sample has shown better ones."""
    rows = [(i, [100.0 + i % 7, 1.0], i % 2) for i in range(300)] + [(i, [0.01, 0.01], i % 2) for i in range(300, 600)]
    df = negatives._rows(spark.createDataFrame(rows, SCHEMA).select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label"), F.col("embedding").alias("v")), "v", 256)
    anchors = df.where("id = 0").select(F.lit(1).cast("bigint").alias("key"), "id", "label", "v").withColumn("length", F.lit(25600.0)).withColumn("least", F.lit(6e8))
    grid = negatives._Grid(df, anchors, 100, 10)
    met = {r.part for r in grid.anchors(anchors).collect()}
    assert 0 < len(met) < sum(n for _, _, n in grid.spans)
