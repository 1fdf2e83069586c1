"""Hard negatives of anchor vectors by inner product, with length buckets and coordinate pruning.

Vectors become whole numbers, floor(scale * x). All rows lie in length buckets, whose vectors differ in length by a tenth at
most; a bucket is dealt out into parts of like size. Anchors, in blocks, meet every part that can reach their threshold: a
part's vectors, made unit vectors, are held in one sorted list a coordinate. A vector within the angle that the threshold
leaves can differ from the anchor in a coordinate by that angle at most, so each of the anchor's focus coordinates (its
largest) gives a range of its list; the sets in these ranges are intersected, and exact inner products of the rest decide.

Thresholds are scores that enough rows reach for certain: those of the best rows in a bounded sample, which is why pruning
by them loses nothing. Positives are searched first, then the negatives of all positives of an anchor together. Each part
passes on its best rows only, and ranks within an anchor's follow.

Defined results: rows with a null id, label or vector, or a null or infinite component or NaN, take no part; shorter vectors
count as if zeros followed, an empty one as zero; whole numbers beyond 64 bits count as the last of these, and sums are exact
up to 2^53. Equal scores go by id. Rows that share an id are rows of their own, but never each other's positives or
negatives; of repeated anchors one counts. No anchor, positive or negative gives no row; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradebars.llm._tables import settle

#: A length bucket's longest vector by its shortest.
RATIO = 1.1
#: Rows of a bucket's part and of a block of anchors; parts grow up to sixteen times that on large tables.
PART, ANCHORS = 1024, 2048
#: Rows of the sample that gives the first thresholds.
SAMPLE = 4096
#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 4
_SLACK = 1e-9
ZERO = -(1 << 20)


def matrix(column: pa.Array, scale: float) -> np.ndarray:
    """Whole-number vectors; shorter ones are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(float) * scale)
    np.clip(flat, -(2.0**63), 2.0**63, out=flat)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (a, b))


class Part:
    """Vectors of a length bucket, with a sorted list for each coordinate."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        self.least, self.most = lengths.min(initial=math.inf), lengths.max(initial=0)
        units = vectors / np.maximum(lengths, 1e-300)[:, None]
        self.order = np.argsort(units, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(units, self.order, axis=0).T)

    def candidates(self, anchor: np.ndarray, least: float) -> np.ndarray:
        """Indexes of the rows whose product with the anchor can be `least` or more."""
        n, length = len(self.vectors), math.sqrt(float(anchor @ anchor))
        if not n or (least > 0 and length * self.most < least * (1 - _SLACK)):
            return np.zeros(0, np.int64)
        reach = length * (self.most if least > 0 else self.least)
        if least == -math.inf or reach <= 0 or least <= -reach:
            return np.arange(n)
        angle = math.acos(min(1.0, least / reach))
        unit = np.abs(anchor) / length
        focus = np.argsort(-unit, kind="stable")[:FOCUS]
        own = np.arccos(np.clip(anchor[focus] / length, -1, 1))
        lows, highs = np.cos(np.minimum(math.pi, own + angle)) - _SLACK, np.cos(np.maximum(0.0, own - angle)) + _SLACK
        hits, ranges = np.zeros(n, np.int8), 0
        for f, low, high in zip(focus.tolist(), lows.tolist(), highs.tolist(), strict=True):
            a, b = np.searchsorted(self.sorted[f], low, "left"), np.searchsorted(self.sorted[f], high, "right")
            if b - a < n:
                hits[self.order[a:b, f]] += 1
                ranges += 1
        return np.flatnonzero(hits == ranges)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best, by falling score and rising id."""
    if len(scores) > 4 * k:
        few = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return few[np.lexsort((ids[few], -scores[few]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _kth(scores: np.ndarray, k: int) -> float:
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -math.inf


def _rows(df: DataFrame, vector: str, scale: float) -> DataFrame:
    """(id, label, v, bucket): the rows that take part."""
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * F.lit(float(scale))).cast("double"), F.lit(2.0)))
    bucket = F.when(square > 0, F.floor(F.log(square) / (2 * math.log(RATIO))).cast("int")).otherwise(ZERO)
    return df.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(~odd).withColumn("bucket", bucket)


def _sampled(rows: DataFrame, size: int) -> pa.Table:
    """About `size` rows, chosen by hash."""
    share = min(1.0, size / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("id", "label"), F.lit(1 << 30)) < int(share * (1 << 30))).select("id", "label", "v").toArrow()


class _Grid:
    """Which parts each bucket has, and the cells in which blocks of anchors meet them."""

    def __init__(self, rows: DataFrame, anchors: DataFrame, size: int, block: int):
        counts = sorted((r["bucket"], r["count"]) for r in rows.groupBy("bucket").count().collect())
        size = min(16 * size, max(size, sum(n for _, n in counts) // 256))
        self.spans, first = [], 0  # bucket, its first part, its parts
        for bucket, n in counts:
            self.spans.append((bucket, first, parts := max(1, -(-n // size))))
            first += parts
        self.blocks = max(1, -(-anchors.count() // block))
        of = {b: (first, parts) for b, first, parts in self.spans}
        place = lambda k: F.create_map([F.lit(x) for b, v in of.items() for x in (b, v[k])])[F.col("bucket")] if of else F.lit(0)
        part = place(0) + F.pmod(F.xxhash64("id", "label"), place(1)).cast("int")
        self.rows = rows.select("id", "label", "v", part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))).alias("block"))

    def anchors(self, anchors: DataFrame) -> DataFrame:
        """The anchors, with `length` and `least`, once for each part that can reach `least`."""
        span = F.explode(F.array(*[F.struct(F.lit(b).alias("bucket"), F.lit(f).alias("first"), F.lit(f + n - 1).alias("last")) for b, f, n in self.spans]))
        longest = F.when(F.col("span.bucket") == ZERO, 0.0).otherwise(F.exp((F.col("span.bucket") + 1) * math.log(RATIO)))
        near = anchors.withColumn("span", span).where((F.col("least") <= 0) | (F.col("length") * longest >= F.col("least") * (1 - _SLACK)))
        block = F.pmod(F.col("key"), F.lit(self.blocks)).cast("int")
        return near.withColumn("block", block).withColumn("part", F.explode(F.sequence("span.first", "span.last"))).drop("span")


def mine(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: Column | str = "label", anchor: Column | None = None, *, scale: float = 256, positives: int = 5,
    negatives: int = 10, low: int = 30, high: int = 90, sample: int = SAMPLE, part: int = PART, block: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (all rows by default) and each
    of its best `positives` rows of the same label the best `negatives` rows of other labels whose score is within `low` to `high`
    hundredths of the positive's."""
    label = F.col(label) if isinstance(label, str) else label
    narrow = df.select(F.col(id).cast("bigint").alias("id"), label.cast("string").alias("label"), F.col(vector).alias("v"), (F.lit(True) if anchor is None else F.coalesce(anchor, F.lit(False))).alias("is_anchor"))
    rows = settle(_rows(narrow, "v", scale))
    anchors = settle(rows.where("is_anchor").select(F.xxhash64("id", "label", "v").alias("key"), "id", "label", "v").dropDuplicates(["key"]))
    rows = rows.drop("is_anchor")
    if not anchors.head(1):
        return df.sparkSession.createDataFrame([], RESULT)
    grid = _Grid(rows, anchors, part, block)
    table = _sampled(rows, sample)
    shared = df.sparkSession.sparkContext.broadcast((matrix(table["v"], scale), table["id"].to_numpy(), np.array(table["label"].to_pylist(), object)))

    def first(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors with their lengths and the score that some `positives` rows of the label reach."""
        vectors, ids, labels = shared.value
        for batch in it:
            if not batch.num_rows:
                continue
            own, known = _same_width(matrix(batch.column(3), scale), vectors)
            scores = own @ known.T
            least = [_kth(s[(labels == y) & (ids != i)], positives) for s, i, y in zip(scores, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.sqrt((own * own).sum(axis=1))), pa.array(least, pa.float64())], names=[*batch.schema.names, "length", "least"])

    vector_type = rows.schema["v"].dataType.simpleString()
    held = f"key bigint, id bigint, label string, v {vector_type}, length double, least double"
    opened = anchors.select("key", "id", "label", "v").mapInArrow(first, held)

    def meet(a: pa.Table, b: pa.Table):
        """The anchors and rows of a cell: index, vector, id and label of each anchor with the rows that can reach its threshold."""
        own, vectors = _same_width(matrix(a["v"], scale), matrix(b["v"], scale))
        known, ids, labels = Part(vectors), b["id"].to_numpy(), np.array(b["label"].to_pylist(), object)
        for k, (q, i, y, least) in enumerate(zip(own, a["id"].to_pylist(), a["label"].to_pylist(), a["least"].to_pylist(), strict=True)):
            near = known.candidates(q, least)
            near = near[ids[near] != i]
            yield k, y, near, known.vectors[near] @ q, ids[near], labels[near]

    def best_positives(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        for k, y, _, scores, ids, labels in meet(a, b) if a.num_rows and b.num_rows else ():
            fit = np.flatnonzero((labels == y) & (scores >= a["least"][k].as_py()))
            out += [(a["key"][k].as_py(), int(ids[x]), int(scores[x])) for x in fit[_best(scores[fit], ids[fit], positives)]]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((), (), ()))], names=["key", "positive_id", "score"])

    cells = grid.rows.groupBy("block", "part")
    found = grid.anchors(opened).groupBy("block", "part").cogroup(cells).applyInArrow(best_positives, "key bigint, positive_id bigint, score bigint")
    ranked = found.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "positive_id"))).where(F.col("n") <= positives)
    pairs = ranked.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("n", "positive_id", "score"))).alias("pairs"))

    def second(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each positive the score that some `negatives` rows within its band reach, and an anchor's least of these."""
        vectors, ids, labels = shared.value
        for batch in it:
            if not batch.num_rows:
                continue
            own, known = _same_width(matrix(batch.column(3), scale), vectors)
            scores, floors = own @ known.T, []
            for s, i, y, listed in zip(scores, batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True):
                s = s[(labels != y) & (ids != i)]
                floors.append([max(low * p["score"] / 100, _kth(s[_band(s, p["score"], low, high)], negatives)) for p in listed])
            length = np.sqrt((own * own).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length), pa.array(floors, pa.list_(pa.float64())), pa.array([min(x) for x in floors])], names=[*batch.schema.names, "length", "floors", "least"])

    pair = "array<struct<n:int,positive_id:bigint,score:bigint>>"
    closed = settle(
        anchors.join(pairs, "key").select("key", "id", "label", "v", "pairs")
        .mapInArrow(second, f"key bigint, id bigint, label string, v {vector_type}, pairs {pair}, length double, floors array<double>, least double")
    )

    def best_negatives(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        for k, y, _, scores, ids, labels in meet(a, b) if a.num_rows and b.num_rows else ():
            other = np.flatnonzero(labels != y)
            scores, ids, key = scores[other], ids[other], a["key"][k].as_py()
            for p, floor in zip(a["pairs"][k].as_py(), a["floors"][k].as_py(), strict=True):
                fit = np.flatnonzero(_band(scores, p["score"], low, high) & (scores >= floor))
                out += [(key, p["n"], int(ids[x]), int(scores[x])) for x in fit[_best(scores[fit], ids[fit], negatives)]]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((), (), (), ()))], names=["key", "n", "negative_id", "negative_score"])

    won = grid.anchors(closed).groupBy("block", "part").cogroup(cells).applyInArrow(best_negatives, "key bigint, n bigint, negative_id bigint, negative_score bigint")
    by = Window.partitionBy("key", "n").orderBy(F.desc("negative_score"), "negative_id")
    won = won.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= negatives)
    named = closed.select("key", F.col("id").alias("anchor_id"), F.explode("pairs").alias("p")).select("key", "anchor_id", F.col("p.n").cast("bigint").alias("n"), "p.positive_id", F.col("p.score").alias("positive_score"))
    return won.join(named, ["key", "n"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _band(scores: np.ndarray, positive: int, low: int, high: int) -> np.ndarray:
    return (low * positive <= 100 * scores) & (100 * scores <= high * positive)
