"""Quality scores of texts by a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its lower-cased words and runs of signs, hashed into buckets and weighted by the root of their share;
statistics of its structure, each as the bin of quantiles that it lies in; and metadata columns, a bin for the magnitude of a
number or a bucket for the hash of a value. Beside a weight, every feature has a short vector, and each pair of features of a
text counts with the product of their vectors. The sum over pairs takes linear time, as half of (the square of the sum of the
vectors less the sum of their squares). All texts of a batch are scored together with whole-array operations.

Weights are fitted by adaptive gradient steps on a bounded sample of labelled documents: `SAMPLE` of them at most on average,
chosen by a hash of the id, whose sparse features alone reach the driver.

Defined results: a null text counts as empty; an empty one is scored by its statistics and metadata; without labels every
score is 0.5; of the rows that share an id the text of least hash is learned from, an id with several labels takes their
rounded mean, null ids and labels teach nothing; repeated rows get equal scores; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebars.llm import _bytes as B

#: Labelled documents that the weights are fitted on.
SAMPLE = 6000
WORD_BUCKETS = 1 << 14
META_BUCKETS = 64
BINS = 12
RANK = 8
EPOCHS, BATCH, STEP, DECAY = 12, 64, 0.1, 1e-4
U = np.uint64

#: 0 white space, 1 letters and digits and bytes of longer characters, 2 signs.
KIND = np.full(256, 2, np.int8)
KIND[B.SPACE] = 0
KIND[48:58] = KIND[65:91] = KIND[97:123] = KIND[128:] = 1


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b] = True
    return out


UPPER, DIGIT, SIGN, HIGH, STOP = _table((65, 91)), _table((48, 58)), KIND == 2, _table((128, 256)), _table((46, 47), (33, 34), (63, 64))
STATISTICS = ["upper", "digits", "signs", "high", "blanks", "stops", "length", "token_length", "distinct", "commonest", "repeated_lines", "line_length"]


@dataclass
class Features:
    """Word features of a batch's texts: text, bucket and value of each, sorted by text; and the statistics of each text."""

    owners: np.ndarray
    buckets: np.ndarray
    values: np.ndarray
    statistics: np.ndarray


def _repeated_lines(texts: B.Texts) -> tuple[np.ndarray, np.ndarray]:
    """For each text the share of its lines that equal an earlier one, and its lines."""
    starts, ends = texts.lines()
    full = ends > starts
    starts, ends = starts[full], ends[full]
    owners = texts.owner(starts)
    n = np.bincount(owners, minlength=len(texts))
    kept = np.unique(B.of_text(texts.hashes(starts, ends), owners), return_index=True)[1]
    return (n - np.bincount(owners[kept], minlength=len(texts))) / np.maximum(n, 1), n


def features(column: pa.Array) -> Features:
    texts = B.Texts(column)
    count = len(texts)
    sizes = np.maximum(texts.sizes, 1)
    shares = [texts.count(t) / sizes for t in (UPPER, DIGIT, SIGN, HIGH, B.SPACE, STOP)]
    repeated, lines = _repeated_lines(texts)
    kinds = KIND[texts.data]
    edges = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
    starts, ends = edges[:-1], edges[1:]
    worded = kinds[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[worded], ends[worded]
    owners = texts.owner(starts)
    lowered = B.Texts(pa.array([], pa.string()))
    lowered.data = B.LOWER[texts.data]
    hashes = lowered.hashes(starts, ends)
    n = np.bincount(owners, minlength=count)
    order = np.lexsort((hashes, owners))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (owners[order[1:]] != owners[order[:-1]])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(order)))
    own = owners[order[at]]
    commonest = np.zeros(count)
    np.maximum.at(commonest, own, times)
    least = np.maximum(n, 1)
    statistics = np.stack([
        *shares, np.log1p(texts.sizes), np.bincount(owners, ends - starts, count) / least, np.bincount(own, minlength=count) / least,
        commonest / least, repeated, np.log1p(n / np.maximum(lines, 1)),
    ], axis=1)
    return Features(own, (hashes[order[at]] >> U(40)).astype(np.int64) % WORD_BUCKETS, np.sqrt(times / n[own]), statistics)


def _meta(docs: DataFrame, columns: list[str]) -> Column:
    """Bins of metadata columns: 0 for null, the bits of a number's magnitude, or a bucket of another value's hash."""
    of = []
    for c in columns:
        kind, x = docs.schema[c].dataType.typeName(), F.col(f"`{c}`")
        if kind in ("byte", "short", "integer", "long", "float", "double") or kind.startswith("decimal"):
            size = F.least(F.floor(F.log2(F.abs(x.cast("double")) + 1)), F.lit(META_BUCKETS // 2 - 3)) + 1
            place = F.when(F.isnan(x.cast("double")), 0).otherwise(F.when(x < 0, size + META_BUCKETS // 2).otherwise(size))
        else:
            place = F.pmod(F.xxhash64(x.cast("string")), F.lit(META_BUCKETS - 1)) + 1
        of.append(F.coalesce(F.when(x.isNotNull(), place), F.lit(0)).cast("int"))
    return F.array(*of).cast("array<int>")


@dataclass
class Machine:
    """bias, weights and vectors of the features, and the edges of the statistics' bins."""

    edges: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def rows(self, own: Features, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, feature and value of everything that is not zero, sorted by text."""
        count, wide = own.statistics.shape
        bins = np.stack([np.searchsorted(e, own.statistics[:, k], "left") for k, e in enumerate(self.edges)], axis=1)
        dense = np.concatenate([
            WORD_BUCKETS + np.arange(wide) * BINS + bins,
            WORD_BUCKETS + wide * BINS + np.arange(meta.shape[1]) * META_BUCKETS + meta,
        ], axis=1)
        texts = np.concatenate([own.owners, np.repeat(np.arange(count), dense.shape[1])])
        ids = np.concatenate([own.buckets, dense.ravel()])
        values = np.concatenate([own.values, np.full(dense.size, dense.shape[1] ** -0.5)])
        order = np.argsort(texts, kind="stable")
        return texts[order], ids[order], values[order]

    def raw(self, texts: np.ndarray, ids: np.ndarray, values: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums before the logistic function, and the sum of the vectors of each text; every text has a row."""
        starts = np.searchsorted(texts, np.arange(count))
        scaled = self.vectors[ids] * values[:, None]
        sums = np.add.reduceat(scaled, starts, axis=0)
        pairs = 0.5 * (sums * sums - np.add.reduceat(scaled * scaled, starts, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.weights[ids] * values, starts) + pairs, sums


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def sampled(docs: DataFrame, labels: DataFrame, sample: int, metadata: list[str], text: str, id: str, label: str) -> pa.Table:
    """(id, label, text features, statistics, meta) of the sample, in order of a hash of the id."""
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).groupBy(id).agg(F.round(F.avg(label)).cast("int").alias("_y"))
    share = min(1.0, sample / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64(F.col(id)), F.lit(1 << 30)) < int(share * (1 << 30))).withColumnRenamed(id, "_id")
    rows = docs.select(F.col(id).alias("_doc"), F.coalesce(text, F.lit("")).alias("_text"), _meta(docs, metadata).alias("_meta"))
    joined = rows.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    one = joined.groupBy("_id", "_y").agg(F.min_by(F.struct("_text", "_meta"), F.xxhash64("_text", "_meta")).alias("r")).select("_id", "_y", "r._text", "r._meta")

    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in B.chunks(batch, "_text"):
                own = features(part.column(2))
                ends = np.searchsorted(own.owners, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (own.buckets.astype(np.int32), own.values.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists, pa.array(list(own.statistics), pa.list_(pa.float64())), part.column(3)], names=["id", "y", "ids", "values", "statistics", "meta"])

    kind = docs.schema[id].dataType.simpleString()
    return one.mapInArrow(look, f"id {kind}, y int, ids array<int>, values array<float>, statistics array<double>, meta array<int>").orderBy(F.xxhash64("id"), "id").toArrow()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, metadata: list[str] = [], text: str = "text", id: str = "doc_id", label: str = "quality", seed: int = 1) -> Machine:  # noqa: B006
    table = sampled(docs, labels, sample, metadata, text, id, label).combine_chunks()
    wide, n = len(STATISTICS), table.num_rows
    total = WORD_BUCKETS + wide * BINS + len(metadata) * META_BUCKETS
    random = np.random.default_rng(seed)
    flat = lambda c: table[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) if n else np.zeros(0)
    statistics = flat("statistics").reshape(n, wide)
    edges = np.quantile(statistics, np.arange(1, BINS) / BINS, axis=0).T if n else np.zeros((wide, BINS - 1))
    out = Machine(edges, 0.0, np.zeros(total, np.float32), random.normal(0, 0.05, (total, RANK)).astype(np.float32))
    if not n:
        out.vectors[:] = 0
        return out
    y = table["y"].to_numpy().astype(float)
    lengths = table["ids"].combine_chunks().value_lengths().to_numpy()
    texts, ids, values = out.rows(Features(np.repeat(np.arange(n), lengths), flat("ids").astype(np.int64), flat("values").astype(float), statistics), flat("meta").reshape(n, -1).astype(np.int64))
    starts = np.append(np.searchsorted(texts, np.arange(n)), len(texts))
    out.bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    seen_w, seen_v = np.full(total, 1e-6), np.full((total, RANK), 1e-6)
    for _ in range(EPOCHS):
        order = random.permutation(n)
        for at in range(0, n, BATCH):
            rows = order[at : at + BATCH]
            sizes = starts[rows + 1] - starts[rows]
            places = np.repeat(starts[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            i, x, t = ids[places], values[places], np.repeat(np.arange(len(rows)), sizes)
            raw, sums = out.raw(t, i, x, len(rows))
            error = (logistic(raw) - y[rows])[t] / len(rows)
            held, place = np.unique(i, return_inverse=True)
            g_w = np.bincount(place, error * x, len(held)) + DECAY * out.weights[held]
            part = (error * x)[:, None] * (sums[t] - out.vectors[i] * x[:, None])
            g_v = np.stack([np.bincount(place, part[:, f], len(held)) for f in range(RANK)], axis=1) + DECAY * out.vectors[held]
            seen_w[held] += g_w**2
            seen_v[held] += g_v**2
            out.weights[held] -= (STEP * g_w / np.sqrt(seen_w[held])).astype(np.float32)
            out.vectors[held] -= (STEP / 2 * g_v / np.sqrt(seen_v[held])).astype(np.float32)
            out.bias -= STEP * float((logistic(raw) - y[rows]).mean()) / 4
    return out


def score(docs: DataFrame, machine: Machine, metadata: list[str] = [], text: str = "text", keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:  # noqa: B006
    """The columns in `keep` (all by default) with score and predicted."""
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def judge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in it:
            for part in B.chunks(batch, "_text"):
                if not part.num_rows:
                    continue
                meta = part.column(part.num_columns - 1)
                meta = meta.flatten().to_numpy().reshape(part.num_rows, -1).astype(np.int64) if len(metadata) else np.zeros((part.num_rows, 0), np.int64)
                raw, _ = machine.raw(*machine.rows(features(part.column(part.num_columns - 2)), meta), part.num_rows)
                scores = logistic(raw.astype(float))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.coalesce(text, F.lit("")).alias("_text"), _meta(docs, metadata).alias("_meta"))
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names] + ["score double, predicted int"])
    return rows.mapInArrow(judge, schema)


def held_out(id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % 3 == 1


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, metadata: list[str] = [], keep: list[str] | None = None) -> DataFrame:  # noqa: B006
    """`score` of all documents by what the labels of those outside the held-out fold teach."""
    machine = fit(docs, labels.where(~held_out()), sample, metadata)
    return score(docs, machine, metadata, keep=keep)
