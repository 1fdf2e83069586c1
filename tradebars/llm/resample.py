"""Importance resampling towards a target: documents drawn by how much likelier their hashed n-grams are in the target texts.

Both sides are counted into a fixed number of n-gram buckets; a bucket's gain is the log ratio of its smoothed shares, a
document's weight the mean gain of its n-grams, and Gumbel noise from a hash of the id makes the highest scores a draw
without replacement. Texts of a batch are laid end to end with a sentinel that no word holds between them, so that one pass
of a regular expression finds the words of all; document offsets then tell, by binary search, which text a word is in, and
n-grams whose first and last words are in different ones are masked before they are counted.

Ranks need no window over all documents: scores are dealt out by range, sorted within partitions and written, and a row's
rank is its place there and the rows of the partitions before it.

Defined results: a null or empty text has no n-grams and weight 0; words are bytes, so text of any alphabet counts; a null id
hashes as the empty text and sorts last among equal scores; rows that share an id take the same noise each; repeated rows
count each; an empty target or table gives gains by smoothing alone; columns to keep pass through, and those of the names of
added ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebars.llm import _bytes as B
from tradebars.llm._tables import settle

BUCKETS = 10_000
#: Words of lower-cased UTF-8: digits, a-z and all bytes of longer characters.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SENTINEL = b"\n"
RESULT = ["n_features", "weight", "score", "rank"]


def features(column: pa.Array, longest: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and bucket of every n-gram of up to `longest` words, and the words of each text."""
    texts = [t.encode().lower() if t else b"" for t in column.to_pylist()]
    offsets = np.cumsum([len(t) + len(SENTINEL) for t in texts])  # where each next text begins
    joined = SENTINEL.join(texts)
    found = [(m.start(), m.group()) for m in WORD.finditer(joined)]
    owners = np.searchsorted(offsets, np.fromiter((a for a, _ in found), np.int64, len(found)), "right")
    words = [w for _, w in found]
    sums = list(map(crc32, words))
    texts_of, buckets_of = [owners], [np.array(sums, np.int64) % buckets]
    for n in range(2, longest + 1):
        # A CRC goes on where the shorter n-gram's ended.
        sums = [crc32(w, crc32(b" ", c)) for c, w in zip(sums, words[n - 1 :], strict=False)]
        whole = owners[: len(sums)] == owners[n - 1 :]
        texts_of.append(owners[: len(sums)][whole])
        buckets_of.append(np.array(sums, np.int64)[whole] % buckets)
    return np.concatenate(texts_of), np.concatenate(buckets_of), np.bincount(owners, minlength=len(texts))


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the n-grams of all texts in each bucket. A task passes on one row for each bucket at most."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in it:
            for part in B.chunks(batch, text):
                total += np.bincount(features(part.column(0), longest, buckets)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    return docs.select(text).mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket; `buckets` rows at most of either side reach the driver."""
    table = lambda df: (c := bucket_counts(df, text, longest, buckets).toPandas(), np.bincount(c.bucket, c.n, buckets) if len(c) else np.zeros(buckets))[1]
    s, t = table(docs), table(target)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def noise(seed: int, id: str = "doc_id") -> Column:
    """Gumbel noise in thousandths, from the hash of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, *, text: str = "text", id: str = "doc_id", longest: int = 1, buckets: int = BUCKETS,
    percent: int = 10, least_words: int = 20, seed: int = 2024, keep: list[str] | None = None,
) -> DataFrame:
    """The columns in `keep` (the id alone by default) with n_features, weight, score and rank, which is null for documents that
    are not drawn. Drawn are the best `percent` hundredths of those with `least_words` words or more."""
    names = [c for c in ([id] if keep is None else keep) if c.lower() not in RESULT]
    table = docs.sparkSession.sparkContext.broadcast(gains(docs, target, text, longest, buckets))

    def weigh(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = table.value
        for batch in it:
            for part in B.chunks(batch, text):
                owners, bucket, words = features(part.column(part.schema.get_field_index(text)), longest, buckets)
                n = np.bincount(owners, minlength=part.num_rows)
                total = np.zeros(part.num_rows, np.int64)
                np.add.at(total, owners, gain[bucket])
                weight = total // np.maximum(n, 1)
                columns = [part.column(part.schema.get_field_index(c)) for c in dict.fromkeys([*names, id])]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, (n, weight, words >= least_words))], names=[*dict.fromkeys([*names, id]), "n_features", "weight", "_fit"])

    held = [docs.schema[c] for c in dict.fromkeys([*names, id])]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in held] + ["n_features bigint", "weight bigint", "_fit boolean"])
    weighed = docs.select(*dict.fromkeys([*names, id, text])).mapInArrow(weigh, schema)
    scored = settle(weighed.withColumn("score", F.col("weight") + noise(seed, id)))
    fit = scored.where("_fit")
    drawn = fit.count() * percent // 100
    # Monotonic ids of the written order hold the partition and the place in it.
    order = [F.desc("score"), F.asc_nulls_last(id), F.desc("n_features"), F.desc("weight")]
    placed = settle(fit.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = {r["p"]: r["count"] for r in placed.groupBy(part.alias("p")).count().collect()}
    before = np.cumsum([0, *(n for _, n in sorted(sizes.items()))]).tolist()
    starts = docs.sparkSession.createDataFrame(list(zip(sorted(sizes), before, strict=False)), "_p bigint, _before bigint")
    place = F.col("_before") + F.col("_at") - F.shiftleft(part, 33) + 1
    ranked = placed.join(F.broadcast(starts), part == F.col("_p")).withColumn("rank", F.when(place <= drawn, place))
    return ranked.select(*names, *RESULT).unionByName(scored.where(~F.col("_fit")).select(*names, "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank")))


def draw(docs: DataFrame, target: DataFrame, *, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """The drawn documents, whole; of rows that share id and text all are drawn where one is. Their ids alone are ranked and joined."""
    key = F.xxhash64(F.coalesce(F.col(id).cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    ranked = resample(docs.select(id, text, key.alias("_key")), target, text=text, id=id, keep=["_key"], **options)
    return docs.join(ranked.where(F.col("rank").isNotNull()).select("_key"), key == F.col("_key"), "left_semi")
