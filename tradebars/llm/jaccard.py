"""N-gram Jaccard join by vertical partitioning, exact at the threshold, and the groups that its links form.

A document's set holds the 64-bit hashes of its distinct five-word shingles. Documents with equal sets are one class, so
copies cost nothing beyond their own scan. The work on classes:

1. Screen. In hash order, the first n - ceil(0.8 n) + l shingles of two linked sets have l in common at least (l is 0.15 n
   here, and 0.15 of 0.8 n where the partner may be smaller). Only these are dealt into fragments of the order; each
   fragment counts, per class, the shingles that another class has too, and the counts are summed per class. A class below
   its bound has no link. Most texts end here, having moved a third of their shingles once. Of a shingle that many classes
   of a task share, the task passes on two and counts the others itself, so no shingle fills a fragment.
2. Fragments. The whole sets of the remaining classes are cut at the fragments of the n-gram order. Tasks count how many
   classes have each shingle, the counts are summed by fragment, and then meet the sets: what no other class has is
   dropped, the rest goes on with its count. A fragment that a hot shingle makes large is dealt out by class, with a copy of
   its counts for each part.
3. Candidates. Ordered from rare to common, each class takes its prefix of n - ceil(0.8 n) + 1; linked classes share a
   shingle there. Those that share one are not paired with each other: each meets the leader of the shingle, the class
   whose shingles most others have (in a group of edited copies, the original). Where many classes share a shingle, only
   those of sizes that can link make a group. Shingles with the same classes are one.
   Passages that many texts repeat come last in this order, so they make no candidates by themselves, and a pair is dropped
   where the sets from the shared place on are too small for the overlap it needs.
4. Partial overlaps. For every (member, leader) pair, each fragment counts the overlap of its two segments; the sum per
   pair decides. Members of a large group are dealt out by a salt with a copy of the leader's segment.
5. Further rounds. In groups whose classes are still in several components, some more classes lead, and meet only classes
   of other components; leaders are broadcast while they are few, else the members of a group are dealt out by a salt. The
   groups that this leaves in several components are cut into tiles, and each two tiles are compared as whole arrays. In
   both, a pair is counted only where bit marks allow a link: the parities of the shared shingles in 512 buckets differ in
   no more places than the sets do, so in a group of copies near the threshold, few pairs become rows. Then every pair
   that shares a prefix shingle was counted, ruled out or is connected already, so the components are those of all links.

Defined results: null, empty or blank texts have empty sets and link to nothing; texts of fewer than five words have one
shingle, the whole sequence; repeated rows and copies are in one component; rows with a null doc_id take part and the
component's id is its least non-null doc_id; an empty table gives an empty result. Distinct sets are told apart by a 64-bit
signature, whose chance of any collision is about 3 % among a thousand million sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradebars.llm import _bytes as B
from tradebars.llm._graph import components
from tradebars.llm._tables import settle, shield

WORDS = 5
#: Bytes of hashes that a fragment holds about.
FRAGMENT_BYTES = 8 << 20
#: Pairs of a shingle and its class that a task holds before it passes them on.
HELD = 1 << 20
#: Classes up to which the list of remaining documents is broadcast (8 bytes each); beyond, it is joined by key.
BROADCAST_ROWS = 1 << 20
#: Leaders of all groups up to which they are broadcast (120 bytes each); beyond, they are joined by key and salt.
BROADCAST_LEADERS = 1 << 17
#: Leaders of a group in the second round, after the first one.
LEADERS = 16
#: Members of a tile in the last round, and of those the ones that are compared with another tile at once.
TILE, STRIP = 2048, 128
#: Classes of a shingle from which on they are grouped by size; sizes of linked sets lie in one band or in the next.
MANY, BAND = 64, 1.26
#: Members of a leader that share one copy of its segment, and of a group that share one copy of its leaders.
SALT, SALTED = 256, 4096
#: Buckets of a class's bit marks; marks are words of 64 of them.
MARKS = 512
U = np.uint64


def _need(n: np.ndarray) -> np.ndarray:
    """Least overlap of a set of n with any that it links to: ceil(0.8 n)."""
    return -(-4 * n // 5)


def _extra(n: np.ndarray) -> np.ndarray:
    return np.maximum(1, 3 * n // 20)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All hashes (sorted within each text), the size of each text's set, and its signature."""
    texts = B.Texts(column, B.LOWER)
    starts, ends = texts.spans(B.SPACE)
    owner = texts.owner(starts)
    words = texts.hashes(starts, ends)
    hashes, first = B.windows(words, owner, WORDS)
    of = owner[first]
    n_words = np.bincount(owner, minlength=len(texts))
    short = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    if len(short):
        at = np.cumsum(n_words) - n_words
        whole = np.zeros(len(short), U)
        for k in range(WORDS - 1):
            more = n_words[short] > k
            whole[more] = B.mix(whole[more] * U(31) + words[at[short[more]] + k] + U(977 + k))
        hashes, of = np.concatenate([hashes, whole]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        hashes, of = hashes[order], of[order]
    edges = np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[fresh], of[fresh]
    sizes = np.bincount(of, minlength=len(texts))
    total = np.concatenate([np.zeros(1, U), np.cumsum(B.mix(hashes ^ U(0x5DEECE66D)), dtype=U)])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return hashes, sizes, B.mix(total[bounds[1:]] - total[bounds[:-1]] + sizes.astype(U))


def _pieces(fragment: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(fragment, bytes of each column) by fragment."""
    order = np.argsort(fragment, kind="stable")
    fragment, columns = fragment[order], [c[order] for c in columns]
    cut = np.flatnonzero(np.diff(fragment, prepend=-1, append=-1))
    for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False):
        yield int(fragment[a]), *[c[a:b].tobytes() for c in columns]


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _batches(rows: Iterable[tuple], fields: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    """Batches of the rows with about CHUNK_BYTES of bytes each, so that neither side of the task holds all of them."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= B.CHUNK_BYTES:
            yield _batch(held, fields)
            held, size = [], 0
    if held:
        yield _batch(held, fields)


def _held(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[list[tuple[np.ndarray, ...]]]:
    """Lists of parts whose first arrays have HELD values together, about. The taker may clear a list to free its parts."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= HELD:
            yield held
            held, size = [], 0
    if held:
        yield held


def _fragment(hashes: np.ndarray, fragments: int) -> np.ndarray:
    """The fragment of the order by the low half of the hash; the high half orders within a text."""
    return ((hashes & U(0xFFFFFFFF)) * U(fragments) >> U(32)).astype(np.int64)


def _joined(table: pa.Table, name: str, kind: type = U) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x is not None), kind)


def _screen(docs: DataFrame, fragments: int) -> DataFrame:
    """For each document (doc_id, n, sig, own), and for each class and fragment (sig, shared).

    `shared` counts shingles that were passed on and another class has too, `own` those that the task didn't pass on, as it
    had two other classes with them. A class has no more such shingles than the sum of `shared` and its least `own`.
    """
    fields = [("fragment", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n", pa.binary()), ("own", pa.binary()), ("keys", pa.binary()), ("hashes", pa.binary())]

    def fronts(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in it:
            for part in B.chunks(batch, "text"):
                hashes, sizes, sigs = shingles(part.column(1))
                rank = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                front = rank < np.repeat(sizes - _need(sizes) + _extra(sizes), sizes)
                yield hashes[front], np.repeat(sigs, sizes)[front], sizes.astype(np.int64), sigs, part.column(0).to_pylist()

    @B.lean
    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = TaskContext.get().partitionId() * 7919
        for number, held in enumerate(_held(fronts(it))):
            of_texts = [h[2:] for h in held]
            hashes, keys = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            held.clear()
            hashes, keys = _distinct(hashes, keys)
            first = _common(hashes)[0]
            rank = np.arange(len(hashes)) - np.repeat(first, np.diff(np.append(first, len(hashes))))
            own, n_own = np.unique(keys[rank > 1], return_counts=True)
            own, n_own = np.append(own, ~U(0)), np.append(n_own, 0)
            hashes, keys = hashes[rank < 2], keys[rank < 2]
            del first, rank
            sigs = np.concatenate([t[1] for t in of_texts])
            at = np.searchsorted(own, sigs)
            counted = np.where(own[at] == sigs, n_own[at], 0).astype(np.int64)
            texts = (-1 - (spread + number) % fragments, [d for t in of_texts for d in t[2]], np.concatenate([t[0] for t in of_texts]).tobytes(), counted.tobytes(), sigs.tobytes(), None)
            pieces = ((f, None, None, None, k, h) for f, k, h in _pieces(_fragment(hashes, fragments), keys, hashes))
            yield from _batches(chain(pieces, [texts]), fields)

    @B.lean_group
    def count(table: pa.Table) -> pa.Table:
        keys = _joined(table, "keys")
        if table.column("fragment")[0].as_py() < 0:
            ids = table.column("doc_ids").combine_chunks().flatten()
            n, own = _joined(table, "n", np.int64), _joined(table, "own", np.int64)
            return pa.table({"sig": keys.view(np.int64), "n": n, "doc_id": ids, "own": own, "shared": pa.nulls(len(n), pa.int64())})
        hashes, keys = _distinct(_joined(table, "hashes"), keys)
        sig, shared = np.unique(keys[_common(hashes)[1] > 1], return_counts=True)
        none = pa.nulls(len(sig), pa.int64())
        return pa.table({"sig": sig.view(np.int64), "n": none, "doc_id": none, "own": none, "shared": pa.array(shared.astype(np.int64))})

    dealt = docs.select("doc_id", "text").mapInArrow(deal, "fragment int, doc_ids array<bigint>, n binary, own binary, keys binary, hashes binary")
    return dealt.groupBy("fragment").applyInArrow(count, "sig bigint, n bigint, doc_id bigint, own bigint, shared bigint")


def _distinct(hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, key) pairs, by hash."""
    order = np.lexsort((keys, hashes))
    hashes, keys = hashes[order], keys[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1])
    return hashes[fresh], keys[fresh]


def _common(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted hashes: the first place of each run, and for each hash the length of its run."""
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    return first, np.repeat(np.diff(np.append(first, len(hashes))), np.diff(np.append(first, len(hashes))))


def _cut(docs: DataFrame, fragments: int) -> DataFrame:
    """(fragment, sig, hashes, classes): for each class and fragment the shingles that other classes have too, and how many
    classes have them (more where a task's share of a class is counted twice)."""
    fields = [("fragment", pa.int32()), ("keys", pa.binary()), ("hashes", pa.binary()), ("seen", pa.binary()), ("times", pa.binary())]

    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in it:
            for part in B.chunks(batch, "text"):
                hashes, sizes, sigs = shingles(part.column(0))
                yield hashes, np.repeat(sigs, sizes)

    @B.lean
    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(sets(it)):
            hashes, keys = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            held.clear()
            hashes, keys = _distinct(hashes, keys)
            first = _common(hashes)[0]
            times = np.diff(np.append(first, len(hashes))).astype(np.int32)
            sets_of = ((f, k, h, None, None) for f, k, h in _pieces(_fragment(hashes, fragments), keys, hashes))
            counts_of = ((f, None, None, h, t) for f, h, t in _pieces(_fragment(hashes[first], fragments), hashes[first], times))
            yield from _batches(chain(sets_of, counts_of), fields)

    @B.lean_group
    def total(table: pa.Table) -> pa.Table:
        hashes, times = _joined(table, "seen"), _joined(table, "times", np.int32)
        order = np.argsort(hashes, kind="stable")
        hashes, times = hashes[order], times[order]
        first = _common(hashes)[0]
        sums = np.add.reduceat(times, first, dtype=np.int64)
        common = sums > 1
        sums = sums[common]
        return pa.table({"fragment": table.column("fragment").slice(0, 1), "seen": pa.array([hashes[first[common]].tobytes()], pa.binary()), "times": pa.array([np.minimum(sums, 2**31 - 1).astype(np.int32).tobytes()], pa.binary()), "pairs": pa.array([int(sums.sum())], pa.int64())})

    @B.lean
    def split(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for fragment, parts, keys, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, hashes = np.frombuffer(keys, U), np.frombuffer(hashes, U)
                rows = ((fragment, part, k, h, None, None) for part, k, h in _pieces((keys % U(parts)).astype(np.int64), keys, hashes))
                yield from _batches(rows, [fields[0], ("part", pa.int32()), *fields[1:]])

    @B.lean_group
    def mark(table: pa.Table) -> pa.Table:
        hashes, keys = _distinct(_joined(table, "hashes"), _joined(table, "keys"))
        seen, times = _joined(table, "seen"), _joined(table, "times", np.int32)
        if not len(seen):
            hashes, keys, seen, times = hashes[:0], keys[:0], np.zeros(1, U), np.zeros(1, np.int32)
        at = np.minimum(np.searchsorted(seen, hashes), len(seen) - 1)
        known = seen[at] == hashes
        hashes, keys, classes = hashes[known], keys[known], times[at[known]]
        order = np.argsort(keys, kind="stable")
        hashes, keys, classes = hashes[order], keys[order], classes[order]
        first = _common(keys)[0]
        edges = list(zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=False)) if len(keys) else []
        fragment = table.column("fragment")[0].as_py()
        return pa.table({
            "fragment": pa.array([fragment] * len(edges), pa.int32()), "sig": keys[first].view(np.int64),
            "hashes": pa.array([hashes[a:b].tobytes() for a, b in edges], pa.binary()), "classes": pa.array([classes[a:b].tobytes() for a, b in edges], pa.binary()),
        })

    dealt = settle(docs.select("text").mapInArrow(deal, "fragment int, keys binary, hashes binary, seen binary, times binary"))
    counts = dealt.where("seen is not null").select("fragment", "seen", "times").groupBy("fragment").applyInArrow(total, "fragment int, seen binary, times binary, pairs bigint")
    counts = settle(counts.withColumn("parts", F.greatest(F.lit(1), F.ceil(16 * F.col("pairs") / (4 * FRAGMENT_BYTES))).cast("int")))
    sets_ = dealt.where("keys is not null").select("fragment", "keys", "hashes")
    if (counts.agg(F.max("parts")).first()[0] or 1) > 1:
        sized = sets_.join(counts.select("fragment", "parts"), "fragment").select("fragment", "parts", "keys", "hashes")
        sets_ = sized.mapInArrow(split, "fragment int, part int, keys binary, hashes binary, seen binary, times binary")
    else:
        sets_ = sets_.select("fragment", F.lit(0).alias("part"), "keys", "hashes", F.lit(None).cast("binary").alias("seen"), F.lit(None).cast("binary").alias("times"))
    none = F.lit(None).cast("binary")
    copies = counts.select("fragment", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), none.alias("keys"), none.alias("hashes"), "seen", "times")
    return sets_.union(copies).groupBy("fragment", "part").applyInArrow(mark, "fragment int, sig bigint, hashes binary, classes binary")


def _by_runs(it: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of a sorted partition that end where the key changes."""
    held: list[pa.RecordBatch] = []
    for batch in it:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
        if cut == 0 and held and held[-1].column(batch.schema.get_field_index(key))[-1].as_py() != keys[-1]:
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _prefixes(cut: DataFrame, classes: DataFrame) -> DataFrame:
    """(hash, classes, sig, n, place, score, marks): the prefix of each class, from rare to common, by place in that order; the
    score is how many classes have one of its shingles, on average, in thousandths. The first row of a class has its marks:
    how many of its shingles no other class has, and the bits of the others."""
    words = [f"b{i}" for i in range(MARKS // 64)]

    @B.lean
    def take(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_runs(it, "sig"):
            lengths = np.array([len(x) for x in table.column("hashes").to_pylist()]) // 8
            hashes = _joined(table, "hashes")
            common = np.frombuffer(b"".join(table.column("classes").to_pylist()), np.int32)
            sig = np.repeat(table.column("sig").to_numpy(), lengths)
            n = np.repeat(table.column("n").to_numpy(), lengths)
            order = np.lexsort((hashes.view(np.int64), common, sig))  # as the table is ordered too
            hashes, sig, n = hashes[order], sig[order], n[order]
            first = _common(sig)[0]
            shared = np.diff(np.append(first, len(sig)))
            rank = np.arange(len(sig)) - np.repeat(first, shared)
            spread = np.concatenate([[0], np.cumsum(common[order], dtype=np.int64)])
            score = np.repeat((spread[first + shared] - spread[first]) * 1000 // n[first] if len(n) else shared, shared)
            place = rank + n - np.repeat(shared, shared)  # those that nobody shares come before all
            keep = place < n - _need(n) + 1
            run = np.repeat(np.arange(len(first)), shared)
            odd = np.bincount(run * MARKS + (B.mix(hashes) % U(MARKS)).astype(np.int64), minlength=len(first) * MARKS) & 1
            bits = np.packbits(odd.astype(bool)).view(np.int64).reshape(len(first), MARKS // 64)[run[keep]]
            marks = pa.StructArray.from_arrays([pa.array((n - np.repeat(shared, shared))[keep]), *(pa.array(b) for b in bits.T)], names=["lone", *words], mask=pa.array(rank[keep] > 0))
            columns = [hashes.view(np.int64), common[order], sig, n, place, score]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[keep]) for c in columns), marks], names=["hash", "classes", "sig", "n", "place", "score", "marks"])

    rows = cut.join(classes.select("sig", "n"), "sig").select("sig", "n", "hashes", "classes")
    return rows.repartition("sig").sortWithinPartitions("sig").mapInArrow(take, f"hash bigint, classes int, sig bigint, n bigint, place bigint, score bigint, marks struct<lone: bigint, {', '.join(f'{w}: bigint' for w in words)}>")


def _overlaps(cut: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, overlap) of the pairs (a, b): counted in each fragment, then summed."""
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(1 << 20)))
    width = pairs.groupBy("b").agg(F.ceil(F.count("*") / SALT).alias("width"))
    members = cut.join(pairs.join(width, "b"), cut["sig"] == F.col("a")).select(F.col("b").alias("lead"), "fragment", (F.col("salt") % F.col("width")).alias("salt"), F.col("a").alias("member"), "hashes")
    leaders = cut.join(width, cut["sig"] == F.col("b")).select(F.col("b").alias("lead"), "fragment", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("salt"), F.lit(None).cast("bigint").alias("member"), "hashes")
    rows = leaders.union(members).withColumn("place", F.xxhash64("lead", "fragment", "salt"))
    rows = rows.select("place", "lead", "member", "hashes").repartition("place").sortWithinPartitions("place", F.asc_nulls_first("member"))

    @B.lean
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader: tuple[np.ndarray, np.ndarray] = np.zeros(0, np.int64), np.zeros(0, U)
        for batch in it:
            place = batch.column(0).to_numpy()
            leads = batch.column(2).is_null().to_numpy(zero_copy_only=False)
            segments = batch.column(3).to_pylist()
            lengths = np.array([len(x) for x in segments], np.int64) // 8
            tag = np.repeat(B.mix(place.view(U)), lengths)
            keys = B.mix(np.frombuffer(b"".join(segments), U) + tag)
            lead_rows = np.repeat(leads, lengths)
            known = np.sort(np.concatenate([leader[1], keys[lead_rows]]))
            mine = keys[~lead_rows]
            at = np.searchsorted(known, mine)
            hit = np.concatenate([known, np.zeros(1, U)])[at] == mine if len(known) else np.zeros(len(mine), bool)
            total = np.concatenate([[0], np.cumsum(hit)])
            ends = np.cumsum(lengths[~leads])
            found = total[ends] - total[ends - lengths[~leads]]
            if len(place):  # a group may go on in the next batch
                last = place == place[-1]
                carried = keys[np.repeat(last & leads, lengths)]
                if len(carried) or not (len(leader[0]) and leader[0][0] == place[-1]):
                    leader = place[-1:], carried
            yield pa.RecordBatch.from_arrays([batch.column(2).filter(pa.array(~leads)), batch.column(1).filter(pa.array(~leads)), pa.array(found.astype(np.int64))], names=["a", "b", "overlap"])

    return rows.mapInArrow(count, "a bigint, b bigint, overlap bigint").groupBy("a", "b").agg(F.sum("overlap").alias("overlap"))


def _linked(cut: DataFrame, pairs: DataFrame) -> DataFrame:
    sizes = pairs.select("a", "b", "na", "nb")
    found = _overlaps(cut, pairs.select("a", "b"))
    return found.join(sizes, ["a", "b"]).where("100 * overlap >= 80 * (na + nb - overlap)").select("a", "b")


#: What the first shingle that two linked classes have in common allows: the sets from there on hold the overlap.
_FITS = "9 * (na - pa) >= 4 * (na + nb) and 9 * (nb - pb) >= 4 * (na + nb) and a != b"
#: What bit marks allow: linked sets differ in a ninth of their sizes at most, and in as many shingles at least as are theirs
#: alone or as bits differ.
_NEAR = f"9 * (marks.lone + mb.lone + {' + '.join(f'bit_count(marks.b{i} ^ mb.b{i})' for i in range(MARKS // 64))}) <= n + nb"


def _once(pairs: DataFrame) -> DataFrame:
    return pairs.where(_FITS).groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"))


def _relabelled(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after more links: components of the old components."""
    ends = found.join(labels.withColumnsRenamed({"node": "a", "label": "la"}), "a", "left").join(labels.withColumnsRenamed({"node": "b", "label": "lb"}), "b", "left")
    edges = ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a != b").distinct()
    merged = components(settle(edges, found.count())).select(F.col("node").alias("label"), F.col("label").alias("next"))
    lone = found.select(F.col("a").alias("node")).union(found.select("b")).distinct().join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    all_ = labels.union(lone)
    return settle(all_.join(merged, "label", "left").select("node", F.coalesce("next", "label").alias("label")), all_.count())


def _grouped(prefixes: DataFrame) -> DataFrame:
    """The prefixes by group: a shingle, or, where many classes have it, those of two neighbouring bands of size."""
    band = F.floor(F.log("n") / math.log(BAND))
    bands = F.when(F.col("classes") > MANY, F.array(band - 1, band)).otherwise(F.array(F.lit(-2).cast("bigint")))
    return prefixes.withColumn("band", F.explode(bands)).withColumnsRenamed({"hash": "gram"}).withColumn("hash", F.xxhash64("gram", "band")).drop("band")


def _links(cut: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(node, label) of the linked classes."""
    marks = prefixes.where("marks is not null").select("sig", "marks")
    prefixes = _grouped(prefixes.drop("marks"))
    groups = prefixes.groupBy("classes", "gram", "hash").agg(F.max(F.struct("score", "sig", "n", "place")).alias("lead"), F.count("*").alias("m"), F.bit_xor(F.xxhash64("sig")).alias("members")).where("m > 1")
    # Of groups with the same classes the first in the order stays: its places are those that `_FITS` is about.
    groups = settle(groups.groupBy("m", "members").agg(F.min(F.struct("classes", "gram", "hash", "lead")).alias("first")).select("first.hash", "first.lead"))
    met = settle(prefixes.drop("classes", "gram").join(groups, "hash"))
    first = met.select(F.col("sig").alias("a"), F.col("lead.sig").alias("b"), F.col("n").alias("na"), F.col("lead.n").alias("nb"), F.col("place").alias("pa"), F.col("lead.place").alias("pb"))
    pairs = settle(_once(first))
    labels = components(settle(_linked(cut, pairs), pairs.count()))
    for tiled in (False, True):
        named = met.join(labels, met["sig"] == labels["node"], "left").select("hash", "sig", "n", "place", "score", F.coalesce("label", "sig").alias("label"))
        least = 1 + LEADERS * tiled  # groups of so many classes have met as a whole
        mixed = settle(named.groupBy("hash").agg(F.count("*").alias("m"), F.min("label").alias("low"), F.max("label").alias("high")).where(f"m > {least + 1} and low != high").select("hash", "m"))
        left = mixed.agg(F.count("*").alias("groups"), F.sum("m").alias("rows")).first()
        if not left.groups:
            return labels
        open_rows = named.join(F.broadcast(mixed) if left.groups <= BROADCAST_LEADERS else mixed, "hash")
        open_rows = settle(open_rows.join(marks, "sig"), left.rows)
        new = _once(_tiled(open_rows) if tiled else _led(open_rows, left.groups))
        new = settle(new.join(pairs.select("a", "b"), ["a", "b"], "left_anti"))
        tried = new.count()
        if tried:
            pairs = pairs.union(new)
            found = settle(_linked(cut, new), tried)
            if not found.isEmpty():
                labels = _relabelled(labels, found)
    return labels


def _led(open_rows: DataFrame, groups: int) -> DataFrame:
    """Pairs of each group's members with its next leaders, where component and marks leave it open whether they link."""
    # Only ranks up to the last new leader are asked for, so each task passes on no more of a group than these.
    ranked = open_rows.withColumn("rank", F.row_number().over(Window.partitionBy("hash").orderBy(F.desc("score"), F.desc("sig")))).where(f"rank <= {1 + LEADERS}")
    leaders = settle(ranked.where("rank > 1").select("hash", "m", F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("label").alias("lb"), F.col("score").alias("sb"), F.col("marks").alias("mb")), groups * LEADERS)
    if leaders.count() <= BROADCAST_LEADERS:
        new = open_rows.drop("m").join(F.broadcast(leaders.drop("m")), "hash")
    else:
        width = F.ceil(F.col("m") / SALTED).cast("bigint")
        copies = leaders.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), width - 1)).alias("salt")).drop("m")
        new = open_rows.withColumn("salt", F.pmod(F.xxhash64("sig"), width)).drop("m").join(copies, ["hash", "salt"])
    new = new.where("(score < sb or score = sb and sig < b) and label != lb").where(_NEAR)
    return new.select(F.col("sig").alias("a"), "b", F.col("n").alias("na"), "nb", F.col("place").alias("pa"), "pb")


def _tiled(open_rows: DataFrame) -> DataFrame:
    """Pairs of members of a group, where component and marks leave it open whether they link.

    A group's members are dealt into tiles, and each two tiles meet in one place, where whole arrays of marks are compared:
    only the pairs that are left ever become rows.
    """
    width = F.ceil(F.col("m") / TILE).cast("int")
    own = open_rows.withColumn("own", F.pmod(F.xxhash64("sig"), width).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), width - 1)))
    place = F.xxhash64("hash", F.least("own", "other"), F.greatest("own", "other"))
    rows = own.select(place.alias("tile"), F.sign(F.col("other") - F.col("own")).cast("int").alias("side"), "sig", "n", "place", "score", "label", "marks.*")

    @B.lean_group
    def near(table: pa.Table) -> pa.Table:
        at = {c: table.column(c).to_numpy() for c in ("side", "sig", "n", "place", "score", "label", "lone")}
        bits = np.stack([table.column(f"b{i}").to_numpy() for i in range(MARKS // 64)])
        ones, others = np.flatnonzero(at["side"] >= 0), np.flatnonzero(at["side"] <= 0)
        found = [np.zeros((2, 0), np.int64)]
        for k in range(0, len(ones), STRIP):
            x = ones[k : k + STRIP, None]
            apart = at["lone"][x] + at["lone"][others]
            for word in bits:
                apart = apart + np.bitwise_count(word[x] ^ word[others])
            both = at["n"][x] + at["n"][others]
            open_ = (9 * apart <= both) & (at["label"][x] != at["label"][others])
            open_ &= (9 * (at["n"] - at["place"])[x] >= 4 * both) & (9 * (at["n"] - at["place"])[others] >= 4 * both)
            i, j = np.nonzero(open_)
            i, j = ones[k + i], others[j]
            i, j = (i[i < j], j[i < j]) if at["side"][0] == 0 else (i, j)  # a tile with itself
            later = (at["score"][i] > at["score"][j]) | ((at["score"][i] == at["score"][j]) & (at["sig"][i] > at["sig"][j]))
            found.append(np.stack([np.where(later, j, i), np.where(later, i, j)]))
        a, b = np.concatenate(found, axis=1)
        return pa.table([at[c][x] for c in ("sig", "n", "place") for x in (a, b)], names=["a", "b", "na", "nb", "pa", "pb"])

    return rows.groupBy("tile").applyInArrow(near, "a bigint, b bigint, na bigint, nb bigint, pa bigint, pb bigint")


def join_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs(doc_id, text)."""
    docs = docs.select("doc_id", "text")
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    screened = settle(_screen(docs, max(16, math.ceil(volume / 2 / FRAGMENT_BYTES))))
    rows = screened.where("shared is null").select("doc_id", "n", "sig", "own")
    classes = settle(rows.where("n > 0").groupBy("sig").agg(F.max("n").alias("n"), F.min("doc_id").alias("doc_id"), F.min("own").alias("own")))
    bound = F.greatest(F.lit(1), F.floor(3 * F.ceil(4 * F.col("n") / 5) / 20))
    shared = screened.where("shared is not null").groupBy("sig").agg(F.sum("shared").alias("shared"))
    left = settle(classes.join(shared, "sig", "left").where(F.coalesce("shared", F.lit(0)) + F.col("own") >= bound).select("sig", "n", "doc_id"))
    size = left.agg(F.count("*").alias("rows"), F.sum("n").alias("n")).first()
    labels = None
    if size.rows:
        ids = left.select(F.col("doc_id").alias("_id")).distinct()
        again = docs.join(F.broadcast(ids) if size.rows <= BROADCAST_ROWS else ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        cut = settle(_cut(again, max(16, math.ceil(8 * size.n / FRAGMENT_BYTES))))
        labels = _links(cut, settle(_prefixes(cut, left)))
        named = labels.join(classes, labels["node"] == classes["sig"]).select("sig", "label", "doc_id")
        least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        labels = settle(named.join(least, "label").select("sig", "component_id"))
        classes = classes.join(labels, "sig", "left").select("sig", F.coalesce("component_id", "doc_id").alias("component_id"))
    else:
        classes = classes.select("sig", F.col("doc_id").alias("component_id"))
    out = rows.withColumn("key", F.when(F.col("n") > 0, F.col("sig"))).join(classes.withColumnRenamed("sig", "key"), "key", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the least doc_id, with the columns of docs.

    A document is a doc_id with a text: repeated rows of both are one document and one row stays, while different texts of
    one doc_id are told apart, as are those with a null doc_id, which stay where nothing else of their component has one.
    Documents are told apart by 64-bit hashes.
    """
    inner, restore = shield(docs, ["_key", "_keep"])
    inner = inner.withColumn("_key", F.xxhash64("doc_id", "text"))
    groups = join_groups(inner.select(F.col("_key").alias("doc_id"), "text")).groupBy(F.col("doc_id").alias("_key")).agg(F.max("component_id").alias("component_id"), F.count("*").alias("rows"))
    named = groups.join(inner.select("_key", "doc_id").distinct(), "_key")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key", "rows")).alias("first")
    firsts = settle(named.groupBy("component_id").agg(first).select(F.col("first._key").alias("_keep"), F.col("first.rows").alias("rows")))
    small = firsts.count() <= BROADCAST_ROWS

    def kept(some: DataFrame) -> DataFrame:
        some = some.select("_keep")
        return inner.join(F.broadcast(some) if small else some, inner["_key"] == F.col("_keep"), "left_semi")

    # Only rows that are repeated are shuffled with their texts.
    twice = firsts.where("rows > 1")
    once = kept(firsts.where("rows = 1"))
    return restore(once if twice.isEmpty() else once.union(kept(twice).dropDuplicates(["_key"])))
