"""Byte-level BPE encoding and decoding with padded numpy matrices.

Texts are cut by the vocabulary's pattern. The distinct cuts that a worker has not met before are grouped by length and
laid into padded matrices, one cut a row; in each round every row merges its leftmost pair of least rank, found by a
hashed pair lookup, and is compacted by one place. The rare cuts of more than `LONG` bytes make the same merges in the same
order, but from a heap of (rank, place), so that a run of a million signs takes seconds. Results stay in a bounded cache of the worker. Nothing is shuffled.

Defined results: a null or empty text has no ids and decodes to no bytes; special strings in texts are ordinary text;
repeated rows are encoded each; ids outside the vocabulary raise an error in `decode`; all other columns pass through,
and a column of the same name as an added one is replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from tradebars.llm import _bytes as B

#: Cuts that a worker remembers; beyond, it starts anew.
CACHE = 300_000
#: Cells of a matrix at most.
CELLS = 1 << 18
#: Cuts of more bytes than this, a round for each merge of which would take quadratic time, find each next merge in a heap.
LONG = 256
NONE = np.int32(0x7FFFFFFF)
_SLOTS = 20


class Vocabulary:
    """Ranks, the pair table and the bytes of each id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values(), default=-1) + 1
        by_id = [b""] * self.size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:k]], ranks[t[k:]], rank) for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.pairs = {a << 32 | b: rank for a, b, rank in pairs}
        self.keys = np.full(1 << _SLOTS, -1, np.int64)
        self.values = np.full(1 << _SLOTS, NONE, np.int32)
        a, b, rank = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 3
        if len(a) > 1 << (_SLOTS - 1):
            raise ValueError(f"{len(a)} pairs are too many for the pair table")
        key, left, self.probes = a << 32 | b, np.arange(len(a)), 0
        while len(left):  # linear probing, all pairs at once: of those that want a free slot, one gets it
            slot = (self._slot(key[left]) + self.probes) & ((1 << _SLOTS) - 1)
            free = self.keys[slot] == -1
            self.keys[slot[free]] = key[left[free]]
            placed = self.keys[slot] == key[left]
            self.values[slot[placed]] = rank[left[placed]]
            left = left[~placed]
            self.probes += 1

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank (and id) of each pair merged; NONE where it doesn't merge. Negative ids are padding."""
        key = a.astype(np.int64) << 32 | (b.astype(np.int64) & 0xFFFFFFFF)
        slot = self._slot(key)
        out = np.full(key.shape, NONE, np.int32)
        for _ in range(self.probes):
            hit = self.keys[slot] == key
            out[hit] = self.values[slot[hit]]
            slot = (slot + 1) & ((1 << _SLOTS) - 1)
        out[(a < 0) | (b < 0)] = NONE
        return out

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word (none empty), by matrices of words of like length."""
        out: list[np.ndarray | None] = [None] * len(words)
        rest = []
        for i, word in enumerate(words):
            if (rank := self.ranks.get(word)) is not None:
                out[i] = np.array([rank], np.int32)
            elif len(word) > LONG:
                out[i] = self._heaped(self.single[np.frombuffer(word, np.uint8)])
            else:
                rest.append(i)
        rest.sort(key=lambda i: len(words[i]))
        at = 0
        while at < len(rest):
            width = max(2, 1 << (len(words[rest[at]]) - 1).bit_length())
            stop = at
            while stop < len(rest) and len(words[rest[stop]]) <= width and (stop - at) * width < CELLS:
                stop += 1
            group = rest[at:stop]
            width = len(words[group[-1]])
            sizes = np.array([len(words[i]) for i in group])
            matrix = np.full((len(group), width), -1, np.int32)
            matrix[np.arange(width) < sizes[:, None]] = self.single[np.frombuffer(b"".join(words[i] for i in group), np.uint8)]
            self._rounds(matrix, sizes)
            for row, i, n in zip(matrix, group, sizes, strict=True):
                out[i] = row[:n].copy()
            at = stop
        return out

    def _rounds(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Merge in place until no row has a pair that merges."""
        rows = np.arange(len(ids))  # those that may still merge
        work = ids
        ranks = self.pair_ranks(work[:, :-1], work[:, 1:])
        while len(rows):
            best = ranks.min(axis=1, initial=NONE)
            live = best < NONE
            if not live.all():
                ids[rows[~live], : work.shape[1]] = work[~live]
                rows, work, ranks, best = rows[live], work[live], ranks[live], best[live]
                if not len(rows):
                    return
            each, place = np.arange(len(rows)), (ranks == best[:, None]).argmax(axis=1)
            columns = np.arange(work.shape[1])
            source = columns + (columns > place[:, None])
            source[:, -1] = np.minimum(source[:, -1], work.shape[1] - 1)
            work = np.take_along_axis(work, source, axis=1)
            work[:, -1] = -1
            work[each, place] = best
            sizes[rows] -= 1
            width = max(int(sizes[rows].max()), 2)
            between = np.arange(ranks.shape[1])
            ranks = np.take_along_axis(ranks, np.minimum(between + (between > place[:, None]), ranks.shape[1] - 1), axis=1)
            ranks[:, -1] = NONE
            ids[rows[:, None], np.arange(width, work.shape[1])[None, :]] = -1
            work, ranks = work[:, :width], ranks[:, : width - 1]
            for shift in (-1, 0):  # the pairs at both sides of the merged token
                left = place + shift
                ok = (left >= 0) & (left + 1 < width)
                r, c = each[ok], left[ok]
                ranks[r, c] = self.pair_ranks(work[r, c], work[r, c + 1])

    def _heaped(self, ids: np.ndarray) -> np.ndarray:
        """The ids of one long cut: always the leftmost pair of least rank, by a heap; pairs that are gone are passed over."""
        n = len(ids)
        ranks = self.pair_ranks(ids[:-1], ids[1:]).astype(np.int64)
        at = np.flatnonzero(ranks < NONE)
        heap = (ranks[at] << 32 | at).tolist()
        heapq.heapify(heap)
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        now = np.append(ranks, NONE).tolist()  # the rank of the pair that begins at each place
        none, pairs = int(NONE), self.pairs
        while heap:
            top = heapq.heappop(heap)
            rank, place = top >> 32, top & 0xFFFFFFFF
            if now[place] != rank:
                continue
            gone = after[place]
            ids[place], ids[gone], now[gone] = rank, -1, none
            after[place] = right = after[gone]
            if right < n:
                before[right] = place
                now[place] = found = pairs.get(rank << 32 | ids[right], none)
                if found != none:
                    heapq.heappush(heap, found << 32 | place)
            else:
                now[place] = none
            if (left := before[place]) >= 0:
                now[left] = found = pairs.get(ids[left] << 32 | rank, none)
                if found != none:
                    heapq.heappush(heap, found << 32 | left)
        out = np.array(ids, np.int32)
        return out[out >= 0]

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of consecutive runs of ids."""
        if len(flat) and (flat.min() < 0 or flat.max() >= self.size):
            raise ValueError("an id is not in the vocabulary")
        lengths = self.lengths[flat]
        total = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.starts[flat] - total[:-1], lengths) + np.arange(total[-1])
        data = self.bytes[at].tobytes()
        edges = total[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[a:b] for a, b in zip(edges, edges[1:], strict=False)]


@lru_cache(4)
def read(path: str, pattern: str) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)


class _Known(dict):
    """Indexes of cuts; a cut not met before gets the next one and waits to be merged."""

    def __init__(self):
        self.waiting: list[str] = []

    def __missing__(self, cut: str) -> int:
        self[cut] = index = len(self)
        self.waiting.append(cut)
        return index


class Encoder:
    """Encodes lists of texts and remembers the ids of their cuts."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        self.known, self.flat, self.starts, self.counts = _Known(), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the number of ids of each text."""
        if len(self.known) > CACHE:
            self._clear()
        cuts = [self.vocabulary.pattern.findall(t) for t in texts]
        per_text = np.array([len(c) for c in cuts], np.int64)
        index = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cuts)), np.int64, int(per_text.sum()))
        if self.known.waiting:
            new = self.vocabulary.merge([c.encode() for c in self.known.waiting])
            self.known.waiting = []
            counts = np.array([len(x) for x in new], np.int64)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.flat = np.concatenate([self.flat, *new])
        n = self.counts[index]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(self.starts[index] - total[:-1], n) + np.arange(total[-1])]
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(per_text)])])


def _schema(docs: DataFrame, names: list[str], added: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in (docs.schema[c] for c in names)] + [added])


def _with(part: pa.RecordBatch, names: list[str], arrays: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in names] + list(arrays.values()), names=[*names, *arrays])


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """The columns in `keep` (all by default) and `ids array<int>`; with `decoded` also the bytes decoded from the ids.

    `ranks_path` is the place of the vocabulary on every worker, or the name of a file given to addFile().
    """
    added = ["ids", "decoded"] if decoded else ["ids"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]

    @B.lean
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = read(ranks_path if "/" in ranks_path else SparkFiles.get(ranks_path), pattern)
        encoder = Encoder(vocabulary)
        for batch in it:
            for part in B.chunks(batch, text):
                texts = [t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                ids, counts = encoder.encode(texts)
                found = {"ids": _lists(ids, counts)}
                if decoded:
                    found["decoded"] = pa.array(vocabulary.decode(ids, counts), pa.binary())
                yield _with(part, names, found)

    schema = _schema(docs, names, "ids array<int>" + ", decoded binary" * decoded)
    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(batches, schema)


def decode(docs: DataFrame, ranks_path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns in `keep` (all by default) and `decoded binary`, the bytes that the ids stand for."""
    names = [c for c in (docs.columns if keep is None else keep) if c != "decoded"]

    @B.lean
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = read(ranks_path if "/" in ranks_path else SparkFiles.get(ranks_path), "")
        for batch in it:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                column = part.column(part.schema.get_field_index(ids))
                flat = np.asarray(column.flatten(), np.int64)
                counts = np.array([len(x) if x is not None else 0 for x in column], np.int64)
                yield _with(part, names, {"decoded": pa.array(vocabulary.decode(flat, counts), pa.binary())})

    return docs.select(*dict.fromkeys([*names, ids])).mapInArrow(batches, _schema(docs, names, "decoded binary"))
