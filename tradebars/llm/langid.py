"""Language identification with unigram pieces, summed over all segmentations.

A word's probability in a language is the sum, over every way to cut it into pieces of a fixed public vocabulary, of the
products of the pieces' probabilities; the forward algorithm gives it in one pass. A text is scored by the sum of its
words' log-probabilities. Piece probabilities of each language are fitted by a few rounds of expectation-maximisation, whose
expected counts are gathered as a Spark aggregation, on a bounded sample of labelled documents.

Words are runs of letters of the lower-cased text, each with a blank before it, as UTF-8 bytes; every byte is itself a piece,
so that any word has a segmentation. Pieces are as long as the vocabulary has them and words as long as the texts have them:
the forward values are kept in units of a late one, so that they never vanish, and long words are worked through in
stretches that pass on the last values.

Defined results: `und` and score 0 where the text is null, has no letter, or no language was learned; equal scores go to the
language that sorts first; a null doc_id counts as the empty text in the fold rule; repeated rows get the same prediction
each, and count once in the sample; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradebars.llm import _bytes as B
from tradebars.llm._tables import settle

#: Labelled documents of each language that the probabilities are fitted on, those of the least hash of doc_id and text.
SAMPLE = 1000
ROUNDS = 3
#: Bytes of a word that are looked at together; longer words pass the last values on to the next stretch.
STRETCH = 512
#: Places after which the forward values are put into units of the last one. As every byte is a piece, of a probability that
#: smoothing keeps above some 1e-9, values within so many places and a piece's length differ by less than a double holds.
SCALED = 12
#: Added to the expected count of every piece.
SMOOTHING = 0.05
#: Words that a worker remembers the log-probabilities of.
CACHE = 400_000
_CELLS = 1 << 20
U = np.uint64
_OTHER = np.ones(256, bool)
_OTHER[97:123] = _OTHER[128:] = False


def pieces_of(model_path: str) -> list[bytes]:
    """The lower-case letter pieces of the vocabulary, with and without a blank before them, and all single bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    found = {bytes([b]) for b in (32, *range(97, 123), *range(128, 256))}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).replace("▁", " ")
        if not model.is_byte(i) and not model.is_control(i) and piece[1 if piece[0] == " " else 0 :].isalpha() and piece == piece.lower():
            found.add(piece.encode())
    return sorted(found)


class Pieces:
    """Finds the piece that a span of bytes is, by hash."""

    def __init__(self, pieces: list[bytes]):
        data = B.Texts(pa.array([b"".join(pieces).decode("latin1")]).cast(pa.string()))
        lengths = np.array([len(p) for p in pieces])
        data.data = np.frombuffer(b"\n" + b"".join(pieces) + b"\n", np.uint8)
        ends = 1 + np.cumsum(lengths)
        hashes = data.hashes(ends - lengths, ends)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.flags = np.zeros(1 << 20, bool)
        self.flags[(hashes >> U(44)).astype(np.int64)] = True
        self.count = len(pieces)
        self.sizes = np.unique(lengths)  # the lengths that pieces have

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of the piece, or `count` where there is none."""
        flat = hashes.ravel()
        out = np.full(len(flat), self.count, np.int64)
        maybe = np.flatnonzero(self.flags[(flat >> U(44)).view(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, flat[maybe]), self.count - 1)
        hit = self.hashes[at] == flat[maybe]
        out[maybe[hit]] = self.order[at[hit]]
        return out.reshape(hashes.shape)


@dataclass
class Words:
    """The words of a column's texts, with the blank before each."""

    texts: B.Texts
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Words:
        texts = B.Texts(pa.array([t and t.lower() for t in column.to_pylist()], pa.string()))
        starts, ends = texts.spans(_OTHER)
        owners = texts.owner(starts)
        texts.data = np.where(_OTHER[texts.data], np.uint8(32), texts.data)
        starts = starts - 1
        return cls(texts, starts, ends, texts.hashes(starts, ends), owners)

    def groups(self, words: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """Groups of words of one length, with that length: as many as a stretch of them fits into the cells."""
        lengths = (self.ends - self.starts)[words]
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order], prepend=0, append=0))
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            n = int(lengths[order[a]])
            rows = max(1, _CELLS // (min(n, STRETCH) * len(sizes)))
            for at in range(a, b, rows):
                yield order[at : min(b, at + rows)], n

    def pieces(self, words: np.ndarray, low: int, high: int, known: Pieces) -> np.ndarray:
        """found[w, j, s]: which piece the bytes of length sizes[s] before place low + j + 1 of each word are."""
        ends = self.starts[words, None] + 1 + np.arange(low, high)
        found = np.full((*ends.shape, len(known.sizes)), known.count, np.int64)
        for k, size in enumerate(known.sizes.tolist()):
            first = max(0, size - 1 - low)  # before that place, the word has fewer bytes
            if first < high - low:
                found[:, first:, k] = known.find(self.texts.hashes(ends[:, first:] - size, ends[:, first:]))
        return found


def forward(words: Words, group: np.ndarray, n: int, known: Pieces, table: np.ndarray) -> np.ndarray:
    """log[w, l] of words of length n: the logarithm of the sum over all segmentations; table[piece, l] has a row of zeros at its end."""
    width = int(known.sizes[-1])
    alpha = np.zeros((len(group), width + min(n, STRETCH), table.shape[1]))  # the last `width` values, then those of a stretch
    alpha[:, width - 1] = 1
    logs = np.zeros((len(group), table.shape[1]))
    for low in range(0, n, STRETCH):
        high = min(n, low + STRETCH)
        found = words.pieces(group, low, high, known)
        if low:
            alpha[:, :width] = alpha[:, STRETCH : STRETCH + width].copy()
            alpha[:, width:] = 0
        for j in range(low, high):
            at = width + j - low
            for k, size in enumerate(known.sizes.tolist()):
                if size > j + 1:
                    break
                piece = found[:, j - low, k]
                hit = np.flatnonzero(piece < len(table) - 1)
                if len(hit):
                    alpha[hit, at] += alpha[hit, at - size] * table[piece[hit]]
            if j % SCALED == SCALED - 1:
                unit = alpha[:, at].copy()
                alpha[:, at - width + 1 : at + 1] /= unit[:, None]
                logs += np.log(unit)
        last = width + high - 1 - low
    return logs + np.log(alpha[:, last])


def expected(words: Words, group: np.ndarray, n: int, known: Pieces, table: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected counts of the pieces in words of length n with weights, for one language's table[piece]."""
    width = int(known.sizes[-1])
    alpha = np.zeros((len(group), n + 1))
    alpha[:, 0] = 1
    units = np.zeros((len(group), n + 1))  # the logarithm of what each value is a multiple of
    total = np.zeros(len(group))
    kept = {}
    for low in range(0, n, STRETCH):
        high = min(n, low + STRETCH)
        found = words.pieces(group, low, high, known)
        if n <= STRETCH:
            kept[low] = found
        for j in range(low + 1, high + 1):
            for k, size in enumerate(known.sizes.tolist()):
                if size > j:
                    break
                piece = found[:, j - 1 - low, k]
                hit = np.flatnonzero(piece < len(table) - 1)
                if len(hit):
                    alpha[hit, j] += alpha[hit, j - size] * table[piece[hit]]
            units[:, j] = total
            if j % SCALED == 0:
                unit = alpha[:, j].copy()
                first = max(0, j - width + 1)
                alpha[:, first : j + 1] /= unit[:, None]
                units[:, first : j + 1] += np.log(unit)[:, None]
                total = total + np.log(unit)
    # share[w, j]: the weight of the segmentations that cut at place j.
    share = np.zeros((len(group), n + 1))
    share[:, n] = weight
    out = np.zeros(len(table))
    for low in reversed(range(0, n, STRETCH)):
        high = min(n, low + STRETCH)
        found = kept[low] if low in kept else words.pieces(group, low, high, known)
        for j in range(high, low, -1):
            for k, size in enumerate(known.sizes.tolist()):
                if size > j:
                    break
                piece = found[:, j - 1 - low, k]
                hit = np.flatnonzero(piece < len(table) - 1)
                if len(hit):
                    part = share[hit, j] * table[piece[hit]] * alpha[hit, j - size] / alpha[hit, j]
                    if n >= SCALED:
                        part *= np.exp(units[hit, j - size] - units[hit, j])
                    np.add.at(out, piece[hit], part)
                    share[hit, j - size] += part
    return out


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def training_words(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, word, n): word counts of the sample of each language."""
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("doc_id", "text").alias("key"))
    ids = labelled.select("lang", "key").withColumn("bucket", F.shiftrightunsigned("key", 52))
    # Counts by bucket tell up to which hash a language's sample reaches, so few rows are ranked however many there are.
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("bucket"))
    sizes = ids.groupBy("lang", "bucket").agg(F.approx_count_distinct("key", 0.02).alias("n"))
    reach = sizes.withColumn("before", upto - F.col("n")).where(F.col("before") < 1.2 * sample + 10)
    ids = ids.join(F.broadcast(reach.groupBy("lang").agg(F.max("bucket").alias("last"))), "lang").where("bucket <= last").select("lang", "bucket", "key").distinct()
    by = Window.partitionBy("lang").orderBy("bucket", "key")
    ids = ids.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= sample).select(F.col("key").alias("_key"), F.col("lang").alias("_lang"))
    chosen = labelled.join(F.broadcast(ids), (F.col("key") == F.col("_key")) & (F.col("lang") == F.col("_lang")), "left_semi").dropDuplicates(["lang", "key"])

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in B.chunks(batch, "text"):
                words = Words.of(part.column(1))
                langs = np.array(part.column(0).to_pylist(), object)
                names, lang = np.unique(langs.astype(str), return_inverse=True)
                _, first, n = np.unique(B.of_text(words.hashes, lang[words.owners]), return_index=True, return_counts=True)
                data = words.texts.data
                yield pa.RecordBatch.from_arrays([
                    pa.array(names[lang[words.owners[first]]].tolist(), pa.string()),
                    pa.array([data[a:b].tobytes() for a, b in zip(words.starts[first], words.ends[first], strict=True)], pa.binary()),
                    pa.array(n.astype(np.int64)),
                ], names=["lang", "word", "n"])

    found = chosen.select("lang", "text").mapInArrow(count, "lang string, word binary, n bigint")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, model_path: str, sample: int = SAMPLE, rounds: int = ROUNDS) -> tuple[list[bytes], list[str], np.ndarray]:
    """Pieces, languages in order, and table[piece, language] with a row of zeros at its end."""
    spark = docs.sparkSession
    pieces = pieces_of(model_path)
    words = settle(training_words(docs, sample))
    langs = sorted(r.lang for r in words.select("lang").distinct().collect())
    table = np.full((len(pieces) + 1, len(langs)), 1 / len(pieces))
    table[-1] = 0
    for _ in range(rounds if langs else 0):
        shared = spark.sparkContext.broadcast((pieces, langs, table))

        def count(it: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces, langs, table = shared.value
            known = Pieces(pieces)
            out = np.zeros(table.shape)
            for batch in it:
                lang = np.array([langs.index(x) for x in batch.column(0).to_pylist()], np.int64)
                weight = batch.column(2).to_numpy().astype(float)
                raw = batch.column(1).to_pylist()
                lengths = np.array([len(x) for x in raw], np.int64)
                texts = B.Texts(pa.array([""]))
                texts.data = np.frombuffer(b"\n" + b"".join(raw) + b"\n", np.uint8)
                ends = 1 + np.cumsum(lengths)
                held = Words(texts, ends - lengths, ends, np.zeros(0, U), np.zeros(0, np.int64))
                for k in np.unique(lang):
                    mine = np.flatnonzero(lang == k)
                    for group, n in held.groups(mine, known.sizes):
                        out[:, k] += expected(held, mine[group], n, known, table[:, k], weight[mine[group]])
            piece, k = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(out[piece, k])], names=["piece", "k", "n"])

        # Sums are rounded so that the order of additions doesn't show.
        got = words.repartition(8, "word").mapInArrow(count, "piece int, k int, n double").groupBy("piece", "k").agg(F.round(F.sum("n"), 6).alias("n")).toPandas()
        table = np.full(table.shape, SMOOTHING)
        table[got.piece, got.k] += got.n
        table[-1] = 0
        table /= table.sum(axis=0)
    return pieces, langs, table


class Scorer:
    """Log-probabilities of words in every language, with a cache by word."""

    def __init__(self, pieces: list[bytes], table: np.ndarray):
        self.pieces, self.table = Pieces(pieces), table
        self.hashes, self.logs = np.zeros(0, U), np.zeros((0, table.shape[1]))
        self.new: list[tuple[np.ndarray, np.ndarray]] = []

    def score(self, column: pa.Array) -> np.ndarray:
        """For each text the sums over its words."""
        words = Words.of(column)
        distinct, first, index = np.unique(words.hashes, return_index=True, return_inverse=True)
        logs = np.zeros((len(distinct), self.table.shape[1]))
        at = np.searchsorted(self.hashes, distinct)
        known = np.append(self.hashes, U(0))[at] == distinct
        known &= at < len(self.hashes)
        logs[known] = self.logs[at[known]]
        missing = np.flatnonzero(~known)
        for group, n in words.groups(first[missing], self.pieces.sizes):
            logs[missing[group]] = forward(words, first[missing[group]], n, self.pieces, self.table)
        self.new.append((distinct[missing], logs[missing]))
        if sum(len(h) for h, _ in self.new) > CACHE // 8:
            kept = [(self.hashes, self.logs), *self.new] if len(self.hashes) < CACHE else self.new
            hashes, logs_ = np.concatenate([h for h, _ in kept]), np.concatenate([x for _, x in kept])
            self.hashes, order = np.unique(hashes, return_index=True)
            self.logs, self.new = logs_[order], []
        out = np.zeros((len(words.texts), self.table.shape[1]))
        for k in range(out.shape[1]):
            out[:, k] = np.bincount(words.owners, logs[index, k], len(out))
        return out


def identify(docs: DataFrame, model_path: str, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of docs(doc_id, text, lang)."""
    pieces, langs, table = fit(docs, model_path, sample)
    shared = docs.sparkSession.sparkContext.broadcast((pieces, langs, table))

    def predict(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, langs, table = shared.value
        scorer = Scorer(pieces, table)
        for batch in it:
            for part in B.chunks(batch, "text"):
                column = part.column(2)
                lettered = np.array([t is not None and next(filter(str.isalpha, t), None) is not None for t in column.to_pylist()], bool)
                if langs:
                    logs = scorer.score(column)
                    best = logs.argmax(axis=1)
                    share = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                    names = [langs[b] if ok else "und" for b, ok in zip(best.tolist(), lettered, strict=True)]
                    scores = np.where(lettered, share, 0.0)
                else:
                    names, scores = ["und"] * part.num_rows, np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")
