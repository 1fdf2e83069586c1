"""Quality rules with thresholds that follow each language and source.

Counts are taken from whole texts in Arrow batches. Thresholds come from a mergeable quantile sketch: every metric value
falls into a bucket of fixed relative width, and the sketch of a group is its bucket counts, so sketches of tasks, sources
and languages merge by adding. Its size is bounded by the buckets, whatever the number of rows, and it gives the same
thresholds however the rows are dealt out. A document is rejected when the fixed base rules fail it, or when a metric lies
beyond the fence of its own (language, source). Fences come from the sketch's quartiles and tail: where most texts have none
of something, the quartiles meet, and what the few with most of it have tells from where on it is too much.

Defined results: a null or empty text has no words, so it is rejected by the base rules; null languages and sources form
groups of their own; repeated rows count each time; an empty table gives an empty result; other columns pass through
`verdicts` untouched, and a column of the same name as an added one is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradebars.llm import _bytes as B
from tradebars.llm._tables import settle, shield

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CHARACTER = ~B.SPACE & ((np.arange(256) & 0xC0) != 0x80)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Lines with a word.
LINES = "_n_lines"
WINDOW = 8

#: Width of a sketch bucket: values of one bucket differ by 2 %; below the least value all fall into bucket 0.
GAMMA, LEAST = 1.02, 1e-3
#: Fence: the group's upper (or lower) quartile and `REACH` times the distance of its quartiles, or, where the tail reaches
#: further, a share of the distance from its median to `TAIL` of it.
REACH, TAIL = 6.0, 0.98
#: metric: (least distance of quartiles, share of the tail, whether a low value also counts against a document)
#: The least distances hold where a group's texts are all alike, as one odd sign in a text is no outlier even there.
METRICS = {"symbol_share": (0.005, 0.2, False), "word_length": (0.2, 0.5, True), "dup_line_share": (0.02, 3.0, False)}
#: Groups with fewer documents take the sketch of their language, and that one too that of all documents.
ENOUGH = 200
QUANTILES = (0.25, 0.5, 0.75, TAIL)
NAMES = [f"q{round(100 * q)}" for q in QUANTILES]
#: (language, source) groups up to which the thresholds are broadcast; beyond, they are joined by key.
BROADCAST_GROUPS = 100_000


def count_texts(column: pa.Array) -> dict[str, np.ndarray]:
    """The five counts of each text, and its lines with a word."""
    texts = B.Texts(column)
    n = len(texts)
    starts, ends = texts.spans(B.SPACE)
    owner = texts.owner(starts)
    out = {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": texts.count(CHARACTER),
        "n_symbols": texts.count(SYMBOLS),
    }
    first, last = texts.lines()
    word_before = np.searchsorted(starts, first)
    full = (word_before < len(starts)) & (np.append(starts, len(texts.data))[word_before] < last)
    first, last = first[full], last[full]
    line_owner = texts.owner(first)
    key = B.of_text(texts.hashes(first, last), line_owner)
    _, keep = np.unique(key, return_index=True)
    repeated = np.ones(len(key), bool)
    repeated[keep] = False
    out["n_dup_lines"] = np.bincount(line_owner[repeated], minlength=n)
    out[LINES] = np.bincount(line_owner, minlength=n)

    window, at = B.windows(texts.hashes(starts, ends), owner, WINDOW)
    key = B.of_text(window, owner[at])
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    out["n_repeat_words"] = np.bincount(owner[covered], minlength=n)
    return out


def counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The documents' columns in `keep` (all by default), the five counts of the text and its lines with a word."""
    added = (*COUNTS, LINES)
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    docs = docs.select(*dict.fromkeys([*names, text]))
    where = docs.columns.index(text)

    @B.lean
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in B.chunks(batch, text):
                found = count_texts(part.column(where))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in names] + [pa.array(found[c].astype(np.int64)) for c in added],
                    names=[*names, *added],
                )

    fields = [docs.schema[c] for c in names]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{c} bigint" for c in added])
    return docs.mapInArrow(batches, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _metric(name: str) -> Column:
    return {
        "symbol_share": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "word_length": F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col(LINES), F.lit(1)),
    }[name]


def bucket(value: Column) -> Column:
    return F.when(value < LEAST, 0).otherwise(1 + F.floor(F.log(value / LEAST) / math.log(GAMMA))).cast("int")


def middle(bucket_no: Column) -> Column:
    return F.when(bucket_no <= 0, F.lit(0.0)).otherwise(LEAST * F.pow(F.lit(GAMMA), bucket_no - 0.5))


def sketches(counted: DataFrame) -> DataFrame:
    """Bucket counts (lang, source, metric, bucket, n) of the documents that the base rules pass."""
    metric = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket(_metric(m)).alias("bucket")) for m in METRICS]))
    passed = counted.where(~base_failed()).select("lang", "source", metric.alias("m")).select("lang", "source", "m.*")
    return passed.groupBy("lang", "source", "metric", "bucket").agg(F.count("*").alias("n"))


def _quantiles(merged: DataFrame, keys: list[str]) -> DataFrame:
    by = Window.partitionBy(*keys, "metric")
    ranked = merged.withColumns({"total": F.sum("n").over(by), "upto": F.sum("n").over(by.orderBy("bucket"))})
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bucket")))
    return ranked.groupBy(*keys, "metric").agg(F.max("total").alias("total"), *[middle(at(q)).alias(f"q{round(100 * q)}") for q in QUANTILES])


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, metric, low, high, by): the fences, and whether `quartiles`, `tail` or the `least` distance decides the high one.

    A group with few documents merges into its language, and a language with few into all documents.
    """
    levels = [["lang", "source"], ["lang"], []]
    tables = [_quantiles(sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n")), keys) for keys in levels]
    own = tables[0].alias("a")
    lang = tables[1].alias("b")
    every = tables[2].alias("c")
    joined = own.join(lang, F.col("a.lang").eqNullSafe(F.col("b.lang")) & (F.col("a.metric") == F.col("b.metric"))).join(F.broadcast(every), F.col("a.metric") == F.col("c.metric"))
    pick = lambda q: F.when(F.col("a.total") >= ENOUGH, F.col(f"a.{q}")).when(F.col("b.total") >= ENOUGH, F.col(f"b.{q}")).otherwise(F.col(f"c.{q}"))
    of = lambda k: F.create_map(*[F.lit(x) for m, v in METRICS.items() for x in (m, v[k])])[F.col("metric")]
    found = joined.select("a.lang", "a.source", F.col("a.metric").alias("metric"), *[pick(q).alias(q) for q in NAMES])
    found = found.withColumns({"own": F.col("q75") - F.col("q25"), "tail": of(1) * (F.col("q98") - F.col("q50")), "floor": REACH * of(0)})
    spread = REACH * F.greatest(F.col("own"), of(0))
    by = F.when(F.col("tail") > spread, "tail").when(REACH * F.col("own") >= F.col("floor"), "quartiles").otherwise("least")
    return found.select("lang", "source", "metric", (F.col("q25") - spread).alias("low"), (F.col("q75") + F.greatest(spread, "tail")).alias("high"), by.alias("by"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row for each (lang, source): the low and high fence of every metric."""
    one = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{m}_{c}")
    return fences(sketch).groupBy("lang", "source").agg(*[one(m, c) for m, (*_, both) in METRICS.items() for c in (("low", "high") if both else ("high",))])


def verdicts(docs: DataFrame, sketch: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """The documents with their counts, `base_failed` and `kept`.

    `sketch` may hold sketches of the metrics merged from earlier runs; by default they are made from these documents. The counts are
    taken twice, once for the sketches and once beside the text: that costs less than to write and join the texts.
    """
    if sketch is None:
        sketch = sketches(counts(docs, keep=["lang", "source"]))
    fence = thresholds(settle(sketch))
    names = docs.columns if keep is None else keep
    counted = counts(docs, keep=list(dict.fromkeys([*names, "lang", "source"])))
    renamed = settle(fence.withColumnsRenamed({"lang": "_lang", "source": "_source"}))
    small = renamed.count() <= BROADCAST_GROUPS
    joined = counted.join(F.broadcast(renamed) if small else renamed, counted["lang"].eqNullSafe(F.col("_lang")) & counted["source"].eqNullSafe(F.col("_source")), "left")
    odd = F.lit(False)
    for m, (*_, both) in METRICS.items():
        odd = odd | F.coalesce(_metric(m) > F.col(f"{m}_high"), F.lit(False))
        if both:
            odd = odd | F.coalesce(_metric(m) < F.col(f"{m}_low"), F.lit(False))
    judged = joined.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & ~odd})
    return judged.select(*[c for c in dict.fromkeys(names) if c not in (*COUNTS, LINES, "base_failed", "kept")], *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    inner, restore = shield(docs, [*COUNTS, LINES, "base_failed", "kept", "_lang", "_source"])
    return restore(verdicts(inner).where("kept"))
