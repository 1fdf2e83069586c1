"""The pipeline against a brute-force version of each stage's decisions."""

import ctypes
import hashlib
import math
import random
import time
from collections import defaultdict
from pathlib import Path

import corpus_pipeline
import public_tokenizers as P
import pyarrow as pa
import test_decontaminate
import test_jaccard
import test_quality_rules
import test_secrets

from pyspark.sql import functions as F

from tradebars.llm import bpe, decontaminate, jaccard, quality
from tradebars.llm._tables import settle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    r = random.Random(11)
    vocabulary = [f"word{i}" for i in range(900)]
    make = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    data = [(i, make(r.randint(30, 90)), r.choice(["en", "fr"]), r.choice(["a", "b"]), 1) for i in range(240)]
    data += [(300 + i, data[i][1] + " more", "en", "a", 1) for i in range(20)]
    data += [(340 + i, data[i][1], None, "a", 1) for i in range(5)]
    data += [(400 + i, make(40) + " " + item + " " + make(10), "en", "b", 1) for i, (_, item) in enumerate(test_decontaminate.ITEMS) if item and len(item) > 30]
    data += [(500 + i, make(40) + "\n" + t + "\n" + make(5), "fr", None, 1) for i, t in enumerate(test_secrets.TEXTS[:6])]
    data += [(600 + i, make(30) + test_quality_rules.SYMBOLS, "en", "a", 1) for i in range(4)]
    data += [(700, None, "en", "a", 1), (701, "", "en", "a", 1), (702, "a b c d e f g h " * 9, "en", "a", 1)]
    return data


def brute_quality(data):
    counted = [(r, dict(zip(quality.COUNTS, test_quality_rules.brute(r[1]), strict=True)) | {"lines": sum(1 for line in (r[1] or "").split("\n") if line.strip(" \t\n\r\x0b\x0c"))}) for r in data]
    failed = lambda c: c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]
    value = lambda m, c: {"symbol_share": c["n_symbols"] / max(1, c["word_chars"]), "word_length": c["word_chars"] / max(1, c["n_words"]), "dup_line_share": c["n_dup_lines"] / max(1, c["lines"])}[m]
    seen = defaultdict(list)
    for r, c in counted:
        if not failed(c):
            for m in quality.METRICS:
                v = value(m, c)
                b = 0 if v < quality.LEAST else 1 + math.floor(math.log(v / quality.LEAST) / math.log(quality.GAMMA))
                for group in ((r[2], r[3]), (r[2],), ()):
                    seen[group, m].append(b)
    out = []
    for r, c in counted:
        good = not failed(c)
        for m, (least, share, both) in quality.METRICS.items() if good else ():
            group = next((g for g in ((r[2], r[3]), (r[2],)) if len(seen[g, m]) >= quality.ENOUGH), ())
            held = sorted(seen[group, m])
            at = lambda q: held[math.ceil(q * len(held)) - 1]  # noqa: E731, B023
            low, mid, high, tail = (0.0 if (b := at(q)) <= 0 else quality.LEAST * quality.GAMMA ** (b - 0.5) for q in (0.25, 0.5, 0.75, quality.TAIL))
            reach = quality.REACH * max(high - low, least)
            good = good and value(m, c) <= high + max(reach, share * (tail - mid)) and not (both and value(m, c) < low - reach)
        if good:
            out.append(r)
    return out


def test_stages_equal_brute_force(spark, tmp_path):
    data = corpus()
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(test_decontaminate.ITEMS, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    kept = brute_quality(data)
    got = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == sorted(r[0] for r in kept)
    assert len(kept) < len(data) - 6

    firsts = {c for _, _, c in test_jaccard.brute(kept)}
    kept = [r for r in kept if r[0] in firsts]
    got = corpus_pipeline.near_duplicates(spark, got, str(tmp_path))
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == sorted(r[0] for r in kept)

    kept = [r for r in kept if not 400 <= r[0] < 500]
    got = corpus_pipeline.decontamination(spark, got, str(tmp_path))
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == sorted(r[0] for r in kept)

    masked = {}
    for r in kept:
        spans, text, at = sorted((s, e) for s, _, e in test_secrets.base(r[1]) + test_secrets.weak(r[1])), "", 0
        for s, e in spans:
            if s >= at:
                text += r[1][at:s] + "[SECRET]"
            at = max(at, e)
        masked[r[0]] = text + r[1][at:]
    got = corpus_pipeline.secret_scan(spark, got, str(tmp_path))
    rows = got.collect()
    assert got.columns == docs.columns and {r.doc_id: r.text for r in rows} == masked and all(r.n_chars == len(r.text) for r in rows)
    assert sum("[SECRET]" in t for t in masked.values()) == 6

    coder = bpe.Encoder(bpe.read(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN))
    want = {k: (coder.encode([t])[0].tolist(), hashlib.sha256(t.encode()).hexdigest()) for k, t in masked.items()}
    for out in (corpus_pipeline.token_ids(spark, got, str(tmp_path)), corpus_pipeline.run(spark, str(tmp_path))):
        assert {r.doc_id: (r.ids, r.decoded_sha256) for r in out.collect()} == want
        assert all(r.n_tokens == len(r.ids) for r in out.collect())


def test_odd_documents(spark, tmp_path):
    """Null ids, repeated rows, texts that share an id, a very long text and columns with the stages' own names."""
    r = random.Random(12)
    make = lambda n: " ".join(f"word{r.randrange(5000)}" for _ in range(n))
    data = [(i, make(60), "en", "a", 1) for i in range(60)]
    alone, long, shared = make(50), make(150_000), [make(50), make(50)]
    odd = [(None, alone, "en", "a", 1), (None, data[3][1], "en", "a", 1), (900, long, "en", "a", 1), (901, shared[0], "en", "a", 1), (901, shared[1], "en", "a", 1)]
    docs = spark.createDataFrame(data + odd + data[:4] + odd[:3], SCHEMA)
    clash = ["_key", "_keep", "_n_lines", "kept", "spans", "blocks", "text_hash", "_d", "_h", "_t", "ids"]
    for c in clash:
        docs = docs.withColumn(c, F.lit("mine"))
    spark.createDataFrame(test_decontaminate.ITEMS, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = sorted([(d[0], d[1]) for d in data] + [(None, alone), (900, long), (901, shared[0]), (901, shared[1])], key=str)
    for _, stage in corpus_pipeline.STAGES[:4]:
        columns = docs.columns
        docs = settle(stage(spark, docs, str(tmp_path)))
        assert docs.columns == columns and docs.where("_key != 'mine' or spans != 'mine' or text_hash != 'mine'").isEmpty()
        if stage is not corpus_pipeline.quality_rules:
            assert sorted(((x.doc_id, x.text) for x in docs.collect()), key=str) == want
    out = corpus_pipeline.token_ids(spark, docs, str(tmp_path)).collect()
    assert sorted(str(x.doc_id) for x in out) == sorted(str(d) for d, _ in want) and all(x.n_tokens > 0 for x in out)


def test_leaks_by_shared_windows_alone_go(spark, tmp_path):
    """Of items that share a preamble or differ in a number, what all of them share makes a leak, as brute force over all windows says."""
    r = random.Random(13)
    make = lambda n: " ".join(f"w{''.join(r.choice('abcdefgh') for _ in range(5))}" for _ in range(n))
    preamble = make(17)
    items = [(i, f"{preamble} {make(12)}") for i in range(12)] + [(20 + i, f"how far does the slow red train go in {10 + i} hours") for i in range(12)]
    texts = [make(40), f"{make(9)} {preamble} {make(9)}", f"{make(9)} {items[3][1]}", f"{make(9)} how far does the slow red train go in 99 hours", f"{make(9)} how far does the slow red train go", f"{make(9)} how far does the slow red train go in many", make(20)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)] + [(None, texts[1], None, None, 1), (3, texts[0], "en", "a", 1)], SCHEMA)
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    gone = {t for t, *_ in test_decontaminate.brute_leaks([(t, t) for t in texts], items)}
    assert gone == {texts[i] for i in (1, 2, 3)}
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(((x.doc_id, x.text) for x in kept.collect()), key=str) == sorted([(i, t) for i, t in enumerate(texts) if t not in gone] + [(3, texts[0])], key=str)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [len(x) for x in corpus_pipeline.STAGES] == [2] * 5


def test_workers_give_back_their_memory(spark):
    """Python workers outlive a stage beside their executor's heap: after its tasks they hold no more than they need."""
    words = F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: F.hex(F.xxhash64("doc_id", i).bitwiseAND(0xFFFFFFFF)))
    docs = settle(spark.range(0, 8000, 1, 4).select(F.col("id").alias("doc_id"), F.concat_ws(" ", words).alias("text")))

    def free(it):
        """MB that the C library holds free."""
        for batch in it:
            held = lambda: int(Path("/proc/self/smaps_rollup").read_text().split("\nAnonymous:")[1].split()[0]) / 1024
            before = held()
            pa.default_memory_pool().release_unused()
            ctypes.CDLL(None).malloc_trim(0)
            time.sleep(1)  # so that each task has a worker of its own
            yield pa.RecordBatch.from_arrays([pa.array([before - held()])], names=["mb"])

    held = {}
    for name, stage in {
        "quality": lambda: quality.counts(docs),
        "shingles": lambda: jaccard._screen(docs, 16),
        "cut": lambda: jaccard._cut(docs, 16),
        "windows": lambda: decontaminate._windows(docs.limit(800), "text", ["doc_id"], [decontaminate.WINDOW]),
        "bpe": lambda: bpe.encode(docs.limit(400), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN),
    }.items():
        spark.sparkContext.environment["STAGE"] = name  # workers of its own
        try:
            stage().write.format("noop").mode("overwrite").save()
            held[name] = max(r.mb for r in spark.range(0, 4, 1, 4).mapInArrow(free, "mb double").collect())
        finally:
            del spark.sparkContext.environment["STAGE"]
    assert max(held.values()) < 24, held
