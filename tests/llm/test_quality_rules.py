import re
from collections import Counter
from pathlib import Path

import pytest
from fixtures import SCHEMA, documents, rows
from pyspark.sql import functions as F

from tradebars.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if twice[g] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)


def test_counts_equal_brute_force(spark):
    extra = [(300, "a b c d e f g h " * 5 + "\n\n x # $ <|> \n x # $ <|> \n", "en", "a", 1), (301, "one\x0btwo\x0cthree\r\n" * 4, "en", "a", 1)]
    out = quality.counts(documents(spark, rows() + extra)).collect()
    assert len(out) == len(rows()) + 2
    for r in out:
        assert tuple(r[c] for c in quality.COUNTS) == brute(r.text)


SYMBOLS = " " + " ".join(f"{i}#$%|" for i in range(60))


def make(n, tail="", lang="en", source="a", start=0):
    return [(start + i, " ".join(f"word{(i * 7 + k * k) % 997}x" for k in range(40)) + tail, lang, source, 1) for i in range(n)]


def test_junk_goes_and_clean_documents_stay(spark):
    junk = make(10, SYMBOLS, start=1000)
    prices = make(10, " costs $5 & more", start=2000)
    out = {r.doc_id: r for r in quality.verdicts(documents(spark, make(300) + junk + prices + make(5, source=None, lang=None, start=3000))).collect()}
    assert all(not out[r[0]].kept for r in junk)
    assert all(r.kept for k, r in out.items() if not 1000 <= k < 2000)


def test_thresholds_follow_the_group(spark):
    """Where a source uses many symbols as a rule, they don't count against its documents."""
    code = make(200, SYMBOLS, source="code", start=5000)
    out = {r.doc_id: r.kept for r in quality.verdicts(documents(spark, make(300) + code)).collect()}
    assert all(out.values())


def test_alternating_repeated_lines_go(spark):
    """Every other line repeats an earlier one: some 0.08 for each word, and nearly half of the lines."""
    text = lambda k: "".join(f"share this page\nfresh{k}x{i} word{i}x line{k}\n" for i in range(12))
    junk = [(1000 + k, text(k), "en", "a", 1) for k in range(5)]
    few = [(2000 + k, f"title of page{k}\n" + make(1)[0][1].replace(" ", "\n", 8) + f"\ntitle of page{k}", "en", "a", 1) for k in range(5)]
    docs = documents(spark, make(300) + junk + few)
    judged = {r.doc_id: r for r in quality.verdicts(docs).collect()}
    assert not any(r.base_failed for r in judged.values()) and not any(judged[r[0]].kept for r in junk)
    kept = {r.doc_id for r in quality.keep_good(docs.withColumn(quality.LINES, F.lit(7))).where(f"{quality.LINES} = 7").collect()}
    assert kept == {*range(300), *range(2000, 2005)}


def test_sketches_merge(spark):
    docs = quality.counts(documents(spark, make(100) + make(100, " $ $ $", source="b", start=500)))
    whole = quality.sketches(docs)
    parts = quality.sketches(docs.where("doc_id % 2 = 0")).union(quality.sketches(docs.where("doc_id % 2 = 1")))
    a = quality.thresholds(whole).orderBy("source").collect()
    assert a == quality.thresholds(parts).orderBy("source").collect()


def test_empty_nulls_and_clashes(spark):
    assert quality.verdicts(spark.createDataFrame([], SCHEMA)).count() == 0
    out = {r.doc_id: r for r in quality.verdicts(documents(spark)).collect()}
    assert out[100].base_failed and out[101].base_failed and not out[100].kept
    docs = documents(spark).withColumn("kept", F.lit("mine")).withColumn("_lang", F.lit(1))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.kept for r in kept.collect()} == {"mine"}


DATA = "/root/testdata/sf0.1"


@pytest.mark.skipif(not Path(DATA).exists(), reason="the test tables are not here")
def test_the_groups_own_values_decide_and_good_documents_stay(spark):
    """In a tenth of the groups and metrics at most a constant decides; labelled good documents that the base rules pass stay."""
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    by = quality.fences(quality.sketches(quality.counts(docs, keep=["lang", "source"]))).groupBy("metric").agg(F.avg((F.col("by") == "least").cast("int")).alias("constant"), F.count_distinct("high").alias("different"))
    found = {r.metric: r for r in by.collect()}
    assert set(found) == set(quality.METRICS) and all(r.constant < 0.1 and r.different >= 4 for r in found.values())
    judged = quality.verdicts(docs, keep=["doc_id"]).where("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in judged.collect()}
    assert kept[1] > 0.995 and kept[0] < 0.15


def test_many_groups_are_joined_by_key(spark, monkeypatch):
    docs = documents(spark, make(250) + make(10, SYMBOLS, start=1000) + make(5, source=None, lang=None, start=3000))
    want = sorted(quality.verdicts(docs, keep=["doc_id"]).collect())
    monkeypatch.setattr(quality, "BROADCAST_GROUPS", 0)
    assert sorted(quality.verdicts(docs, keep=["doc_id"]).collect()) == want
