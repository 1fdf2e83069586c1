import base64
import random
import time

import pytest
import public_tokenizers as P
import sentencepiece
import tiktoken
from fixtures import SCHEMA, documents, rows
from pyspark.sql import functions as F

from tradebars.llm import bpe, tokens

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_equal_the_library(spark, encoding):
    out = bpe.encode(documents(spark), RANKS, P.PATTERN, decoded=True).collect()
    assert len(out) == len(rows())
    for r in out:
        assert r.ids == encoding.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_decode_alone_undoes_encode(spark):
    coded = bpe.encode(documents(spark), RANKS, P.PATTERN)
    for r in bpe.decode(coded, RANKS).collect():
        assert bytes(r.decoded).decode() == (r.text or "")


def test_every_length_and_long_runs(encoding):
    r = random.Random(3)
    words = ["".join(r.choice("aeinrst") for _ in range(n)) for n in [*range(1, 140), 500, 3000]]
    words += ["ab" * 400, "a" * 777, "é" * 301, "=" * 400, " " * 333 + "x"]
    coder = bpe.Encoder(bpe.read(RANKS, P.PATTERN))
    for _ in range(2):  # the second time from the cache
        flat, counts = coder.encode(words)
        at = 0
        for w, n in zip(words, counts, strict=True):
            assert flat[at : at + n].tolist() == encoding.encode_ordinary(w)
            at += n


def test_long_cuts_take_the_heap_and_no_quadratic_time(encoding, monkeypatch):
    """A million signs in seconds; the same ids as the library's where that is fast enough to ask."""
    r = random.Random(8)
    vocabulary, heaped = bpe.read(RANKS, P.PATTERN), []
    inner = bpe.Vocabulary._heaped
    monkeypatch.setattr(bpe.Vocabulary, "_heaped", lambda self, ids: heaped.append(len(ids)) or inner(self, ids))
    letters = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    words = ["a" * 100_000, letters(100_000), "ab" * 257, letters(257), "é漢" * 3000, letters(256)]
    for w, got in zip(words, vocabulary.merge([w.encode() for w in words]), strict=True):
        assert got.tolist() == encoding.encode_ordinary(w)
    assert len(heaped) == 5
    began = time.perf_counter()
    for w in ("a" * 1_000_000, letters(1_000_000)):
        flat, counts = bpe.Encoder(vocabulary).encode([w])
        assert b"".join(vocabulary.decode(flat, counts)) == w.encode()
    assert time.perf_counter() - began < 60


def test_every_character_splits_as_in_the_library(encoding):
    coder = bpe.Encoder(bpe.read(RANKS, P.PATTERN))
    texts = ["".join(f"a{chr(c)}{chr(c)} b" for c in range(a, a + 256) if not 0xD800 <= c < 0xE000) for a in range(0, 0x30000, 256)]
    odd = 0
    for t in texts:
        flat, _ = coder.encode([t])
        odd += flat.tolist() != encoding.encode_ordinary(t)
    assert odd == 0


def test_clashing_columns_and_empty_table(spark):
    docs = documents(spark).withColumn("ids", F.lit("mine"))
    assert bpe.encode(docs, RANKS, P.PATTERN).schema["ids"].dataType.simpleString() == "array<int>"
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.encode(empty, RANKS, P.PATTERN).count() == 0
    assert tokens.count_tokens(empty, MODEL).count() == 0


def test_token_counts_equal_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = documents(spark, [*rows(), (200, "a\r\n <s> </s> <0x0A> ▁▁x ▁", "en", "a", 1), (201, " ", "en", "a", 1), (202, "\n\n \n", "en", "a", 1)])
    out = tokens.count_tokens(docs.withColumn("n_tokens", F.lit("clash")), MODEL, limit=300).collect()
    assert len(out) == len(rows()) + 3
    for r in out:
        assert r.n_tokens == len(model.encode(r.text or ""))
        assert r.n_bytes == len((r.text or "").encode())
        assert r.over_limit == (r.n_tokens > 300)


def test_frequent_table_only_saves_work():
    model, apart = tokens.load(MODEL)
    table = tokens.frequent(model)
    assert apart and 10_000 < len(table) < model.get_piece_size() and " the" in table
    bare, full = tokens.Lengths(model, {}), tokens.Lengths(model, {w: tokens._length(model, w) for w in table})
    assert all(bare[w] == full[w] == len(model.encode("x" + w)) - 1 for w in table[:: 7] if w[0] == " ")


def test_token_counts_need_one_pass_and_no_exchange(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/docs")
    plan = tokens.count_tokens(spark.read.parquet(f"{tmp_path}/docs"), MODEL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1
