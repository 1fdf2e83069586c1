import itertools
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import public_tokenizers as P
from fixtures import SCHEMA, documents
from pyspark.sql import functions as F

from tradebars.llm import _bytes as B
from tradebars.llm import langid

MODEL = P.path("piece_bpe_32k.model")
SYLLABLES = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["sch", "ung", "ein", "ver"], "zz": ["eau", "oux", "ment", "é"]}


def text(lang, r, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n)).capitalize()


def labelled(n=240):
    r = random.Random(1)
    return [(i, text(lang, r, r.randint(5, 60)), lang, "s", 1) for i, lang in zip(range(n), itertools.cycle(SYLLABLES))]


def test_held_out_accuracy_and_rule(spark):
    data = labelled() + [(1000, None, "xx", "s", 1), (1001, "123 !?", "xx", "s", 1), (1002, "", None, "s", 1), (None, "Scheinung", "yy", "s", 1)]
    out = langid.identify(documents(spark, data).withColumn("score", F.lit(1)), MODEL).collect()
    assert len(out) == len(data)
    langs = {d[0]: d[2] for d in data}
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2 if r.doc_id is not None else False)
        assert 0 <= r.score <= 1
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred == langs[r.doc_id]


def test_held_out_labels_play_no_part(spark):
    data = labelled(60)
    hidden = [(i, t, "other" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s, n) for i, t, lang, s, n in data]
    a = sorted(langid.identify(documents(spark, data), MODEL).collect())
    assert a == sorted(langid.identify(documents(spark, hidden), MODEL).collect())


def test_nothing_to_learn_from(spark):
    out = langid.identify(documents(spark, [(1, "abc", None, "s", 1)]), MODEL).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0)]
    assert langid.identify(spark.createDataFrame([], SCHEMA), MODEL).count() == 0


def all_segmentations(word, probability):
    """The sum over segmentations, one by one."""
    total = 0.0
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[at:i])
                at = i
        parts.append(word[at:])
        p = 1.0
        for x in parts:
            p *= probability.get(x, 0.0)
        total += p
    return total


def test_forward_sums_all_segmentations():
    pieces = langid.pieces_of(MODEL)
    r = np.random.RandomState(2)
    table = np.vstack([r.rand(len(pieces), 2), np.zeros((1, 2))])
    scorer = langid.Scorer(pieces, table)
    words = ["the", "Ünder", "a", "segments"]
    got = scorer.score(pa.array([*words, "the a"]))
    for k in range(2):
        probability = dict(zip(pieces, table[:, k], strict=False))
        single = [np.log(all_segmentations((" " + w.lower()).encode(), probability)) for w in words]
        assert np.allclose(got[:4, k], single) and np.isclose(got[4, k], single[0] + single[2])
    assert np.allclose(scorer.score(pa.array(words)), got[:4])


def by_recursion(word, probability):
    """The logarithm of the sum over segmentations, by exact arithmetic."""
    sums = [Fraction(1)]
    for j in range(1, len(word) + 1):
        sums.append(sum((sums[i] * probability[word[i:j]] for i in range(j) if word[i:j] in probability), Fraction(0)))
    return log_of(sums[-1])


def log_of(x):
    shift = x.denominator.bit_length() - x.numerator.bit_length()
    return float(np.log(float(x * 2**shift))) - shift * float(np.log(2.0))


def test_long_words_and_long_pieces_are_summed_whole(monkeypatch):
    """Words far over any piece, CJK sentences and stretches that end within a word give the sum over all segmentations."""
    pieces = langid.pieces_of(MODEL)
    assert max(map(len, pieces)) > 16 and " different".encode() in pieces
    table = np.vstack([np.random.RandomState(3).rand(len(pieces), 2) * 1e-5, np.zeros((1, 2))])
    words = ["donaudampfschifffahrtsgesellschaftskapitänsmütze" * 2, "これはとても長い日本語の文ですから区切りがありません" * 3, "x" * 300, "differentfunction"]
    exact = [[by_recursion((" " + w).encode(), dict(zip(pieces, map(Fraction, table[:, k]), strict=False))) for k in range(2)] for w in words]
    assert np.allclose(langid.Scorer(pieces, table).score(pa.array(words)), exact)
    monkeypatch.setattr(langid, "STRETCH", 37)
    assert np.allclose(langid.Scorer(pieces, table).score(pa.array(words)), exact)


def test_expected_counts(monkeypatch):
    """The counts of pieces, times their lengths, are the bytes of the words; the same whatever the stretches."""
    pieces = langid.pieces_of(MODEL)
    table = np.append(np.random.RandomState(4).rand(len(pieces)) * 1e-6, 0)
    words = langid.Words.of(pa.array(["the quick é brown different", "x" * 400 + " " + "the" * 200]))
    assert isinstance(words.texts, B.Texts)
    found = []
    for stretch in (512, 50):
        monkeypatch.setattr(langid, "STRETCH", stretch)
        total = np.zeros(len(table))
        known = langid.Pieces(pieces)
        for group, n in words.groups(np.arange(len(words.starts)), known.sizes):
            total += langid.expected(words, group, n, known, table, np.ones(len(group)))
        assert np.isclose(sum(total[i] * len(p) for i, p in enumerate(pieces)), (words.ends - words.starts).sum())
        found.append(total)
    assert np.allclose(*found)


def test_ties_long_texts_and_repeated_rows(spark):
    """Two languages learned from the same texts tie: the one that sorts first wins. Long texts and words are no trouble."""
    r = random.Random(6)
    train = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    data = [(i, t, lang, "s", 1) for i in train[:40] for t in [text("xx", r, 30)] for lang in ("bb", "aa")]
    data += [(5000, text("xx", r, 60_000), None, "s", 1), (5001, "k" * 50_000, None, "s", 1)] + data[:6]
    out = langid.identify(documents(spark, data), MODEL).collect()
    assert len(out) == len(data) and {r.lang_pred for r in out} == {"aa"}
    assert all(abs(r.score - 0.5) < 1e-6 for r in out)


def test_sample_counts_repeated_rows_once_and_is_bounded(spark):
    data = [(i % 3 * 4 if i % 2 else None, f"word{chr(97 + i % 5)} again", "xx", "s", 1) for i in range(300)]
    words = langid.training_words(documents(spark, data), sample=4).collect()
    assert sum(w.n for w in words if bytes(w.word) == b" again") <= 4
