import random
import re
from collections import defaultdict

from fixtures import SCHEMA, documents, rows
from pyspark.sql import functions as F

from tradebars.llm import jaccard
from tradebars.llm._graph import components


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(data):
    sets = [shingle_set(r[1]) for r in data]
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i in range(len(data)):
        groups[find(i)].append(data[i][0])
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(((data[i][0], len(sets[i]), least[find(i)]) for i in range(len(data))), key=str)


def corpus(seed):
    """Originals, chains of ever more edited copies, a passage in many texts, short texts and copies."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [r.choice(vocabulary) for _ in range(30)]
    data = []
    for _ in range(12):
        text = [r.choice(vocabulary) for _ in range(r.randint(20, 160))]
        if r.random() < 0.6:
            text[5:5] = passage
        for _ in range(r.randint(1, 9)):
            data.append(list(text))
            for _ in range(r.randint(0, 3)):
                text[r.randrange(len(text))] = r.choice(vocabulary)
    base = [r.choice(vocabulary) for _ in range(100)]
    for _ in range(30):  # a hub with copies that are near it but not each other
        copy = list(base)
        copy[r.randrange(100)] = f"x{r.random()}"
        data.append(copy)
    data.append(base)
    data += [["a", "b"], ["A", "b"], ["a", "b", "c"], passage, passage[:-1]]
    out = [(i, " ".join(t), "en", "a", 1) for i, t in enumerate(data)]
    out += [(900, None, "en", "a", 1), (901, "", "en", "a", 1), (902, " \t\n", "en", "a", 1), (None, out[0][1], "en", "a", 1), (None, "only null here at all", "en", "a", 1)]
    out += [(950 + i, out[3][1].upper(), "en", "a", 1) for i in range(5)] + [out[4], out[4]]
    r.shuffle(out)
    return out


def got(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_groups(docs).collect()), key=str)


def test_components_equal_brute_force(spark):
    for seed in (1, 2):
        data = corpus(seed)
        assert got(documents(spark, data)) == brute(data)


def test_many_rounds_and_joined_lists(spark, monkeypatch):
    """One leader more, small tiles, groups by size throughout, hot fragments dealt out, and no broadcasts."""
    monkeypatch.setattr(jaccard, "MANY", 1)
    monkeypatch.setattr(jaccard, "HELD", 500)
    monkeypatch.setattr(jaccard, "FRAGMENT_BYTES", 4000)
    monkeypatch.setattr(jaccard, "BROADCAST_LEADERS", 0)
    monkeypatch.setattr(jaccard, "SALTED", 3)
    monkeypatch.setattr(jaccard, "LEADERS", 1)
    monkeypatch.setattr(jaccard, "TILE", 4)
    monkeypatch.setattr(jaccard, "STRIP", 3)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard, "SALT", 2)
    data = corpus(3)[:70]
    assert got(documents(spark, data)) == brute(data)


def test_threshold_is_exact(spark):
    """16 of 20 shingles in common of a union of 20 is a link; 15 of 19 is none."""
    tokens = [f"t{i}" for i in range(24)]
    data = [(1, " ".join(tokens), "en", "a", 1), (2, " ".join(tokens[:20]), "en", "a", 1), (3, " ".join(tokens[:19]), "en", "a", 1)]
    assert got(documents(spark, data)) == brute(data) == [(1, 20, 1), (2, 16, 1), (3, 15, 1)]
    assert got(documents(spark, [data[0], data[2]])) == [(1, 20, 1), (3, 15, 3)]


def test_keep_one(spark):
    docs = documents(spark, corpus(4)).withColumn("_keep", F.lit("mine"))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    want = sorted({c for _, _, c in brute(corpus(4)) if c is not None})
    assert ids == sorted(want, key=str) + [None]


def test_keep_one_keeps_null_ids_and_texts_of_one_id(spark):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    data = [(None, words(0)), (None, words(1)), (None, words(1)), (7, words(1)), (5, words(2)), (5, words(3)), (5, words(3)), (4, words(2) + " more"), (None, words(4)), (None, words(4) + " more")]
    kept = jaccard.keep_one(documents(spark, [(i, t, "en", "a", 1) for i, t in data])).collect()
    found = sorted(((r.doc_id, r.text.removesuffix(" more")) for r in kept), key=str)
    assert found == sorted([(None, words(0)), (7, words(1)), (4, words(2)), (5, words(3)), (None, words(4))], key=str)
    assert sum(r.doc_id is None for r in jaccard.keep_one(documents(spark)).collect()) == 1


def test_empty_and_odd_tables(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(documents(spark)) == brute(rows())


def test_graph_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102)]
    random.Random(1).shuffle(chain)
    out = {r.node: r.label for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert all(out[i] == 0 for i in range(41)) and {out[i] for i in (100, 101, 102)} == {100}


def test_copies_near_the_threshold_make_few_pairs(spark, monkeypatch):
    """Edited copies of a text that is absent: right components, and no more pairs counted than a few for each link and row."""
    r = random.Random(5)
    base = [f"w{r.randrange(5000)}" for _ in range(300)]
    data = []
    for k in range(80):
        copy = list(base)
        for _ in range(r.randrange(3, 9)):
            copy[r.randrange(300)] = f"x{r.random()}"
        data.append((k, " ".join(copy), "en", "a", 1))
    counted, linked = [], jaccard._linked
    monkeypatch.setattr(jaccard, "_linked", lambda cut, pairs: counted.append(pairs.count()) or linked(cut, pairs))
    assert got(documents(spark, data)) == brute(data)
    sets = [shingle_set(d[1]) for d in data]
    links = sum(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert sum(counted) <= 4 * len(data) + 2 * links


def test_twice_the_edited_copies_make_about_twice_the_rows(spark, monkeypatch):
    """Copies without their original, all in one group: pairs leave the tiles in proportion to the links, not to all pairs."""
    made = []
    for n in (100, 200):
        r = random.Random(6)
        base = [f"w{r.randrange(5000)}" for _ in range(300)]
        data = []
        for k in range(n):
            copy = list(base)
            for _ in range(9):
                copy[r.randrange(300)] = f"x{r.random()}"
            data.append((k, " ".join(copy), "en", "a", 1))
        counted, linked = [], jaccard._linked
        with monkeypatch.context() as m:
            m.setattr(jaccard, "LEADERS", 2)
            m.setattr(jaccard, "_linked", lambda cut, pairs, counted=counted: counted.append(pairs.count()) or linked(cut, pairs))
            assert got(documents(spark, data)) == brute(data)
        made.append(sum(counted))
    assert made[1] <= 3 * made[0] + 50
