import random
import re

from fixtures import SCHEMA, documents, rows
from pyspark.sql import functions as F

from tradebars.llm import decontaminate as D

ITEMS = [
    (1, "A train leaves Boston at 9 and travels 120 km in 2 hours before it meets another train, how fast did it go?"),
    (2, "the quick brown fox jumps over the lazy dog while the cat sleeps on a warm mat"),
    (3, "why is the sky so blue"),
    (4, "too short"),
    (5, None),
    (2, "the quick brown fox jumps over the lazy dog while the cat sleeps on a warm mat"),
    (7, "les élèves ont été très heureux de voir la mer šibenik"),
    (6, "He gave Anna 3 apples and then Anna gave him 3 pears and he gave Anna another 3 plums in return"),
]
DOCS = [
    (0, "Before. " + ITEMS[0][1] + " After that.", "exact", 1),
    (1, "x A train leaves Denver at 7 and travels 300 miles in 5 hours before it meets another train, how fast did it go? y", "reparameterised", 1),
    (2, "THE QUICK, BROWN FOX; jumps over the lazy dog while the cat", "exact", 2),
    (3, "the quick brown fox jumps over the lazy cat", None, None),
    (4, "they asked: why is the sky so blue", "exact", 3),
    (5, "too short", None, None),
    (8, "x LES ÉLÈVES ONT ÉTÉ TRÈS HEUREUX DE VOIR LA MER ŠIBENIK y", "exact", 7),
    (6, "He gave Emma 8 apples and then Emma gave him 8 pears and he gave Emma another 8 plums in return", "reparameterised", 6),
    (7, "He gave Emma 8 apples and then Paul gave him 5 pears and he gave Rosa another 9 plums in return", None, None),
]


def run(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    return D.leaks(docs, items)


def test_planted(spark):
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t, *_ in DOCS] + [(0, DOCS[0][1], "en", "a", 1), (None, DOCS[2][1], "en", "a", 1)] + rows()[:20])
    out = {(r.doc_id, r.item_id): r.kind for r in run(spark, docs).collect()}
    want = {(i, item): kind for i, _, kind, item in DOCS if kind} | {(None, 2): "exact"}
    assert out == want
    kept = D.drop_leaks(docs.withColumn("_h", F.lit(1)), spark.createDataFrame(ITEMS, "item_id bigint, text string"))
    assert "_h" in kept.columns and {r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 9} >= {3, 5, 7}
    assert kept.where("doc_id in (0, 1, 2, 4, 6, 8) and text like '%A train%'").count() == 0


def test_literal_windows_equal_brute_force(spark):
    r = random.Random(5)
    vocabulary = "alpha beta gamma delta epsilon zeta eta theta".split()
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(9, 20)))) for i in range(20)]
    docs = []
    for i in range(60):
        words = [r.choice(vocabulary) for _ in range(30)]
        if i % 2:
            cut = items[i % 20][1].split()
            a = r.randint(0, max(0, len(cut) - 10))
            words[5:5] = cut[a : a + r.randint(8, 14)]
        docs.append((i, " ".join(words), "en", "a", 1))
    want = set()
    for d, t, *_ in docs:
        for k, u in items:
            grams = lambda x: {(tuple(x[i : i + 8]), i) for i in range(len(x) - 7)}
            mine = {g for g, _ in grams(t.split())}
            n = len({i for g, i in grams(u.split()) if g in mine})
            if n >= min(3, len(u.split()) - 7):
                want.add((d, k, n))
    got = D.leaks(documents(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id, r.n_matched) for r in got} == want and want


def test_verbatim_windows_outlive_an_inconsistent_slot(spark):
    """Word for word but for the last of three equal numbers: 17 words are the same, so 10 windows."""
    edited = ITEMS[7][1].replace("3 plums", "9 plums")
    out = run(spark, documents(spark, [(9, edited, "en", "a", 1), DOCS[8][:2] + ("en", "a", 1)])).collect()
    assert [(r.doc_id, r.item_id, r.n_matched, r.kind) for r in out] == [(9, 6, len(edited.split("9")[0].split()) - 7, "exact")]


def test_items_dense_in_slots(spark):
    items = [(1, "If Anna buys 3 kg at 2 euros and Ben buys 5 kg at 4 euros, who pays more?"), (2, "Say, Anna has 3 kg, 4 kg, 7 kg and Ben has 9 kg left")]
    docs = [
        (0, "Question: If Emma buys 7 g at 9 dollars and Paul buys 6 g at 8 dollars, who pays more? Paul.", "reparameterised", 1),
        (1, "Question: " + items[0][1] + " Ben.", "exact", 1),
        (2, "Question: If Emma buys 7 g at 9 dollars and Paul buys 6 tons at 8 cents, who pays more? Paul.", None, None),
        (3, "Well. Say, Emma has 2 g, 5 g, 6 g and Paul has 8 g left over", "reparameterised", 2),
        (4, "If Emma buys 7 g at 9 dollars, who pays more? " + "3 kg " * 4000, None, None),
    ]
    out = D.leaks(documents(spark, [(i, t, "en", "a", 1) for i, t, *_ in docs]), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id, r.kind) for r in out} == {(i, item, kind) for i, _, kind, item in docs if kind}


def test_unscreened_path_is_the_same(spark, monkeypatch):
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t, *_ in DOCS])
    one = sorted(map(str, run(spark, docs).collect()))
    monkeypatch.setattr(D, "SCREENED", 0)
    assert sorted(map(str, run(spark, docs).collect())) == one


def test_canonical_words():
    import pyarrow as pa

    words = D.Canonical(pa.array(["He paid 3.50 USD to Maria. Maria ran 5km, TWO miles"]))
    assert words.kinds.tolist() == [0, 0, D.NUMBER, D.UNIT, 0, D.NAME, 0, 0, D.NUMBER, D.UNIT, D.NUMBER, D.UNIT]


def test_names_of_any_alphabet():
    import pyarrow as pa

    words = D.Canonical(pa.array(["So Élodie met Žižková, Ángel and Иван at ÉCOLE with été Šibenik 漢字 Ab a É"]))
    assert words.kinds.tolist() == [0, D.NAME, 0, D.NAME, D.NAME, 0, D.NAME, 0, 0, 0, 0, D.NAME, 0, D.NAME, 0, 0]


WORD = re.compile(r"[0-9]+(?:[.,][0-9]+)*|[^\W0-9_]+")


def canonical(text):
    """(lower-case word, class) of each word, one by one."""
    out, before = [], 0
    for m in WORD.finditer(text):
        w = m[0]
        number = w[0].isdigit() or w.lower() in D.NUMBERS.split()
        unit = bool(out) and out[-1][1] == D.NUMBER and w.lower() in D.UNITS.split() and not number
        name = len(w) > 1 and w[0] != w[0].lower() and w[1] == w[1].lower() and not any(c in ".!?:\n" for c in text[before : m.start()]) and before > 0
        out.append((w.lower(), D.NUMBER if number else D.UNIT if unit else D.NAME if name else 0))
        before = m.end()
    return out


def spans_of(words):
    """(first, end, whether a template) of all windows of WINDOW words and of the longer ones where slots are dense."""
    n = len(words)
    out = [(i, i + D.WINDOW, False) for i in range(n - D.WINDOW + 1)]
    for i in range(n - D.WINDOW + 1):
        slots = sum(k > 0 for _, k in words[i : i + D.WINDOW])
        out += [(i, i + D.WINDOW, True)] if slots and D.WINDOW - slots >= D.LITERALS else []
    literal = [i for i, (_, k) in enumerate(words) if k == 0]
    out += [(a, b + 1, True) for a, b in zip(literal, literal[D.LITERALS - 1 :], strict=False) if b + 1 - a > D.WINDOW]
    return out


def brute_leaks(docs, items):
    found = set()
    for d, text in docs:
        mine = canonical(text)
        for item, theirs_text in items:
            theirs = canonical(theirs_text)
            n_windows = len(theirs) - D.WINDOW + 1
            if n_windows < 1:
                continue
            shape = lambda ws, a, b, t: tuple((k or w) if t else w for w, k in ws[a:b])
            met = {}
            for a, b, t in spans_of(theirs):
                for x, y, u in spans_of(mine):
                    if t == u and shape(theirs, a, b, t) == shape(mine, x, y, u):
                        met.setdefault(x - a, []).append((a, b, t, x))
            places, same = set(), True
            for align, hits in met.items():
                values = {}
                for a, b, t, x in hits if align is not None else ():
                    if t:
                        for (w, k), (v, _) in zip(theirs[a:b], mine[x : x + b - a], strict=True):
                            if k:
                                values.setdefault(w, set()).add(v)
                good = all(len(v) == 1 for v in values.values())
                used = {a for a, b, t, x in hits if good or not t}
                places |= used
                if used and good and any(v != {w} for w, v in values.items()):
                    same = False
            n_open = len([1 for a, b, t in spans_of(theirs) if (b - a > D.WINDOW and t) or (not t and sum(k > 0 for _, k in theirs[a:b]) <= D.WINDOW - D.LITERALS)])
            least = min(D.LEAST, n_windows, *([n_open] if n_open else []))
            if len(places) >= least:
                found.add((d, item, len(places), "exact" if same else "reparameterised"))
    return found


def test_templates_equal_brute_force(spark):
    """Items with slots of all kinds, copied with other values, consistent or not, whole or in part."""
    r = random.Random(8)
    names, plain = ["Anna", "Élodie", "Bo", "Žižková"], "buys sells a the from red box of tea and then pays for it while train goes past".split()
    slot = lambda: r.choice([r.choice(names), str(r.randint(1, 9)), f"{r.randint(2, 9)} {r.choice(['kg', 'km'])}"])
    items = [(i, "so " + " ".join(slot() if r.random() < 0.3 else r.choice(plain) for _ in range(r.randint(10, 24)))) for i in range(25)]
    docs = []
    for i in range(120):
        words = items[i % 25][1].split()
        swap = {n: r.choice(names) for n in names} | {str(k): str(r.randint(1, 99)) for k in range(1, 10)} | {"kg": "km", "km": "kg"}
        if i % 3 == 0:
            words = [swap.get(w, w) for w in words]
        elif i % 3 == 1:
            words = [swap.get(w, w) if r.random() < 0.5 else w for w in words]
        a = r.randint(0, 4) * (i % 2)
        docs.append((i, "Well then " + " ".join(words[a:]) + " indeed."))
    want = brute_leaks(docs, items)
    got = D.leaks(documents(spark, [(i, t, "en", "a", 1) for i, t in docs]), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(x.doc_id, x.item_id, x.n_matched, x.kind) for x in got} == want
    assert {k for *_, k in want} == {"exact", "reparameterised"} and len(want) > 60


def test_null_empty_and_very_long_texts(spark):
    long = "filler " * 200_000 + ITEMS[1][1] + " filler" * 1000
    data = [(20, None, None, None, None), (21, "", "en", "a", 0), (22, long, "en", "a", 1), (22, long, "en", "a", 1), (None, None, "en", "a", 1)]
    assert [(x.doc_id, x.item_id) for x in run(spark, documents(spark, data)).collect()] == [(22, 2)]
    kept = D.drop_leaks(documents(spark, data), spark.createDataFrame(ITEMS, "item_id bigint, text string"))
    assert sorted(str(x.doc_id) for x in kept.collect()) == ["20", "21", "None"]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert run(spark, empty).count() == 0
    assert D.leaks(documents(spark), spark.createDataFrame([], "item_id bigint, text string")).count() == 0


def test_a_shared_preamble_makes_no_leak_and_few_rows(spark, monkeypatch):
    """60 items and 60 documents share 17 words: nothing leaks by these, a copied item is still found with all its windows, and
    items that only differ in a number are found by what they share."""
    preamble = "read the following question with care and then choose the one answer that is right for all cases"
    r = random.Random(9)
    word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(3))
    tails = [" ".join(word() for _ in range(14)) for _ in range(60)]
    items = [(i, f"{preamble} {t}") for i, t in enumerate(tails)]
    same = [(100 + i, f"how far does the slow red train go in {10 + i} hours") for i in range(12)]
    docs = [(i, f"{preamble} {' '.join(word() for _ in range(40))}", "en", "a", 1) for i in range(60)]
    docs += [(500, f"as it says {preamble} {tails[7]} and more", "en", "a", 1), (501, "they ask how far does the slow red train go in 15 hours of the day", "en", "a", 1)]
    rows, met = [], D._met
    monkeypatch.setattr(D, "_met", lambda *a: (out := met(*a), rows.append(out.count()))[0])
    found = D.leaks(documents(spark, docs), spark.createDataFrame(items + same, "item_id bigint, text string")).collect()
    by = {(x.doc_id, x.item_id): x for x in found}
    assert {k for k in by if k[0] < 500 or k[1] < 100} == {(500, 7)} and by[500, 7].n_matched == by[500, 7].n_windows
    assert (501, 105) in by and by[501, 105].kind == "exact"
    assert rows[0] < 400


def test_leaks_by_shared_windows_alone_are_all_there(spark, monkeypatch):
    """Items of shared passages with slots and their own tails: the pairs of classes and members equal brute force over all windows."""
    r = random.Random(10)
    word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(3))
    words = lambda n: " ".join(word() for _ in range(n))
    value = lambda: str(r.randint(1, 99))
    shapes = [words(11), f"{words(4)} # {words(3)} @ {words(4)} # {words(3)}", f"{words(3)} # # {words(2)} # {words(3)} @ {words(2)}", f"{words(6)} # {words(4)}"]
    filled = lambda t, a, b: t.replace("#", a).replace("@", b)
    items = []
    for i in range(60):
        a = value()
        first, *more = r.sample(shapes, r.randint(1, 2))
        parts = [filled(first, a, r.choice([a, value()]))] + [filled(m, value(), value()) for m in more]
        tail = words(r.choice([0, 2, 9]))
        items.append((i, " ".join([words(r.randint(0, 3)), *parts, tail]).strip()))
    items += [(70, items[0][1]), (0, items[1][1])]
    docs = []
    for i in range(60):
        t = items[r.randrange(60)][1] if i % 3 == 0 else filled(r.choice(shapes), value(), value())
        if i % 3 == 1:
            t = " ".join(t.split()[r.randint(0, 2) : r.randint(9, 20)])
        docs.append((i, f"{words(5)} {t} {words(5)}" + (f" {filled(r.choice(shapes), value(), value())}" if i % 4 == 0 else "")))
    want = {(d, t, n, k) for d, j, n, k in brute_leaks(docs, list(enumerate(t for _, t in items))) for t in [(items[j][0], items[j][1])]}
    table, benchmark = documents(spark, [(i, t, "en", "a", 1) for i, t in docs]), spark.createDataFrame(items, "item_id bigint, text string")
    key = {x.k: (x.item_id, x.text) for x in benchmark.select("item_id", "text", F.xxhash64("item_id", "text").alias("k")).collect()}
    for common, screened in ((8, D.SCREENED), (2, 0), (10**6, D.SCREENED)):
        monkeypatch.setattr(D, "COMMON", common)
        monkeypatch.setattr(D, "SCREENED", screened)
        found = D.leaks(table, benchmark, shared=True).cache()
        got = [(x.doc_id, key[x.item_key], x.n_matched, x.kind) for x in D.pairs(found).collect()]
        assert len(got) == len(set(got)) and set(got) == want
        rows = found.where("kind != 'member'").collect()
        assert sum(x.n_items for x in rows) == len(want) and all(x.n_windows > 0 for x in rows)
        alone = {(x.doc_id, x.item_id) for x in D.leaks(table, benchmark).collect()}
        assert (common == 10**6) == (len(alone) == len({(d, t[0]) for d, t, *_ in want}))
    assert {k for *_, k in want} == {"exact", "reparameterised"} and len(want) > 300


def test_a_question_asked_with_many_numbers_is_found_with_another(spark):
    """Twelve items differ in a number: a copy with a thirteenth, and one cut before the number, leak by what all share."""
    items = [(i, f"how far does the slow red train go in {10 + i} hours") for i in range(12)]
    docs = [(0, "they ask how far does the slow red train go in 99 hours of the day", "en", "a", 1), (1, "nothing of that is in here", "en", "a", 1)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.leaks(documents(spark, docs), benchmark, shared=True)
    rows = found.where("kind != 'member'").collect()
    assert [(x.doc_id, x.item_id, x.n_matched, x.n_windows, x.kind, x.n_items) for x in rows] == [(0, 0, 4, 4, "reparameterised", 12)]
    assert sorted((x.doc_id, x.item_id) for x in D.pairs(found).collect()) == [(0, i) for i in range(12)]


def test_a_shared_preamble_gives_one_row_a_document(spark):
    preamble = "read the following question with care and then choose the one answer that is right for all cases"
    r = random.Random(11)
    word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(3))
    items = [(i, f"{preamble} {' '.join(word() for _ in range(14))}") for i in range(60)]
    docs = [(i, f"{preamble} {' '.join(word() for _ in range(40))}", "en", "a", 1) for i in range(60)] + [(60, f"see {items[7][1]}", "en", "a", 1)]
    found = D.leaks(documents(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"), shared=True).collect()
    rows = [x for x in found if x.kind != "member"]
    assert len(rows) == 62 and sum(x.n_items for x in rows) == 61 * 60 and len(found) == 62 + 60
    assert sorted((x.item_id, x.n_items) for x in rows if x.doc_id == 60) == [(0, 59), (7, 1)]
