import math
import re

from fixtures import SCHEMA, documents, rows
from pyspark.sql import functions as F

from tradebars.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    "Licensed under CC BY-NC 4.0.",
    "cc by cc by, CC.BY! All rights reserved. all   RIGHTS-reserved é cc",
    "This work is licensed under the GNU General Public License, version 3. " * 2,
    "the license of the apache helicopter, version 2 0 of the mit campus; general license public",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "Released under the MIT License. Licensed under the Apache License, Version 2.0.",
    "Licensed under the Apache License, Version 3.",
    "GENERAL PUBLIC LICENSE",
    "Licensed under the Apache License 2.0",
    "# SPDX-License-Identifier: MIT",
    "// SPDX-License-Identifier: GPL-3.0-or-later */ identifier spdx license",
    "word " * 500 + "mozilla public license " + "mit " * 400,
    "éCC BY", "xcc by cc byx cc by",
    "modification permitted " * 3 + "redistribution and use in source and binary forms " + "permitted forms binary " * 9,
    "compliance license file " * 5 + "you may not use this file except in compliance with the license compliance",
]


def brute(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels, more = [], set(), set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    for label, t, k, _ in licenses.templates():
        off = next(i for i in range(len(t)) if t[i : i + len(k)] == k)
        more |= {label} if any(words[i : i + len(k)] == k and i - off + len(t) > 0 for i in range(len(words))) else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | more))


def test_scan_equals_brute_force(spark):
    docs = documents(spark, rows() + [(500 + i, t, "en", "a", 1) for i, t in enumerate(TEXTS)] + [(500, TEXTS[0], "en", "a", 1)])
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = licenses.scan(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == brute(texts[r.doc_id]), r
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_method_labels(spark):
    out = {r.doc_id: r for r in licenses.scan(documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(TEXTS)])).collect()}
    assert out[0].labels == "cc-by,cc-by-nc-4.0" and out[3].labels == "" and out[4].labels == "mit"
    assert out[5].labels == "apache-2.0,mit" and out[6].labels == "" and out[7].labels == "gpl"
    assert out[8].labels == "apache-2.0" and out[9].labels == "mit" and out[10].labels == "gpl-3.0"
    assert out[11].labels == "mpl-2.0" and out[4].score > 0.9


def test_whole_bodies(spark):
    """A body is whole with few words changed; with its key phrase alone, or scattered, it isn't. The brute force agrees on all labels."""
    texts, want = [], []
    for label, key, text in licenses.BODIES:
        words = text.split()
        texts += ["Copyright 2024 someone\n" + text + "\nint main()", f"about {key} and more", " ".join(reversed(words)), " ".join(w if i % 40 else "changed" for i, w in enumerate(words)).replace("changed", words[0], 1)]
        want += [label, "", "", None]
    out = {r.doc_id: r for r in licenses.scan(documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert out[i].labels == brute(t)[-1], t
        assert want[i] is None or out[i].whole_labels == want[i]
    assert all(out[i].score > 0.99 for i in range(0, len(texts), 4))


def test_clashing_columns_and_ties(spark):
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(TEXTS)])
    odd = docs.withColumns({c: F.lit("mine") for c in ("word", "words", "place", "template", "label", "score", "text_hash", "weight", "at", "key")})
    assert sorted(map(str, licenses.scan(odd).collect())) == sorted(map(str, licenses.scan(docs.repartition(5)).collect()))


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_weights_count_all_documents_and_proposals_are_intersected(spark):
    """Rarity is that of the whole table; many places of one looked-up word alone propose nothing that is laid against the text."""
    texts = ["the mit campus"] * 3 + ["a license"] * 9 + ["nothing at all", None, "released under the mit license"]
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    found = licenses.idf(docs, ["mit", "license", "absent"])
    assert found["absent"] > found["mit"] > found["license"] and abs(found["mit"] - 1 - math.log(16 / 5)) < 1e-12
    assert [r.doc_id for r in licenses.scan(docs).where("labels like '%mit%'").collect()] == [14]
