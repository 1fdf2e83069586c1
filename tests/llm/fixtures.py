"""Small tables with nulls, empty and long texts, repeated rows and clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows(seed=7):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghé") for _ in range(r.randint(1, 8))) for _ in range(300)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    out = []
    for i in range(60):
        t = text(r.randint(1, 120))
        if i % 5 == 0:
            t = t.replace(" ", "\n", 3) + "  \t" + t.upper()
        if i % 7 == 0:
            t = "  " + t + "\n" + t[:40] + "\n" + t[:40] + " <|endoftext|> \x00\x1c é　ﬁ 漢字🙂 '" + "s"
        out.append((i, t, r.choice(["en", "fr"]), r.choice(["a", "b"]), len(t)))
    long = text(20_000)
    out += [(100, None, "en", "a", None), (101, "", None, None, 0), (102, long, "en", None, len(long)), (103, "x" * 3000 + " " * 700 + "ab" * 900, "fr", "a", 1), (None, "null id", "en", "a", 7)]
    return out + out[:3]


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
