"""License scans by a positional index of rare licence words.

Spark's built-in functions do all of it. Texts are lower-cased (A-Z) and cut into words. Base phrases are counted where
their words stand consecutively. The index holds, for each word of the licence templates below, the templates and places
where it stands. Word weights (IDF) of all words of templates are counted over all documents. Of each template's key phrase
the `LOOKED_UP` words of highest weight are looked up: a word at place p in the document and q in the template proposes that
the template begins at p - q, and the proposals of the words are intersected. Where all agree, the template's words are laid
against those places. A template, a licence's naming line, its notice or its body, counts when its mandatory key phrase
stands there whole. As a whole key phrase has all its words, those looked up are among them, so no phrase is missed. Its
score is the weight of its matched words, as a share of all its words.

Defined results: a null or empty text has no words, places or labels, and score 0; repeated rows get the same result each;
rows with a null doc_id are told apart by their text; an empty table gives an empty result; ties in weight go by the
word; other columns play no part.
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebars.llm._tables import settle

#: The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label, template, mandatory key phrase within it.
TEMPLATES = (
    ("agpl-3.0", "gnu affero general public license version 3", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license", "not use this file except in compliance with the license"),
    ("apache-2.0", "licensed under the apache license 2 0", "apache license 2 0"),
    ("artistic-2.0", "the artistic license 2 0", "artistic license 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsl-1.0", "boost software license version 1 0", "boost software license"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-4.0", "creative commons attribution 4 0 international", "creative commons attribution 4 0 international"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0-1.0", "creative commons zero cc0 1 0 universal", "cc0 1 0"),
    ("epl-2.0", "eclipse public license v 2 0", "eclipse public license"),
    ("gpl-2.0", "gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-3.0", "either version 3 of the license or at your option any later version", "version 3 of the license or at your option any later version"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "permission to use copy modify and or distribute this software"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
#: Licence bodies as published, without the lines that name holders and years: label, mandatory key phrase, text.
BODIES = (
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", "provided that the above copyright notice and this permission notice appear in all copies", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
        OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
        CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
        NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("unlicense", "this is free and unencumbered software released into the public domain", """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
        code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this
        software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our
        heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."""),
    ("apache-2.0", "distributed under the license is distributed on an as is basis", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("gpl-3.0", "either version 3 of the license or at your option any later version", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General
        Public License along with this program. If not, see"""),
    ("bsl-1.0", "obtaining a copy of the software and accompanying documentation covered by this license", """
        Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works
        of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire
        statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all
        derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."""),
    ("mpl-2.0", "subject to the terms of the mozilla public license", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/."""),
    ("zlib", "altered source versions must be plainly marked as such", """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an
        acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as
        being the original software. 3. This notice may not be removed or altered from any source distribution."""),
)
#: Licences that a file names by an identifier line.
IDENTIFIED = ("agpl-3.0", "apache-2.0", "artistic-2.0", "bsd-2-clause", "bsd-3-clause", "bsl-1.0", "cc-by-4.0", "cc-by-nc-4.0", "cc-by-sa-4.0", "cc0-1.0", "epl-2.0", "gpl-2.0", "gpl-3.0", "isc", "lgpl-2.1", "lgpl-3.0", "mit", "mpl-2.0", "unlicense", "zlib")
#: Words of a key phrase that are looked up.
LOOKED_UP = 3
#: Share of a body's weight from which on the whole licence stands in the text.
WHOLE = 0.9
_KEY = ["doc_id", "text_hash"]
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def templates() -> list[tuple[str, list[str], list[str], bool]]:
    """(label, words, words of the key phrase, whether a body) of every template."""
    cut = lambda t: re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", t.lower()).split()
    lines = [(label, f"spdx license identifier {label}", f"spdx license identifier {label}") for label in IDENTIFIED]
    return [(label, cut(text), cut(key), False) for label, text, key in (*TEMPLATES, *lines)] + [(label, cut(text), cut(key), True) for label, key, text in BODIES]


def _words() -> Column:
    lowered = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.trim(F.regexp_replace(lowered, _BREAK, " "))


def _blanks(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def base(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_base, first_word, last_word, base_labels array) of every row."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _words().alias("words"))
    rows = rows.select(*_KEY, F.when(F.col("words") == "", 0).otherwise(_blanks(F.col("words")) + 1).alias("n_words"), F.concat(F.lit(" "), "words", F.lit(" ")).alias("padded"))

    def places(phrase: str) -> Column:
        """n, first and last of a phrase. Each word has a blank before it, so blanks count words."""
        cut = F.array(F.split("padded", f"(?<= ){phrase}(?= )", -1))
        tell = lambda s: F.struct(
            (F.size(s) - 1).alias("n"), (_blanks(s[0]) - 1).alias("first"), (F.col("n_words") - _blanks(F.element_at(s, -1)) - phrase.count(" ")).alias("last"), F.lit(BASE[phrase]).alias("label")
        )
        return F.when(F.col("padded").contains(f" {phrase} "), F.transform(cut, tell)[0])

    found = rows.select(*_KEY, "n_words", F.filter(F.array(*[places(p) for p in BASE]), lambda p: p.isNotNull()).alias("found"))
    return found.select(
        *_KEY,
        F.col("n_words").cast("bigint").alias("n_words"),
        F.aggregate("found", F.lit(0).cast("bigint"), lambda acc, p: acc + p["n"]).alias("n_base"),
        F.array_min("found.first").cast("bigint").alias("first_word"),
        F.array_max("found.last").cast("bigint").alias("last_word"),
        F.col("found.label").alias("base_labels"),
    )


def _index(spark: SparkSession, weights: dict[str, float]) -> DataFrame:
    """(template, label, body, place, word, weight, key, looked_up): the words of all templates, whether they belong to the key
    phrase, and how many words of that phrase are looked up where this is one of them, else null."""
    rows = []
    for t, (label, words, key, body) in enumerate(templates()):
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        chosen = sorted(set(key), key=lambda w: (-weights[w], w))[:LOOKED_UP]
        rows += [(t, label, body, i, w, weights[w], at <= i < at + len(key), len(chosen) if at <= i < at + len(key) and w in chosen else None) for i, w in enumerate(words)]
    return spark.createDataFrame(rows, "template int, label string, body boolean, place int, word string, weight double, key boolean, looked_up int")


def idf(docs: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """The weight of each word of the vocabulary, by how many of all documents hold it; as many rows as words reach the driver."""
    held = F.array_intersect(F.split(_words(), " "), F.array(*map(F.lit, vocabulary)))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    total, found = docs.count(), {r.word: r.n for r in counts.collect()}
    return {w: 1 + math.log((total + 1) / (found.get(w, 0) + 1)) for w in vocabulary}


def matched(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, label, score, whole) of the templates whose key phrase a text holds, one row a label; whole says
    whether a licence's whole body stands there, but for a tenth of its weight."""
    vocabulary = sorted({w for _, words, _, _ in templates() for w in words})
    index = _index(docs.sparkSession, idf(docs, vocabulary))
    weighted = F.broadcast(index.select("template", "label", "body", "place", "word", "weight", "key"))
    postings = F.broadcast(index.where("looked_up is not null").select("template", "word", "place", "looked_up"))
    # A text with a whole key phrase holds the rarest of its words.
    rarest = sorted({r.word for r in index.where("looked_up is not null").groupBy("template").agg(F.max_by("word", F.struct("weight", "word")).alias("word")).collect()})
    rows = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), _words().alias("words"))
    held = rows.where(F.concat(F.lit(" "), "words", F.lit(" ")).rlike(f" (?:{'|'.join(map(re.escape, rarest))}) "))
    hits = held.select(*_KEY, F.posexplode(F.split("words", " ")).alias("place", "word")).where(F.col("word").isin(vocabulary))
    tokens = settle(hits.repartition(*_KEY).dropDuplicates([*_KEY, "place"]).withColumnRenamed("place", "at"))
    proposed = tokens.join(postings, "word").select(*_KEY, "template", (F.col("at") - F.col("place")).alias("begin"), "word", "looked_up")
    begins = proposed.groupBy(*_KEY, "template", "begin").agg(F.count_distinct("word").alias("n"), F.max("looked_up").alias("looked_up")).where("n = looked_up").select(*_KEY, "template", "begin")

    got = tokens.withColumn("there", F.lit(True)).alias("g")

    def seen(begins: DataFrame, words: DataFrame) -> DataFrame:
        """The template's words at the places that its beginning proposes, and whether the document has them there."""
        expected = begins.join(words, "template").select(*_KEY, "template", "label", "body", "begin", (F.col("begin") + F.col("place")).alias("at"), "word", "weight").alias("e")
        same = F.col("e.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("e.text_hash") == F.col("g.text_hash")) & (F.col("e.at") == F.col("g.at")) & (F.col("e.word") == F.col("g.word"))
        return expected.join(got, same, "left").select("e.*", F.coalesce("g.there", F.lit(False)).alias("there"))

    # Whole templates are laid against the text only where their key phrases stand.
    by = [*_KEY, "template", "begin"]
    stands = seen(begins, weighted.where("key")).groupBy(*by).agg(F.every("there").alias("whole")).where("whole").select(*by)
    judged = seen(settle(stands), weighted).groupBy(*by, "label", "body").agg((F.sum(F.when(F.col("there"), F.col("weight")).otherwise(0.0)) / F.sum("weight")).alias("score"))
    return judged.groupBy(*_KEY, "label").agg(F.max("score").alias("score"), F.max(F.col("body") & (F.col("score") >= WHOLE)).alias("whole"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, whole_labels) of every row."""
    docs = docs.select("doc_id", "text")
    more = matched(docs).groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(F.collect_set("label").alias("more"), F.max("score").alias("best"), F.collect_set(F.when(F.col("whole"), F.col("label"))).alias("bodies"))
    rows = base(docs)
    out = rows.join(more, rows["doc_id"].eqNullSafe(more["_d"]) & (rows["text_hash"] == more["_h"]), "left")
    joined = lambda c: F.array_join(F.sort_array(F.array_distinct(c)), ",")
    none = F.expr("cast(array() as array<string>)")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        joined(F.col("base_labels")).alias("base_labels"),
        joined(F.concat("base_labels", F.coalesce("more", none))).alias("labels"),
        F.when(F.size("base_labels") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce("best", F.lit(0.0)))).alias("score"),
        joined(F.coalesce("bodies", none)).alias("whole_labels"),
    )
