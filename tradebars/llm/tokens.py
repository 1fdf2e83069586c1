"""Token counts of whole texts by a SentencePiece model, without a shuffle of pre-tokens.

A text's count is the sum over its pre-tokens: a run of blanks with the characters up to the next blank, or a newline. No
piece of the model goes across such a border (checked when the model is read; where one does, the model encodes whole
texts). Lengths come from two tiers: a compact broadcast table of the pre-tokens that are frequent in the languages that the
model was made for, which are the words and word beginnings among its own pieces, and a bounded cache of each worker, which
encodes what the table doesn't hold, once for each distinct pre-token. So texts are read once and nothing is shuffled.

Defined results: a null or empty text has no tokens and no bytes; repeated rows count each; other columns pass through,
and a column of the same name as an added one is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from tradebars.llm import _bytes as B

#: Pre-tokens that a worker remembers besides the table.
CACHE = 500_000
PRETOKEN = re.compile(r"\n|[ ▁]*[^ ▁\n]+|[ ▁]+")


@lru_cache(2)
def load(path: str) -> tuple[sentencepiece.SentencePieceProcessor, bool]:
    """The model, and whether it encodes pre-tokens apart."""
    model = sentencepiece.SentencePieceProcessor(model_file=path if "/" in path else SparkFiles.get(path))
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_byte(i)]
    crosses = any(re.search("[^▁]▁|\n", p) for p in pieces)
    plain = model.encode("a", out_type=str)[0].startswith("▁") and model.encode("  a  b ", out_type=str) == ["▁" * 2, "▁a", "▁", "▁b", "▁"]
    return model, plain and not crosses


def _length(model: sentencepiece.SentencePieceProcessor, pre_token: str) -> int:
    """Tokens of a pre-token inside a text. The model puts a blank before what it encodes."""
    if pre_token[0] in " ▁":
        return len(model.encode(pre_token[1:])) if len(pre_token) > 1 else 1
    return len(model.encode("\n" + pre_token)) - 2


class Lengths(dict):
    """Lengths of pre-tokens: the table's first, then what this worker has encoded."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor, table: dict[str, int]):
        super().__init__(table)
        self.model, self.table = model, table

    def __missing__(self, pre_token: str) -> int:
        if len(self) > CACHE + len(self.table):
            self.clear()
            self.update(self.table)
        self[pre_token] = n = _length(self.model, pre_token)
        return n


def frequent(model: sentencepiece.SentencePieceProcessor) -> list[str]:
    """The pieces of the model that are whole pre-tokens: a blank and letters, signs, or a newline. As many as the vocabulary
    has, some 16,000 of 32,000 pieces."""
    pieces = (model.id_to_piece(i).replace("▁", " ") for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
    return [p for p in pieces if p[0] in " \n" and PRETOKEN.fullmatch(p)]


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None, limit: int = 4096) -> DataFrame:
    """The columns in `keep` (all by default) with n_bytes, n_tokens and over_limit."""
    added = ["n_bytes", "n_tokens", "over_limit"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    model, apart = load(model_path)
    words = frequent(model) if apart else []
    compact = docs.sparkSession.sparkContext.broadcast((pa.array(words, pa.string()), np.array([_length(model, w) for w in words], np.uint16)))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, apart = load(model_path)
        keys, lengths = compact.value
        known = Lengths(model, dict(zip(keys.to_pylist(), lengths.tolist(), strict=True)))
        for batch in it:
            for part in B.chunks(batch, text):
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                if apart:
                    counts = [sum(map(known.__getitem__, PRETOKEN.findall(" " + t))) if t else 0 for t in texts]
                else:
                    counts = [len(x) for x in model.encode([t or "" for t in texts], num_threads=1)]
                sizes = [len(t.encode()) if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in names] + [pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                    names=[*names, *added],
                )

    fields = [docs.schema[c] for c in names]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["n_bytes bigint, n_tokens bigint, over_limit boolean"])
    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(batches, schema)
