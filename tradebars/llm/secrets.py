"""Secret scans: single secrets by pattern, and credentials whose parts stand near each other.

Spark's built-in functions do all of it. A kind's matches are cut out with `regexp_extract_all`, the text between them with
`split` by the same pattern; running sums of both lengths give the places in code points. Strong parts (assigned secrets,
access identifiers, long hexadecimal strings) are always reported. Weak parts (user or client identifiers, strings that
look like keys, endpoints) are reported only with their complement in scope: an identifier with a secret, a secret with an
identifier, an endpoint with both. The scope reaches `SCOPE` code points to both sides; it is searched by an interval join
over buckets of that width, in which each bucket holds only the first and last place of a role, so the join makes at most
three rows per weak part whatever the number of parts.

Defined results: a null or empty text has no spans; where a weak part overlaps a strong one only the strong one counts;
repeated rows get the same spans each; rows with a null doc_id are told apart by their text; an empty table gives an empty
result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradebars.llm._tables import settle, shield

#: The patterns of each kind, in the order in which kinds are listed, and the least length of a match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
IDENTIFIER = r"""(?i)(?:access_?key_?id|client_?id|user_?name|user_?id|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
SECRET = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""(?:https?|ftp|jdbc:[a-z]+)://[^\s"'<>]+|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{2,5})?(?![0-9.])"""
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
STRONG = KINDS[:3]
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "secret": "secret", "endpoint": "endpoint"}
SCOPE = 200
MASK = "[SECRET]"
#: Code points of a block that `redact` cuts texts with secrets into.
BLOCK = 4096
#: Documents with secrets up to which `redact` broadcasts their spans.
BROADCAST_ROWS = 200_000

_KEY = ["doc_id", "text_hash"]


def _found(kind: str, pattern: str, hint: Column, value_group: int = 0) -> Column:
    """An array of this kind's matches: (kind, i, characters before since the last match, length, length of the value)."""
    text = F.col("text")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else matches
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), values.alias("value"))

    def one(z: Column, i: Column) -> Column:
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.char_length(z["gap"]).alias("gap"), F.char_length(z["match"]).alias("size"), F.char_length(z["value"]).alias("value"))

    return F.when(hint, F.filter(F.transform(zipped, one), lambda x: x["size"].isNotNull()))


def _parts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end) of all matches that count, one for each of repeated rows."""
    text = F.col("text")
    rare = lambda p: text.rlike(p)
    found = F.array(
        _found("assign", ASSIGN, rare(r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""), 2),
        _found("access", ACCESS, text.contains("AKIA")),
        _found("hex", HEX, rare("[0-9a-f]{24}")),
        _found("identifier", IDENTIFIER, rare(r"""(?i)(?:key_?id|client_?id|user_?name|user_?id|login|account)["']?\x20*[:=]""")),
        _found("secret", SECRET, rare("[A-Za-z0-9+/]{40}")),
        _found("endpoint", ENDPOINT, text.contains("://") | rare(r"[0-9]\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]")),
    )
    rows = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(F.flatten(F.filter(found, lambda a: a.isNotNull()))).alias("x"))
    rows = rows.select(*_KEY, "x.*").repartition(*_KEY).dropDuplicates([*_KEY, "kind", "i"])
    upto = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy(*_KEY, "kind").orderBy("i"))
    placed = rows.withColumn("end", upto).withColumn("start", F.col("end") - F.col("size"))
    return placed.where((F.col("kind") != 0) | (F.col("value") >= 6)).select(*_KEY, "kind", "start", "end")


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), kind + 1)


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end) of what is reported; kind is an index into KINDS, the end is exclusive."""
    strong = F.col("kind") < len(STRONG)
    by = Window.partitionBy(*_KEY).orderBy("start", "kind")
    before = F.max(F.when(strong, F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(strong, F.col("start"))).over(by.rowsBetween(1, Window.unboundedFollowing))
    free = ~(F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False)))
    parts = _parts(docs).withColumn("free", free).where(strong | F.col("free")).drop("free")
    # Of weak parts that overlap, the first is one thing with what it holds, which so is no complement of it.
    over = F.max(F.when(~strong, F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, -1))
    parts = settle(parts.withColumn("over", over).where(strong | F.col("over").isNull() | (F.col("over") <= F.col("start"))).drop("over"))

    weak = parts.where(~strong)
    bucket = F.floor(F.col("start") / SCOPE)
    anchors = weak.withColumn("bucket", F.explode(F.sequence(bucket - 1, F.floor((F.col("end") + SCOPE) / SCOPE))))
    roles = parts.withColumns({"role": _role(F.col("kind")), "bucket": bucket})
    ends = [f(F.when(F.col("role") == r, F.col("start"))).alias(f"{n}_{r}") for r in ("identifier", "secret") for n, f in (("first", F.min), ("last", F.max))]
    scopes = roles.where("role != 'endpoint'").groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.col("bucket").alias("_b")).agg(*ends)
    near = anchors.join(scopes, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")) & (F.col("bucket") == F.col("_b")))

    def has(role: str) -> Column:
        """Whether the bucket has a part of the role within the scope: between its first and last, a part in the scope's
        own bucket always is, and in the others the nearer end decides."""
        low, high = F.col("start") - SCOPE, F.col("end") + SCOPE
        first, last = F.col(f"first_{role}"), F.col(f"last_{role}")
        return F.max(F.coalesce(((first >= low) & (first < high)) | ((last >= low) & (last < high)) | ((first < low) & (last >= high)), F.lit(False)))

    seen = near.groupBy(*_KEY, "kind", "start", "end").agg(has("identifier").alias("identifier"), has("secret").alias("secret"))
    kind = F.col("kind")
    complement = F.when(kind == KINDS.index("identifier"), F.col("secret")).when(kind == KINDS.index("secret"), F.col("identifier")).otherwise(F.col("secret") & F.col("identifier"))
    return parts.where(strong).union(seen.where(complement).select(*_KEY, "kind", "start", "end"))


def _grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans array<(start, kind, end)>) of the texts with spans, sorted."""
    return spans(docs).groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row; spans is an array of (start, kind, end, name)."""
    found = _grouped(docs.select("doc_id", "text")).withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"})
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    out = rows.join(found, rows["doc_id"].eqNullSafe(found["_d"]) & (rows["text_hash"] == found["_h"]), "left")
    names = F.array(*[F.lit(k) for k in KINDS])
    named = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.element_at(names, s["kind"] + 1).alias("name")))
    return out.select("doc_id", F.coalesce(named, F.expr("cast(array() as array<struct<start: bigint, kind: int, end: bigint, name: string>>)")).alias("spans"))


def written(spans_: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _masked(mask: str) -> Column:
    """The text, cut into blocks of BLOCK code points, with a mask for each of its merged spans.

    What lies between two spans is taken from the blocks at its ends and the whole ones between, so the work grows with the
    text and the spans, not with their product.
    """

    def between(low: Column, high: Column) -> Column:
        first, last = F.floor(low / BLOCK).cast("int"), F.floor(high / BLOCK).cast("int")
        block = lambda i: F.coalesce(F.get("blocks", i), F.lit(""))
        at = lambda x: (x % BLOCK).cast("int")
        one = F.substring(block(first), at(low) + 1, F.greatest(high - low, F.lit(0)).cast("int"))
        inner = F.array_join(F.slice("blocks", first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        return F.when(first == last, one).otherwise(F.concat(F.substring(block(first), at(low) + 1, F.lit(BLOCK)), inner, F.substring(block(last), F.lit(1), at(high))))

    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.col("spans.end"))
    starts = F.concat(F.col("spans.start"), F.array(F.char_length("text").cast("bigint")))
    return F.array_join(F.transform(F.arrays_zip(ends.alias("low"), starts.alias("high")), lambda z: between(z["low"], z["high"])), mask)


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """The documents, with the columns they came with, and a mask in place of every reported span of the text.

    Overlapping and adjoining spans get one mask. Documents without secrets, null and empty texts are untouched; repeated
    rows are masked each.
    """
    inner, restore = shield(docs, ["text_hash", "spans", "blocks", "_d", "_h"])
    by = Window.partitionBy(*_KEY).orderBy("start", "end")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") > F.col("before"), 1).otherwise(0)).over(by.rowsBetween(Window.unboundedPreceding, 0))
    merged = spans(docs.select("doc_id", "text")).withColumn("before", before).withColumn("island", island)
    merged = merged.groupBy(*_KEY, "island").agg(F.min("start").cast("bigint").alias("start"), F.max("end").cast("bigint").alias("end"))
    found = merged.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")).withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"})
    found = settle(found)
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    joined = inner.withColumn("text_hash", F.xxhash64("text")).join(found, inner["doc_id"].eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")
    cut = F.when(F.col("spans").isNotNull(), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    return restore(joined.withColumn("blocks", cut).withColumn("text", F.when(F.col("spans").isNull(), F.col("text")).otherwise(_masked(mask))))
