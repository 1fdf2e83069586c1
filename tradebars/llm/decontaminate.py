"""Benchmark decontamination by canonical template windows with consistent slots.

Words are canonicalised: numbers, units after numbers and names (capitalised words inside a sentence) become typed
placeholders, the rest is lower-cased. Each window of `WINDOW` words is hashed twice: as it reads, and, where it holds
placeholders, as a template. Where slots are dense, templates are longer: from a literal word on until they hold `LITERALS`
words that are no placeholders. Windows of documents are hash-joined with those of the benchmark items. Where a template
joins, the values in its slots are compared: along one alignment of a document with an item, each value of the item must
stand for one value of the document throughout. So a question with other numbers or names is found, and a text that merely
has its shape is not. Where the values of an alignment are inconsistent, its templates count for nothing; windows that read
the same count always.

Windows that many items share, such as a preamble or a question asked with many numbers, are judged beside others of the
item where a document has such. Where it has none, they are judged by `_by_classes` (with `shared`): items that these windows
don't tell apart are one class and give one row a document, so nothing is lost and a shared preamble doesn't multiply.

An item leaks into a document when `LEAST` of its windows join (all, if it has fewer, or as many as a copy with other values
throughout can join by, if these are fewer); `kind` is exact where no slot of these differs, else reparameterised. Items of
fewer than `WINDOW` words are one window of their own length; those of fewer than `SHORTEST` are not searched for.

Defined results: null and empty texts match nothing; a template needs `LITERALS` words that are no placeholders, so an
item with fewer is found where a window reads the same (one of `LITERALS` words at most may have one slot); repeated rows, and rows of one doc_id and text, are one; rows with a null doc_id are told apart by their text; repeated
items each match; empty tables give an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebars.llm import _bytes as B
from tradebars.llm._tables import settle, shield

WINDOW, LITERALS, LEAST, SHORTEST = 8, 5, 3, 4
#: Benchmark windows up to which documents are screened by a broadcast table of their hashes (8 bytes each) before the join.
SCREENED = 2_000_000
BROADCAST_ROWS = 500_000
#: Texts of items that may share a window which joins each of them by itself; beyond, it joins their classes.
COMMON = 8

#: Number words and units, in lower case.
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half"
UNITS = "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms kilometer kilometers meter meters ton tons lb lbs oz pound pounds ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years usd eur dollar dollars euro euros cent cents percent degrees watt watts kw volt volts hz mph kmh"

U = np.uint64
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
#: Bytes of a character by its first byte.
_SIZE = np.ones(256, np.int64)
_SIZE[192:224], _SIZE[224:240], _SIZE[240:] = 2, 3, 4
_POINT = np.zeros(256, bool)
_POINT[[44, 46]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:\n")] = True
#: What a placeholder hashes as, by class.
_PLACEHOLDER = B.mix(np.arange(4, dtype=U) + U(7001))
NUMBER, UNIT, NAME = 1, 2, 3


def _hash_words(words: str) -> np.ndarray:
    column = pa.array([words])
    texts = B.Texts(column)
    return np.sort(texts.hashes(*texts.spans(B.SPACE)))


_NUMBER_WORDS, _UNIT_WORDS = _hash_words(NUMBERS), _hash_words(UNITS)


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return known[at] == hashes


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words: letters, or digits with points and commas among them."""
    digit = _DIGIT[data]
    inside = digit | _ALPHA[data]
    inside[1:-1] |= _POINT[data[1:-1]] & digit[:-2] & digit[2:]
    joined = inside[:-1] & inside[1:] & ~(digit[:-1] & _ALPHA[data[1:]])  # a letter after a digit begins a word
    return np.flatnonzero(inside[1:] & ~joined) + 1, np.flatnonzero(inside[:-1] & ~joined) + 1


class Canonical:
    """The words of a column's texts: hash of the lower-case word, class (0: literal) and text."""

    def __init__(self, column: pa.Array):
        cased = B.Texts(column)
        data, n = cased.data, len(cased.data)
        digit = _DIGIT[data]
        self.starts, ends = _spans(data)
        # Lower-casing changes the length of some characters, but neither the number nor the order of words.
        lowered = B.Texts(pa.array([t and t.lower() for t in column.to_pylist()], pa.string()))
        low_starts, low_ends = _spans(lowered.data)
        self.hashes = lowered.hashes(low_starts, low_ends)
        self.owners = cased.owner(self.starts)
        count = len(self.starts)
        self.kinds = np.zeros(count, np.int8)
        if not count:
            return
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        previous = np.concatenate([[0], ends[:-1]])
        inner = stops[self.starts] == stops[previous]
        # A name's first character is an upper-case letter of any alphabet, which lower-casing changes, and its second is none.
        second, low_second = self.starts + _SIZE[data[self.starts]], low_starts + _SIZE[lowered.data[low_starts]]
        name = inner & (second < ends) & (low_second < low_ends)
        changed = cased.hashes(self.starts, np.minimum(second, ends)) != lowered.hashes(low_starts, np.minimum(low_second, low_ends))
        third, low_third = np.minimum(second + _SIZE[data[np.minimum(second, n - 1)]], ends), np.minimum(low_second + _SIZE[lowered.data[np.minimum(low_second, len(lowered.data) - 1)]], low_ends)
        name &= changed & (cased.hashes(np.minimum(second, ends), third) == lowered.hashes(np.minimum(low_second, low_ends), low_third)) & _ALPHA[data[np.minimum(second, n - 1)]]
        number = digit[self.starts] | _among(self.hashes, _NUMBER_WORDS)
        unit = np.zeros(count, bool)
        unit[1:] = number[:-1] & (self.owners[1:] == self.owners[:-1])
        unit &= _among(self.hashes, _UNIT_WORDS) & ~number
        self.kinds[name], self.kinds[unit], self.kinds[number] = NAME, UNIT, NUMBER

    def windows(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
        """(hashes, places of the first words, places after the last ones, whether templates) of the literal windows, of the
        template windows, and of those that are longer than `size`."""
        hashes, at = B.windows(self.hashes, self.owners, size)
        yield hashes, at, at + size, False
        held = self._held(at, size)
        template = np.where(self.kinds > 0, _PLACEHOLDER[self.kinds], self.hashes)
        hashes, at = B.windows(template, self.owners, size)
        fit = (held > 0) & (size - held >= min(LITERALS, size - 1))
        yield B.mix(hashes[fit] + U(1)), at[fit], at[fit] + size, True
        if size == WINDOW:
            at, ends = self._dense()
            up, down = B._powers_upto(len(template) + 1)
            sums = np.concatenate([np.zeros(1, U), np.cumsum(B.mix(template) * up[: len(template)], dtype=U)])
            yield B.mix((sums[ends] - sums[at]) * down[at] + (ends - at).astype(U)), at, ends, True

    def _held(self, at: np.ndarray, size: int) -> np.ndarray:
        """Slots in the windows."""
        slots = np.concatenate([[0], np.cumsum(self.kinds > 0)])
        return slots[at + size] - slots[at]

    def _dense(self) -> tuple[np.ndarray, np.ndarray]:
        """First words and ends of the runs from a literal word to the `LITERALS`-th that are longer than `WINDOW`.

        Each slot lies in fewer than `LITERALS` of them, however many stand in a row.
        """
        literal = np.flatnonzero(self.kinds == 0)
        at, ends = literal[: max(0, len(literal) - LITERALS + 1)], literal[LITERALS - 1 :] + 1
        dense = (self.owners[at] == self.owners[ends - 1]) & (ends - at > WINDOW)
        return at[dense], ends[dense]

    def open_windows(self, rows: int) -> np.ndarray:
        """For each text, the windows by which a copy with other values throughout joins."""
        _, at = B.windows(self.hashes, self.owners, WINDOW)
        at = np.concatenate([at[WINDOW - self._held(at, WINDOW) >= LITERALS], self._dense()[0]])
        return np.bincount(self.owners[at], minlength=rows)


_FIELDS = "window bigint, place int, template boolean, slots array<bigint>"


def _windows(table: DataFrame, text: str, names: list[str], sizes: list[int], screen=None) -> DataFrame:
    """The columns in `names`, n_windows of the size of each text, and its windows (those of the screen only)."""

    @B.lean
    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = screen.value if screen is not None else None
        flags = None
        if known is not None:
            flags = np.zeros(1 << 22, bool)
            flags[(known >> U(42)).astype(np.int64)] = True
        for batch in it:
            for part in B.chunks(batch, text):
                words = Canonical(part.column(part.schema.get_field_index(text)))
                first = np.searchsorted(words.owners, np.arange(part.num_rows))
                for size in sizes:
                    for hashes, at, ends, template in words.windows(size):
                        if flags is not None:
                            maybe = np.flatnonzero(flags[(hashes >> U(42)).astype(np.int64)])
                            maybe = maybe[_among(hashes[maybe], known)] if len(known) else maybe[:0]
                            hashes, at, ends = hashes[maybe], at[maybe], ends[maybe]
                        owner = words.owners[at]
                        slots = [words.hashes[a:b][words.kinds[a:b] > 0].view(np.int64) if template else [] for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
                        rows = part.take(pa.array(owner))
                        yield pa.RecordBatch.from_arrays(
                            [rows.column(rows.schema.get_field_index(c)) for c in names]
                            + [pa.array(hashes.view(np.int64)), pa.array((at - first[owner]).astype(np.int32)), pa.array(np.full(len(at), template)), pa.array(slots, pa.list_(pa.int64()))],
                            names=[*names, "window", "place", "template", "slots"],
                        )

    schema = ", ".join([f"`{c}` {table.schema[c].dataType.simpleString()}" for c in names] + [_FIELDS])
    return table.select(*names, text).mapInArrow(cut, schema)


def _sized(benchmark: DataFrame) -> DataFrame:
    """The items (key, item_id, text, n_words, n_open: windows by which a copy with other values throughout joins)."""

    @B.lean
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            words = Canonical(batch.column(1))
            n = [np.bincount(words.owners, minlength=batch.num_rows), words.open_windows(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x.astype(np.int32)) for x in n]], names=["item_id", "text", "n_words", "n_open"])

    items = benchmark.select("item_id", "text").where("text is not null").distinct().mapInArrow(count, "item_id bigint, text string, n_words int, n_open int")
    return items.where(f"n_words >= {SHORTEST}").withColumns({"item_key": F.xxhash64("item_id", "text"), "item_hash": F.xxhash64("text")})


def _told(wanted: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The items' windows that join by themselves, and those that more than `COMMON` texts of items hold and whose items have
    others, or None where there are no such."""
    sizes = wanted.groupBy("window").agg(F.count_distinct("item_hash").alias("n")).where(F.col("n") > COMMON).select("window", F.lit(True).alias("common"))
    told = wanted.join(sizes, "window", "left").withColumn("common", F.coalesce("common", F.lit(False)))
    only = told.groupBy("item_key").agg(F.every("common").alias("only"))
    told = settle(told.join(only, "item_key").drop("item_hash"))
    own, common = told.where("only or not common").drop("common", "only"), told.where("common and not only").drop("common", "only")
    return own, None if common.isEmpty() else common


def _own_pairs(met: DataFrame) -> DataFrame:
    return met.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "item_key").distinct()


def _met(hits: DataFrame, own: DataFrame, common: DataFrame | None, small: bool) -> DataFrame:
    """The hits with the items' windows: common ones join where a document has another window of the item too, so that they
    don't multiply. What they join beyond is for `_by_classes`."""
    met = settle(hits.join(F.broadcast(own) if small else own, "window"))
    if common is None:
        return met
    near = hits.join(_own_pairs(met), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h"))).drop("_d", "_h")
    return settle(met.unionByName(near.join(F.broadcast(common) if small else common, ["window", "item_key"])))


#: How many windows of an item make a leak.
_ENOUGH = f"least({LEAST}, n_windows, if(n_open > 0, n_open, null))"


def _judged(met: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, item_key, n_matched, n_windows, kind) of the leaks among the joined windows; a window that
    isn't `told` is not exact, whatever its values."""
    by = ["doc_id", "text_hash", "item_id", "item_key", "n_windows", "n_open", "align"]
    met = met.withColumn("align", F.col("place") - F.col("item_place")).select(*by, "item_place", "template", "told", F.arrays_zip(F.col("item_slots").alias("theirs"), F.col("slots").alias("ours")).alias("slots"))
    values = met.select(*by, F.explode("slots").alias("s")).select(*by, "s.*")
    values = values.groupBy(*by, "theirs").agg(F.min("ours").alias("low"), F.max("ours").alias("high"))
    slots = values.groupBy(*by).agg(F.every(F.col("low") == F.col("high")).alias("consistent"), F.every((F.col("low") == F.col("theirs")) & (F.col("high") == F.col("theirs"))).alias("same"))
    places = met.groupBy(*by).agg(*[F.collect_set(F.when(F.col("template") == t, F.col("item_place"))).alias(name) for name, t in (("verbatim", False), ("templates", True))], F.every("told").alias("told"))
    same_key = F.expr("p.doc_id <=> s.doc_id and p.text_hash <=> s.text_hash and p.item_key = s.item_key and p.align = s.align")
    joined = places.alias("p").join(slots.alias("s"), same_key, "left").select("p.*", F.coalesce("consistent", F.lit(True)).alias("consistent"), F.coalesce("same", F.lit(True)).alias("same"))
    # What is left of an inconsistent alignment reads the same, so no slot of it differs.
    joined = joined.withColumns({"places": F.when(F.col("consistent"), F.array_union("verbatim", "templates")).otherwise(F.col("verbatim")), "same": F.col("same") & F.col("told") | ~F.col("consistent")})
    by.remove("align")
    found = joined.where(F.size("places") > 0).groupBy(*by).agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("bigint").alias("n_matched"), F.every("same").alias("same"))
    return found.where(F.col("n_matched") >= F.expr(_ENOUGH)).select(
        "doc_id", "text_hash", "item_id", "item_key", "n_matched", F.col("n_windows").cast("bigint").alias("n_windows"), F.when(F.col("same"), "exact").otherwise("reparameterised").alias("kind")
    )


def _classes(common: DataFrame) -> DataFrame:
    """(class_id, members array<(item_id, item_key, n_windows)>): the items that no document tells apart by common windows alone.

    Those of one class have the same common windows at the same distances, slots that are equal to each other in the same
    places, and need as many windows. So a document's alignments with them, and what is consistent there, are the same. As is the
    kind (see `_tell`).
    """
    by = ["item_key", "at", "window"]
    first = common.groupBy("item_key").agg(F.min("item_place").alias("first"))
    placed = settle(common.join(first, "item_key").withColumn("at", F.col("item_place") - F.col("first")))
    values = placed.select(*by, F.posexplode("item_slots").alias("i", "value"))
    names = values.groupBy("item_key", "value").agg(F.min(F.struct("at", "window", "i")).alias("name"))
    patterns = values.join(names, ["item_key", "value"]).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("i", "name"))).alias("pattern"))
    item = ["item_key", "item_id", "n_windows", "n_open"]
    told = placed.join(patterns, by, "left").groupBy(*item).agg(F.sort_array(F.collect_list(F.struct("at", "window", "pattern"))).alias("windows"), F.count_distinct("at").alias("places"))
    # An item with fewer common places than it needs has no leak by these alone.
    told = told.where(F.col("places") >= F.expr(_ENOUGH)).withColumn("class_id", F.xxhash64("windows", F.expr(_ENOUGH)))
    return told.groupBy("class_id").agg(F.sort_array(F.collect_list(F.struct("item_id", "item_key", F.col("n_windows").cast("bigint").alias("n_windows")))).alias("members"))


def _tell(windows: DataFrame) -> DataFrame:
    """The windows of items with `told`: whether the literal windows within a template are there too.

    If a document has a template's values as a member has them, it has the member's literal windows in it. Where these aren't
    common, it so has another window of the member; where they are, all of the class have them, with the same values.
    """
    n = F.size("item_slots")
    literal = windows.where(n == 0).select("item_key", F.col("item_place").alias("inner"), F.lit(True).alias("there"))
    inner = windows.where(n > 0).select("item_key", "window", "item_place", F.explode(F.sequence(F.col("item_place"), F.col("item_place") + F.greatest(F.lit(0), n + LITERALS - WINDOW))).alias("inner"))
    told = inner.join(literal, ["item_key", "inner"], "left").groupBy("item_key", "window", "item_place").agg(F.every(F.coalesce("there", F.lit(False))).alias("told"))
    return windows.join(told, ["item_key", "window", "item_place"], "left").withColumn("told", F.coalesce("told", F.lit(True)))


def _by_classes(hits: DataFrame, common: DataFrame, own_pairs: DataFrame, small: bool) -> DataFrame:
    """The leaks by common windows alone, into documents that have no other window of the item: (doc_id, text_hash, item_id,
    item_key, n_matched, n_windows, kind, class_id, n_items, except_keys) of documents with classes, and the classes' members."""
    classes = settle(_classes(common))
    named = classes.select("class_id", F.col("members")[0].alias("first"), F.size("members").alias("n"))
    windows = settle(_tell(common.join(named.select(F.col("first.item_key").alias("item_key")), "item_key", "left_semi")))
    found = _judged(settle(hits.join(F.broadcast(windows) if small else windows, "window"))).drop("item_id", "n_windows")
    found = found.join(named.withColumn("item_key", F.col("first.item_key")), "item_key").drop("item_key")
    # Members of which the document has other windows too are judged by all of them, so they don't count here.
    members = classes.select("class_id", F.explode("members").alias("member"))
    others = own_pairs.join(members.withColumn("item_key", F.col("member.item_key")), "item_key").groupBy("_d", "_h", F.col("class_id").alias("_c")).agg(F.collect_list("member").alias("others"))
    rest = others.join(classes, F.col("_c") == F.col("class_id")).select("_d", "_h", "_c", F.col("others.item_key").alias("except_keys"), F.array_except("members", "others").alias("rest"))
    rest = rest.select("_d", "_h", "_c", "except_keys", F.array_min("rest").alias("_first"), F.size("rest").alias("_n"))
    here = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")) & (F.col("class_id") == F.col("_c"))
    found = found.join(rest, here, "left").withColumns({"first": F.when(F.col("_c").isNull(), F.col("first")).otherwise(F.col("_first")), "n": F.coalesce("_n", "n").cast("bigint")}).where("n > 0")
    found = settle(found.select("doc_id", "text_hash", "first.item_id", "first.item_key", "n_matched", "first.n_windows", "kind", "class_id", F.col("n").alias("n_items"), "except_keys"))
    members = members.join(found.select("class_id").distinct(), "class_id", "left_semi").select("member.*", "class_id", F.lit("member").alias("kind"))
    return found.unionByName(members, allowMissingColumns=True)


def leaks(docs: DataFrame, benchmark: DataFrame, shared: bool = False) -> DataFrame:
    """(doc_id, text_hash, item_id, n_matched, n_windows, kind) of every leak but those by common windows alone.

    With `shared` these are there too, a row for each document and class of items that it can't tell apart: the row has the
    least of the items that it stands for, their number (n_items), the class (class_id) and those of the class that it doesn't
    stand for (except_keys), as they have rows of their own or don't leak. Rows of kind `member`, without a document, give the
    items (item_id, item_key) of each class that is met. `pairs` makes all pairs of them.
    """
    spark = docs.sparkSession
    items = settle(_sized(benchmark))
    short = sorted(r.n_words for r in items.where(f"n_words < {WINDOW}").select("n_words").distinct().collect())
    names = ["item_id", "item_key", "item_hash", "n_words", "n_open"]
    cut = _windows(items.where(f"n_words >= {WINDOW}"), "text", names, [WINDOW])
    for n in short:
        cut = cut.union(_windows(items.where(f"n_words = {n}"), "text", names, [n]))
    wanted = settle(cut)
    screen = None
    small = wanted.count() <= SCREENED
    if small:
        known = wanted.select("window").distinct().toArrow().column(0).to_numpy()
        screen = spark.sparkContext.broadcast(np.sort(known.astype(np.int64).view(U)))
    wanted = wanted.select("window", "item_id", "item_key", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), F.greatest(F.col("n_words") - WINDOW + 1, F.lit(1)).alias("n_windows"), "n_open", "item_hash")
    hits = _windows(docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text")), "text", ["doc_id", "text_hash"], [*short, WINDOW], screen)
    own, common = _told(wanted)
    if common is not None:
        hits = settle(hits)
    met = _met(hits, own, common, small)
    found = _judged(met.withColumn("told", F.lit(True)))
    if not shared:
        return found.drop("item_key")
    found = found.withColumns({"class_id": F.lit(None).cast("bigint"), "n_items": F.lit(1).cast("bigint"), "except_keys": F.lit(None).cast("array<bigint>")})
    return found if common is None else found.unionByName(_by_classes(hits, common, _own_pairs(met), small))


def pairs(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, item_key, n_matched, n_windows, kind) of every pair that rows of `leaks` with `shared` stand for."""
    columns = ["doc_id", "text_hash", "item_id", "item_key", "n_matched", "n_windows", "kind"]
    members = found.where("kind = 'member'").select("class_id", "item_id", "item_key", "n_windows")
    classes = found.where("kind != 'member' and class_id is not null").drop("item_id", "item_key", "n_windows").join(members, "class_id")
    classes = classes.where("except_keys is null or not array_contains(except_keys, item_key)")
    return found.where("class_id is null").select(columns).union(classes.select(columns))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents into which no item leaks, be it by common windows alone, with the columns they came with."""
    found = settle(leaks(docs, benchmark, shared=True).where("kind != 'member'").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct())
    small = found.count() <= BROADCAST_ROWS
    inner, restore = shield(docs, ["_d", "_h", "_t"])
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_h"))
    return restore(inner.withColumn("_t", F.xxhash64("text")).join(F.broadcast(found) if small else found, same, "left_anti"))
