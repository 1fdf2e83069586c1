"""Sharding by a k-d tree with distributed weighted medians: the `bytes` law, sizes near equal.

Texts that are equal are one point, so that copies share a shard. Only a group that exceeds a whole shard (`WHOLE`, a
parameter) is dealt into points of a shard's weight at most, as no balance were possible otherwise. A point has metadata
dimensions (bytes of the text, language, source, least doc_id) and a weight, its bytes. A node that is to hold k shards is
cut along its widest dimension at the weighted quantile floor(k / 2) / k of all its points, until every leaf is one shard.
The quantile is found by sums over bins, which are refined until the cut is within `TOLERANCE` of a shard: every round is
one aggregation with map-side sums for all nodes of a level.

Points of more than `LARGE` of a shard are atoms of the quantile: the driver holds them (less than shards / `LARGE`), each
goes to the side of the cut that it lies on, and the cut of the other points moves until both sides have their share. Where
the atoms of a side can't be packed into its shards, within `SLACK` of a shard, or parts of one text would share a shard, the
nearest cut between atoms that allows it is taken; where there is none, as in nodes of two or three shards that hold little
else, the sides take the atoms as the packing has them. Only bins come to the driver besides, at most `BINS` for each shard.

Defined results: a null text has no bytes, size 8 and checksum 0, and is equal to other nulls; null languages, sources and
ids sort first; repeated rows get slots of their own; ties are told apart by the text's hash, so they don't depend on how
rows are dealt out; with fewer points than shards, or an empty table, some shards stay empty; rows of one text and doc_id
stay together even beyond a shard; other columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tradebars.llm._tables import settle

BINS = 4096
#: Shards' worth of equal texts up to which they stay in one shard.
WHOLE = 1.0
#: Shard's worth from which on a point is an atom, known to the driver.
LARGE = 1 / 20
#: Shard's worth that a cut between atoms may cost a shard.
SLACK = 1 / 50
TOLERANCE = 1 / 4000
#: Lots for each shard that the copies of a text are dealt into by doc_id, before anything is shuffled by text.
LOTS = 48
#: Rows that one task numbers about.
NUMBERED = 2000
#: Bits of a dimension's value; the rest of 62 tell points of one value apart.
_BITS = {"k_bytes": 24, "k_lang": 12, "k_source": 12, "k_id": 31}
_TEXT = ["text_hash", "text_crc32"]
_DIMENSIONS = ("k_bytes", "k_lang", "k_source", "k_id")


@dataclass
class Node:
    """A box of the tree that is to hold `shards` shards from `first` on, and the large points in it."""

    first: int
    shards: int
    large: list[Row] = field(default_factory=list)
    dimension: str = ""
    cut: int = 0
    sides: list[Node] = field(default_factory=list)

    def leaves(self) -> list[Node]:
        return [n for s in self.sides for n in s.leaves()] if self.sides else [self]

    def number(self) -> Column:
        """The first shard of the leaf that a point, not a large one, is in."""
        if not self.sides:
            return F.lit(self.first)
        return F.when(F.col(self.dimension) < self.cut, self.sides[0].number()).otherwise(self.sides[1].number())


def _rows(docs: DataFrame, lots: int) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "lang", "source", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64("text").alias("text_hash"), F.pmod(F.xxhash64("doc_id"), F.lit(lots)).alias("lot"))


def _key(value: Column, tie: Column, bits: int) -> Column:
    """An order of 62 bits: the value's bits, then a hash that tells points apart."""
    return F.shiftleft(F.greatest(F.lit(0), F.least(value, F.lit(2**bits - 1))).cast("bigint"), 62 - bits) + F.pmod(tie, F.lit(1 << (62 - bits)))


def _lots(rows: DataFrame) -> DataFrame:
    """(text_hash, text_crc32, lot) with sums and least values: of a text's copies, as many rows as lots go on at most."""
    name = lambda c: F.min(c).alias(c)
    return rows.groupBy(*_TEXT, "lot").agg(F.sum("size").alias("weight"), F.count("*").alias("copies"), name("size"), name("lang"), name("source"), F.min("doc_id").alias("id"))


def _points(lots: DataFrame, most: float, low: int, high: int) -> tuple[DataFrame, DataFrame]:
    """The point (text_hash, text_crc32, part) of each lot, and the points with their dimensions and weight, `most` about."""
    # A text has as many rows here as there are lots at most, so these windows are short; parts are stretches of lots of like weight.
    text = Window.partitionBy(*_TEXT)
    total, upto = F.sum("weight").over(text), F.sum("weight").over(text.orderBy("lot").rowsBetween(Window.unboundedPreceding, 0))
    parts = F.greatest(F.lit(1), F.least(F.ceil(F.col("total") / most), F.col("copies"))).cast("bigint")
    part = F.least(F.floor((F.col("upto") - F.col("weight") / 2) * F.col("parts") / F.col("total")).cast("bigint"), F.col("parts") - 1)
    summed = lots.withColumns({"total": total, "upto": upto, "copies": F.sum("copies").over(text)}).withColumn("parts", parts)
    dealt = settle(summed.withColumn("part", part).drop("total", "upto", "copies", "parts"))
    by = [*_TEXT, "part"]
    points = dealt.groupBy(*by).agg(F.sum("weight").alias("weight"), F.min("size").alias("bytes"), F.min("lang").alias("lang"), F.min("source").alias("source"), F.min("id").alias("id"))
    tie = F.xxhash64("text_hash", "part")
    name = lambda c, k: F.coalesce(1 + F.pmod(F.crc32(c), F.lit(2 ** _BITS[k] - 1)), F.lit(0))
    share = (F.coalesce("id", F.lit(low)) - F.lit(low)) / F.lit(float(max(1, high - low)))
    values = {"k_bytes": F.floor(F.log2("bytes") * 2.0**18), "k_lang": name("lang", "k_lang"), "k_source": name("source", "k_source"), "k_id": F.floor(share * (2.0 ** _BITS["k_id"] - 1))}
    return dealt.select(*by, "lot"), points.select(*by, "weight", *[_key(v, tie, _BITS[k]).alias(k) for k, v in values.items()])


def _packed(large: list[Row], shards: int) -> list[list[Row]]:
    """The heaviest first, each on the shard that holds least."""
    packs: list[list[Row]] = [[] for _ in range(shards)]
    heap = [(0, k) for k in range(shards)]
    for r in sorted(large, key=lambda r: (-r.weight, r.text_hash, r.part)):
        load, k = heap[0]
        packs[k].append(r)
        heapq.heapreplace(heap, (load + r.weight, k))
    return packs


def _loads(packs: list[list[Row]]) -> list[int]:
    return [sum(r.weight for r in p) for p in packs]


def _share(left: list[int], right: list[int], total: float) -> float:
    """What the left side is to hold of the total, if every shard is filled to one level but for those whose load exceeds it."""
    level, rest, loads = 0.0, total, sorted(left + right, reverse=True)
    for i, load in enumerate(loads):
        level = rest / (len(loads) - i)
        if load <= level:
            break
        rest -= load
    return sum(max(level, load) for load in left)


def _sides(node: Node, total: float, room: float) -> tuple[list[Row], list[Row]]:
    """The large points of both sides: those below the cut and the others, or as near to that as they can be packed."""
    left, right = node.shards // 2, node.shards - node.shards // 2
    order = sorted(node.large, key=lambda r: (r[node.dimension], r.text_hash, r.part))
    at = sum(r[node.dimension] < node.cut for r in order)
    packs = _packed(order, node.shards)
    most = max((1 + SLACK) * room, total / node.shards, *_loads(packs))
    parts = Counter(r.text_hash for r in order)
    spread = lambda rs, k: all(n <= k * -(-parts[t] // node.shards) for t, n in Counter(r.text_hash for r in rs).items())
    for i in sorted(range(len(order) + 1), key=lambda i: (abs(i - at), i)):
        if spread(order[:i], left) and spread(order[i:], right) and max(_loads(_packed(order[:i], left)) + _loads(_packed(order[i:], right))) <= most:
            return order[:i], order[i:]
    return [r for p in packs[:left] for r in p], [r for p in packs[left:] for r in p]


def _search(placed: DataFrame, search: dict[int, list], nodes: dict[int, Node], atoms: bool, room: float) -> None:
    """Set each node's cut; `search` holds low edge, width of a bin, weight below the low edge and weight wanted below the cut."""
    while search:
        value = F.lit(None).cast("bigint")
        for first, (low, width, *_) in search.items():
            x = F.col(nodes[first].dimension)
            inside = (F.col("node") == first) & (x >= low) & (x < low + width * BINS)
            value = F.when(inside, F.expr(f"({nodes[first].dimension} - {low}L) div {width}L")).otherwise(value)
        sums = placed.select("node", "weight", value.alias("bin")).where("bin is not null").groupBy("node", "bin").agg(F.sum("weight").alias("weight"))
        bins: dict[int, dict[int, int]] = {first: {} for first in search}
        for r in sums.collect():
            bins[r.node][r.bin] = r.weight
        for first in list(search):
            low, width, below, wanted = search[first]
            node, every = nodes[first], dict(bins[first])
            for r in node.large if atoms else []:
                if low <= (x := r[node.dimension]) < low + width * BINS:
                    every[(x - low) // width] = every.get((x - low) // width, 0) + r.weight
            at, weight = 0, 0
            for at, weight in sorted(every.items()):
                if below + weight >= wanted:
                    break
                below += weight
            near = min(wanted - below, below + weight - wanted)
            if width == 1 or near <= TOLERANCE * room or (atoms and bins[first].get(at, 0) <= TOLERANCE * room):
                node.cut = low + (at + (below + weight - wanted < wanted - below)) * width
                del search[first]
            else:
                search[first] = [low + at * width, -(-width // BINS), below, wanted]


def _cuts(points: DataFrame, root: Node, room: float) -> bool:
    """Split every leaf of several shards once; False when there was none."""
    nodes = {n.first: n for n in root.leaves() if n.shards > 1}
    if not nodes:
        return False
    placed = points.withColumn("node", root.number()).where(F.col("node").isin(list(nodes)))
    found = {r.node: r for r in placed.groupBy("node").agg(F.sum("weight").alias("weight"), *[f(k).alias(f"{n}_{k}") for k in _DIMENSIONS for n, f in (("min", F.min), ("max", F.max))]).collect()}
    ranges, weights = {}, {}
    for first, node in nodes.items():
        r = found.get(first)
        weights[first] = r.weight if r else 0
        values = {k: [x[k] for x in node.large] + ([r[f"min_{k}"], r[f"max_{k}"]] if r else []) for k in _DIMENSIONS}
        if values[_DIMENSIONS[0]]:
            ranges[first] = {k: (min(v), max(v)) for k, v in values.items()}
    whole = {k: max((r[k][1] for r in ranges.values()), default=0) - min((r[k][0] for r in ranges.values()), default=0) for k in _DIMENSIONS}
    edges: dict[int, tuple[int, int]] = {}
    search = {}
    for first, node in nodes.items():
        node.dimension = _DIMENSIONS[0]
        if r := ranges.get(first):
            node.dimension = max(_DIMENSIONS, key=lambda k: (r[k][1] - r[k][0]) / max(1, whole[k]))
            low, high = r[node.dimension]
            edges[first] = (low, -(-(high + 1 - low) // BINS))
            total = weights[first] + sum(x.weight for x in node.large)
            search[first] = [*edges[first], 0, total * (node.shards // 2 / node.shards)]
    _search(placed, search, nodes, True, room)
    again, large = {}, {}
    for first, node in nodes.items():
        large[first] = ([], [])
        if node.large:
            total = weights[first] + sum(x.weight for x in node.large)
            large[first] = _sides(node, total, room)
            loads = [_loads(_packed(x, k)) for x, k in zip(large[first], (node.shards // 2, node.shards - node.shards // 2), strict=True)]
            if weights[first]:
                again[first] = [*edges[first], 0, min(weights[first], max(0.0, _share(*loads, total) - sum(loads[0])))]
    _search(placed, again, nodes, False, room)
    for first, node in nodes.items():
        left = node.shards // 2
        node.sides = [Node(first, left, large[first][0]), Node(first + left, node.shards - left, large[first][1])]
    return True


def assign(docs: DataFrame, shards: int = 24, whole: float = WHOLE) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; equal texts up to `whole` shards' bytes stay together."""
    rows = _rows(docs, LOTS * shards)
    sums = rows.agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    room = max(1.0, (sums["size"] or 0) / shards)
    dealt, points = _points(settle(_lots(rows)), whole * room, sums.low or 0, sums.high or 0)
    points = settle(points)
    large = points.where(F.col("weight") > LARGE * room).select("text_hash", "part", "weight", *_DIMENSIONS).collect()
    small = points.where(F.col("weight") <= LARGE * room)
    root = Node(0, shards, large)
    while _cuts(small, root, room):
        pass
    numbers = small.select(*_TEXT, "part", root.number().alias("shard"))
    if large:
        held = docs.sparkSession.createDataFrame([(r.text_hash, r.part, n.first) for n in root.leaves() for r in n.large], "text_hash bigint, part bigint, shard int")
        numbers = numbers.union(points.join(F.broadcast(held), ["text_hash", "part"]).select(*_TEXT, "part", "shard"))
    numbers = dealt.join(numbers, [*_TEXT, "part"]).drop("part")
    placed = rows.select("doc_id", "size", *_TEXT, "lot").join(numbers, [*_TEXT, "lot"]).drop("lot")
    stretches = max(1, math.ceil(sums.n / shards / NUMBERED))
    placed = settle(placed.withColumn("stretch", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(stretches))))
    sizes = placed.groupBy("shard", "stretch").agg(F.count("*").alias("n"))
    offsets = sizes.select("shard", "stretch", (F.sum("n").over(Window.partitionBy("shard").orderBy("stretch")) - F.col("n")).alias("offset"))
    within = F.row_number().over(Window.partitionBy("shard", "stretch").orderBy("doc_id", "text_hash"))
    return placed.withColumn("place", within).join(offsets, ["shard", "stretch"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("offset") + F.col("place") - 1).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def write(docs: DataFrame, path: str, shards: int = 24) -> DataFrame:
    """Write the documents as Parquet, one folder a shard (`shard=n`), and return the assignment.

    Rows of one doc_id and text that fall into several slots are written once each.
    """
    placed = settle(assign(docs, shards))
    key = placed.groupBy("doc_id", "text_crc32", "size").agg(F.min("shard").alias("shard")).withColumnsRenamed({"doc_id": "_d", "text_crc32": "_c", "size": "_s"})
    text = F.coalesce("text", F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.crc32(text) == F.col("_c")) & (F.octet_length(text) + 8 == F.col("_s"))
    docs.join(key, same).drop("_d", "_c", "_s").repartition("shard", F.pmod(F.xxhash64("doc_id"), F.lit(8))).write.partitionBy("shard").parquet(path)
    return placed
