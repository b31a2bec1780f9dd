"""Sharding by a hierarchical weighted hash tree.

A shard is found by descending region, rack and shard level. At each node every child of
weight w draws -ln(u) / w with u hashed from the row's key and the child's name, and the
least draw wins: children win in proportion to their weights, and a draw depends on nothing
but the key, the child and its weight. A changed weight therefore moves rows only into (or
out of) the subtrees whose weights change.

``grown`` adds a shard as a region of its own, beside the existing ones: no existing node
changes its weight, so the only rows that move are those the new shard wins. This makes
key and shard count decide (law ``key``).

Shards are numbered without gaps inside: rows carry their scan partition and place, windows
run over (shard, scan partition), whose size a task bounds, and the counts per (shard, scan
partition), a row for each, give the offsets.

Defined results: a null key draws like any other value; rows that repeat a key share its
shard and get slots of their own; a null text has size 1 and the CRC-32 of no bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, field as member

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import Scratch


@dataclass(frozen=True)
class Node:
    """A region, a rack or a shard (which has a number and no children)."""

    name: str
    weight: float = 1.0
    shard: int | None = None
    children: tuple["Node", ...] = member(default=())

    @property
    def total(self) -> float:
        return self.weight if self.shard is not None else sum(c.total for c in self.children)


def default_tree(shards: int, racks: int = 2, per_rack: int = 2, start: int = 16) -> Node:
    """The first ``start`` shards fill regions of racks; each later one is ``grown``."""
    first, regions = min(shards, start), []
    size = racks * per_rack
    for a in range(0, first, size):
        mine = range(a, min(first, a + size))
        region = [tuple(Node(f"s{i}", 1.0, i) for i in mine[r * per_rack:(r + 1) * per_rack]) for r in range(racks)]
        regions.append(Node(f"region{a // size}", children=tuple(Node(f"region{a // size}/rack{r}", children=c) for r, c in enumerate(region) if c)))
    tree = Node("root", children=tuple(regions))
    for i in range(first, shards):
        tree = grown(tree, i)
    return tree


def grown(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own."""
    leaf = Node(f"s{shard}", weight, shard)
    region = Node(f"region-s{shard}", children=(Node(f"region-s{shard}/rack0", children=(leaf,)),))
    return Node(tree.name, children=(*tree.children, region))


def _draw(key: Column, node: Node) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(node.name), key), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.ln(u) / F.lit(float(node.total))


def place(key: Column, node: Node) -> Column:
    """The shard that ``key`` descends to; nodes without weight never win."""
    if node.shard is not None:
        return F.lit(node.shard)
    kids = [c for c in node.children if c.total > 0]
    if not kids:
        raise ValueError(f"{node.name} has no weight")
    if len(kids) == 1:
        return place(key, kids[0])
    names = F.array(*[F.struct(_draw(key, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(kids)])
    won = F.array_min(names)["i"]
    out = F.when(won == 0, place(key, kids[0]))
    for i, c in enumerate(kids[1:], 1):
        out = out.when(won == i, place(key, c))
    return out


def assign(docs: DataFrame, tree: Node, more: Node | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, size, text_crc32, shard, slot and, for a tree ``more``, the shard there."""
    key = F.col(f"`{id_col}`")
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(
        key.alias("id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        place(key, tree).cast("int").alias("shard"), (place(key, more) if more else F.lit(None)).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"),
    )
    rows = Scratch(docs.sparkSession, "shards").write(rows, "rows")  # part and seq are facts from here on
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("shard", "part", before.cast("long").alias("offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("seq")) - 1
    return rows.withColumn("inside", inside).join(offsets, ["shard", "part"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("offset") + F.col("inside")).cast("long").alias("slot"), "grown_shard",
    )
