"""Sharding by a hierarchical weighted hash tree.

A tree has regions, racks and shards.  A key descends level by level: each
child draws ``-ln(u) / weight`` from a hash u of (key, child), and the least
draw wins, so a child receives a share equal to its weight.  Draws of
different children are independent of each other: changing a weight moves keys
only into, or only out of, the subtree whose weight changes.  ``grow`` adds
one shard as a region of its own, so it moves keys into the new shard alone,
however often it is repeated.

All of it is one Spark expression; the slot of a row in its shard comes from
two-pass prefix sums (rows per task and shard, then the tasks' offsets), so no
task holds a shard.

Defined cases: a null text has size 8 and checksum 0; null ids hash alike and
so share a shard; repeated rows each get a slot; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import prefix_offsets, read_table, without


@dataclass(frozen=True)
class Node:
    """A subtree: its name (unique in the tree), and children or a leaf's shard number and weight."""

    name: int
    children: tuple[Node, ...] = ()
    shard: int = -1
    leaf_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.leaf_weight

    @property
    def leaves(self) -> int:
        return sum(c.leaves for c in self.children) if self.children else 1


def even_tree(regions: int = 2, racks: int = 3, shards: int = 4) -> Node:
    """regions x racks x shards leaves of equal weight."""
    per = racks * shards
    return Node(0, tuple(
        Node(1_000_000 + r, tuple(
            Node(2_000_000 + r * racks + k, tuple(
                Node(3_000_000 + s, shard=s) for s in range(r * per + k * shards, r * per + (k + 1) * shards)))
            for k in range(racks)))
        for r in range(regions)))


def grow(tree: Node, weight: float = 1.0) -> Node:
    """``tree`` with one more shard, as a region of its own."""
    s = tree.leaves
    rack = Node(2_500_000 + s, (Node(3_000_000 + s, shard=s, leaf_weight=weight),))
    return Node(tree.name, (*tree.children, Node(1_500_000 + s, (rack,))))


def _draw(key: Column, node: Node) -> Column:
    """An exponential draw of rate ``weight``: least among siblings with probability weight / total."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11)
    u = (bits.cast("double") + F.lit(0.5)) * F.lit(2.0 ** -53)
    return -F.log(u) / F.lit(float(node.weight))


def shard_of(key: Column, tree: Node) -> Column:
    """The shard (int) that ``key`` descends to."""
    live = [c for c in tree.children if c.weight > 0]
    if not tree.children:
        return F.lit(tree.shard)
    if len(live) == 1:
        return shard_of(key, live[0])
    draws = [F.struct(_draw(key, c).alias("draw"), F.lit(k).alias("child")) for k, c in enumerate(live)]
    won = F.least(*draws)["child"]
    if all(not c.children for c in live):
        return F.element_at(F.array(*[F.lit(c.shard) for c in live]), won + 1)
    out = F.when(won == 0, shard_of(key, live[0]))
    for k, c in enumerate(live[1:], 1):
        out = out.when(won == k, shard_of(key, c))
    return out


def assign(docs: DataFrame, tree: Node, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    key, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    order = F.monotonically_increasing_id()
    rows = docs.select(
        key.alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(key, tree).cast("int").alias("shard"),
        shard_of(key, grow(tree)).cast("int").alias("grown_shard"), order.alias("__at"))
    rows = materialize(rows, "shards").withColumn("__part", F.shiftright("__at", 33))
    totals = rows.groupBy("shard", "__part").agg(F.count(F.lit(1)).alias("__rows"))
    bases = without(prefix_offsets(totals, "__part", "__rows", "__base_slot", keys=("shard",)), ["__rows"])
    inside = Window.partitionBy("__part", "shard").orderBy("__at")
    return (rows.withColumn("__in", F.row_number().over(inside) - 1).join(bases, ["shard", "__part"])
            .select("doc_id", "size", "text_crc32", "law", "shard", (F.col("__base_slot") + F.col("__in")).alias("slot"), "grown_shard"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(read_table(spark, sf_dir, "documents"), even_tree())
