"""Sharding by a hierarchical weighted hash tree.

A tree has regions, racks in regions and shards in racks; every shard has a weight, and a rack
or region weighs as much as its shards.  A row descends from the root: at each level every
child draws a keyed uniform from (node, key), and the child with the largest ``ln(u) / weight``
wins, which happens with a probability in proportion to its weight.  A child's draw depends on
that child alone, so when weights change, rows leave only children whose weight fell and enter
only children whose weight rose; the draws inside an unchanged subtree give what they gave.

Growth by one shard (:func:`grown`) adds a region with one rack and one shard.  No other weight
changes, so a row either stays or enters the new shard.

The draws are built-in expressions and a tree is a handful of nodes, so placing rows is one
projection without a shuffle.  Slots number the rows of a shard without gaps: rows are counted
per (shard, hash bucket) first, so neither a large shard nor a hot key is ordered in one task.

Nulls: a null id is a key of its own; a null text has size 8 and the checksum of no bytes.
Empty and very long texts only differ in size.  Repeated rows get the same shard and different
slots; rows alike in all that orders them tie, and any of them may have either slot.  Children whose
draws tie go by their place in the tree, the later first.  An empty table gives no rows.  Other columns are carried along by :func:`placed`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import n_buckets, running_offsets


@dataclass(frozen=True)
class Node:
    name: str
    children: tuple[Node, ...] = ()
    own_weight: float = 1.0
    shard: int = -1

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(regions: int = 2, racks: int = 3, shards: int = 4,
         weights: dict[int, float] | None = None) -> Node:
    """A regular tree of ``regions * racks * shards`` shards, numbered in order."""
    weights = weights or {}
    def rack(g, r):
        first = (g * racks + r) * shards
        return Node(f"g{g}r{r}", tuple(Node(f"s{i}", (), weights.get(i, 1.0), i)
                                       for i in range(first, first + shards)))
    return Node("root", tuple(Node(f"g{g}", tuple(rack(g, r) for r in range(racks)))
                              for g in range(regions)))


def shard_ids(root: Node) -> list[int]:
    return [root.shard] if not root.children else [i for c in root.children for i in shard_ids(c)]


def grown(root: Node, weight: float = 1.0) -> Node:
    """``root`` with one more shard, which is a region of its own."""
    n = max(shard_ids(root)) + 1
    leaf = Node(f"s{n}", (), weight, n)
    return Node(root.name, (*root.children, Node(f"g+{n}", (Node(f"g+{n}r0", (leaf,)),))))


def _draw(node: Node, key: Column, seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(f"{seed}/{node.name}"), key), 11)
    return F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(node.weight)


def placed(docs: DataFrame, root: Node, key: str, out: str = "shard", seed: int = 0) -> DataFrame:
    """``docs`` with the shard that ``key`` descends to; one projection per level of the tree."""
    d, level, depth = docs.withColumn("_at0", F.lit(0)), [root], 0
    while any(n.children for n in level):
        below, step = [], F
        for i, node in enumerate(level):
            first = len(below)
            below += [c for c in node.children if c.weight > 0] or [node]
            draws = [F.struct(_draw(c, F.col(key), seed).alias("d"), F.lit(j).alias("j"))
                     for j, c in enumerate(below[first:], first)]
            best = F.greatest(*draws)["j"] if len(draws) > 1 else F.lit(first)
            step = step.when(F.col(f"_at{depth}") == i, best)
        d = d.withColumn(f"_at{depth + 1}", step)
        level, depth = below, depth + 1
    ids = F.array(*[F.lit(n.shard) for n in level])
    return d.withColumn(out, F.get(ids, F.col(f"_at{depth}")).cast("int")).drop(*[f"_at{i}" for i in range(depth + 1)])


def with_slots(rows: DataFrame, shard: str, order: list[str], out: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in (hash bucket, ``order``) order."""
    one = rows.withColumn("_one", F.lit(1).cast("long"))
    return running_offsets(one, shard, "_one", order, out, n_buckets(rows, least=16)).drop("_one")
