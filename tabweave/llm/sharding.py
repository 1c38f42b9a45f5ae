"""Sharding by a hierarchical weighted hash tree.

A key descends from the root over regions and racks to a shard. At each level every child draws a number
``ln(u) / weight`` from a hash of its path and the key, and the largest draw wins. A child's draws depend on
that child alone, so a changed weight moves keys only between the changed subtree and its siblings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabweave.llm.text import free_name
from tabweave.session import materialize

# Hashes give this many equally likely values of u.
_STEPS = 1 << 53


@dataclass(frozen=True)
class Leaf:
    """A shard and its place in the tree."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def balanced_tree(shards: int, per_rack: int = 2, racks: int = 2) -> list[Leaf]:
    """Shards 0 to ``shards`` - 1 in racks of ``per_rack``, ``racks`` to a region, all of weight 1."""
    return [Leaf(f"region{s // (per_rack * racks)}", f"rack{s // per_rack}", s) for s in range(shards)]


def grown_tree(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """``tree`` with one more shard in a region of its own.

    The new region is the only subtree whose weight changes, so rows move into the new shard and nowhere else.
    """
    shard = max((leaf.shard for leaf in tree), default=-1) + 1
    return [*tree, Leaf(f"region+{shard}", f"rack+{shard}", shard, weight)]


def _draw(path: str, weight: float, key: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(path), key), 11)
    return F.log((bits + F.lit(0.5)) / F.lit(float(_STEPS))) / F.lit(float(weight))


def _winner(children: dict[str, float], prefix: str, key: Column) -> Column:
    """The name of the child with the largest draw; of equal draws, the greatest name."""
    draws = [F.struct(_draw(f"{prefix}/{n}", w, key).alias("d"), F.lit(n).alias("n")) for n, w in children.items()]
    return (F.greatest(*draws) if len(draws) > 1 else draws[0])["n"]


def _choose(by_parent: dict[str, dict[str, float]], parent: Column | None, key: Column) -> Column:
    """The winner among the children of ``parent``; only that parent's draws are made."""
    if parent is None:
        return _winner(by_parent[""], "", key)
    chosen = None
    for name, children in by_parent.items():
        last = _winner(children, name, key)
        chosen = F.when(parent == name, last) if chosen is None else chosen.when(parent == name, last)
    return chosen


def shard_of(df: DataFrame, key: str, tree: list[Leaf], name: str) -> DataFrame:
    """Add ``name``, the shard of each row by the text of its ``key`` column.

    A null key is placed as the empty text; equal keys meet in one shard. Weights must be above 0 and shard
    numbers distinct. Rows are not moved: the result is a projection.
    """
    if not tree or any(leaf.weight <= 0 for leaf in tree) or len({leaf.shard for leaf in tree}) < len(tree):
        raise ValueError("A tree needs shards with distinct numbers and weights above 0")
    regions: dict[str, dict[str, float]] = {"": {}}
    racks: dict[str, dict[str, float]] = {}
    shards: dict[str, dict[str, float]] = {}
    for leaf in tree:
        rack = f"{leaf.region}/{leaf.rack}"
        regions[""][leaf.region] = regions[""].get(leaf.region, 0.0) + leaf.weight
        racks.setdefault(leaf.region, {})
        racks[leaf.region][rack] = racks[leaf.region].get(rack, 0.0) + leaf.weight
        shards.setdefault(rack, {})[str(leaf.shard)] = leaf.weight
    taken = [*df.columns, name]
    k, region, rack = (free_name(x, taken) for x in ("_key", "_region", "_rack"))
    text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    out = df.withColumn(k, text).withColumn(region, _choose(regions, None, F.col(k)))
    out = out.withColumn(rack, _choose(racks, F.col(region), F.col(k)))
    out = out.withColumn(name, _choose(shards, F.col(rack), F.col(k)).cast("int"))
    return out.drop(k, region, rack)


def number_slots(df: DataFrame, shard: str, name: str) -> DataFrame:
    """Add ``name``, a gapless number from 0 within each shard.

    The rows are sorted by shard within their partitions and written to the shared folder with their position,
    so the numbers hold whatever executor is lost. A row's slot is its place in its partition's run of the
    shard plus the rows that earlier partitions have for it, a table with one row per partition and shard.
    No task ever gathers a shard, however many rows it has and however alike they are.
    """
    pos, part, shift = (free_name(x, df.columns) for x in ("_pos", "_part", "_shift"))
    sid = free_name("_sid", df.columns)
    placed = df.sortWithinPartitions(F.col(f"`{shard}`")).withColumn(pos, F.monotonically_increasing_id())
    placed = materialize(placed, "slots")
    # The upper bits of the position are the number of the partition.
    placed = placed.withColumn(part, F.shiftright(F.col(pos), 33))
    runs = placed.groupBy(F.col(f"`{shard}`").alias(sid), F.col(part).alias("p")).agg(
        F.min(pos).alias("first"), F.count(F.lit(1)).alias("n")
    )
    before = Window.partitionBy(sid).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        sid, F.col("p").alias(f"{part}p"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias(shift)
    )
    joined = placed.join(runs, (placed[shard] == runs[sid]) & (placed[part] == runs[f"{part}p"]))
    return joined.select(*[placed[c] for c in df.columns], (F.col(pos) + F.col(shift)).cast("bigint").alias(name))


def shard_documents(docs: DataFrame, tree: list[Leaf], key: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` and ``slot``; columns of these names are replaced.

    Repeated rows get slots of their own, rows without a key a shard like any other, no rows give no rows.
    """
    kept = docs.drop("shard", "slot")
    return number_slots(shard_of(kept, key, tree, "shard"), "shard", "slot")
