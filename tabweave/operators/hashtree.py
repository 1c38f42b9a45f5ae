"""Change detection by a hash tree over ranges of keys.

The known rows are cut into ranges of their keys, and each range has a digest: the number of its rows and sums of
their hashes, which do not depend on the order. The digests of a sheet by the same ranges take one scan and move no
rows. From the top down only what differs is looked at, and only the rows of ranges that differ are read from the
known side, joined and classified.

The tree has two levels of at most ``FAN`` nodes each; a key finds its range from the top in as many comparisons
as a level has nodes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.constants import NEEDS_UPDATE
from tabweave.operators import state

# Nodes of a level, and the rows a range has at least; ranges grow once there are FAN * FAN of them.
FAN = 32
LEAF_ROWS = 50_000
# Ranges that are read by one filter; beyond that, those with the least between them are read as one.
MOST_FILTERS = 48

_LEAF = "_leaf"


@dataclass(frozen=True)
class Tree:
    """The lowest key of each range, in order, and its digest: (rows, sum, sum). The first range is open below."""

    lows: tuple[str, ...]
    digests: tuple[tuple[int, int, int], ...]

    def differing(self, other: Sequence[tuple[int, int, int]]) -> list[int]:
        """Ranges whose digests differ; only below nodes that differ are ranges compared."""
        found: list[int] = []
        for i in range(0, len(self.lows), FAN):
            mine, theirs = self.digests[i : i + FAN], other[i : i + FAN]
            if _sum(mine) != _sum(theirs):
                found += [i + j for j, (a, b) in enumerate(zip(mine, theirs, strict=True)) if a != b]
        return found


def _sum(digests: Sequence[tuple[int, int, int]]) -> tuple[int, ...]:
    return tuple(map(sum, zip(*digests, strict=True)))


def ranges_for(rows: int) -> int:
    """Into how many ranges so many rows are cut."""
    return max(1, min(FAN * FAN, -(-rows // LEAF_ROWS)))


def range_of(key: Column, lows: Sequence[str]) -> Column:
    """The range of a key: the last whose lowest key is not above it, found level by level."""
    groups = [list(lows[i : i + FAN]) for i in range(0, len(lows), FAN)]
    tops = F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<string>")
    below = F.from_json(F.lit(json.dumps(groups)), "array<array<string>>")
    top = F.greatest(F.size(F.filter(tops, lambda low: low <= key)) - 1, F.lit(0))
    place = F.greatest(F.size(F.filter(F.get(below, top), lambda low: low <= key)) - 1, F.lit(0))
    return top * FAN + place


def _digests(rows: DataFrame, stale: Column, lows: Sequence[str], key: str, digest: str) -> list[tuple[int, int, int]]:
    """The digest of each range; a few numbers for each are all that is collected."""
    marks = [F.xxhash64(F.lit(i), F.col(key), F.col(digest), stale).cast("decimal(20,0)") for i in (1, 2)]
    sums = rows.groupBy(range_of(F.col(key), lows).alias(_LEAF)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(marks[0]).alias("one"), F.sum(marks[1]).alias("two")
    )
    found = {r[_LEAF]: (r.n, int(r.one), int(r.two)) for r in sums.collect()}
    return [found.get(i, (0, 0, 0)) for i in range(len(lows))]


def _is_stale(known: DataFrame) -> Column:
    return F.coalesce(F.col("status") == NEEDS_UPDATE, F.lit(False)) if "status" in known.columns else F.lit(False)


def build_tree(known: DataFrame, lows: Sequence[str], key: str = "src_key", digest: str = "row_hash") -> Tree:
    """The tree of the known rows. A row marked for update has a digest that no row of a sheet has."""
    return Tree(tuple(lows), tuple(_digests(known, _is_stale(known), lows, key, digest)))


def rebuilt(tree: Tree, known: DataFrame, leaves: Sequence[int], key: str = "src_key", digest: str = "row_hash") -> Tree:
    """The tree after rows of some ranges changed; only these ranges are read."""
    part = known.filter(in_ranges(F.col(key), tree.lows, leaves))
    fresh, chosen = _digests(part, _is_stale(known), tree.lows, key, digest), set(leaves)
    return Tree(tree.lows, tuple(fresh[i] if i in chosen else d for i, d in enumerate(tree.digests)))


def in_ranges(key: Column, lows: Sequence[str], leaves: Sequence[int]) -> Column:
    """Is the key in one of the ranges? Comparisons with bounds, which reach the scan: others' files are not read.

    There are a bounded number of comparisons; with more ranges apart, some ranges between them are let in too.
    """
    runs: list[list[int]] = []
    for leaf in sorted(leaves):
        if runs and leaf == runs[-1][1]:
            runs[-1][1] = leaf + 1
        else:
            runs.append([leaf, leaf + 1])
    while len(runs) > MOST_FILTERS:
        i = min(range(len(runs) - 1), key=lambda j: runs[j + 1][0] - runs[j][1])
        runs[i : i + 2] = [[runs[i][0], runs[i + 1][1]]]
    tests = []
    for low, high in runs:
        bounds = ([key >= lows[low]] if low else []) + ([key < lows[high]] if high < len(lows) else [])
        tests.append(reduce(lambda a, b: a & b, bounds, F.lit(True)) if bounds else F.lit(True))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def differing_ranges(source: DataFrame, tree: Tree, key: str = "src_key", digest: str = "row_hash") -> list[int]:
    """The ranges in which the sheet and the known rows differ, by one scan of the sheet."""
    return tree.differing(_digests(source, F.lit(False), tree.lows, key, digest))


def parted(source: DataFrame, known: DataFrame, tree: Tree, leaves: Sequence[int], key: str = "src_key") -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that lie in some ranges."""
    test = in_ranges(F.col(key), tree.lows, leaves)
    return source.filter(test), known.filter(test)


def classify_by_ranges(source: DataFrame, known: DataFrame, tree: Tree, key: str = "src_key", digest: str = "row_hash") -> DataFrame:
    """The same as :func:`state.classify_rows`; of ``known``, only the ranges that differ from ``source`` are read.

    Keys are text without NULL, and distinct on either side.
    """
    leaves = differing_ranges(source, tree, key, digest)
    some, before = parted(source, known, tree, leaves, key)
    rest = source.filter(~in_ranges(F.col(key), tree.lows, leaves)).select(key, F.lit(state.UNCHANGED).alias("change"))
    return state.classify_rows(some, before, key, digest).unionByName(rest)
