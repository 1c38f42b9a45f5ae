"""Connected components by alternating stars, and the same for the few links of one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.session import materialize


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as ``a[i]``-``b[i]``: each node but the least of its component, to the least."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        after = label.copy()
        np.minimum.at(after, label[x], least)
        np.minimum.at(after, label[y], least)
        after = after[after]
        if (after == label).all() and (label[x] == label[y]).all():
            break
        label = after
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of a link that isn't itself a root.

    Each round turns every node's neighbours towards the least of them, first those above the node, then those
    below, and writes the links to the shared folder; it ends when nothing changes, after about as many rounds
    as the logarithm of the longest chain. A node with many neighbours is a hot key of a join, which adaptive
    execution splits, and of a minimum, which is combined before the shuffle; no neighbourhood is gathered.
    Null ends and links of a node with itself are left out.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    pairs = materialize(pairs, "links")
    before = None
    while True:
        state = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or state[0] == 0:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # Of a node's lower neighbours, the least becomes the neighbour of the others.
        turned = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        pairs = turned.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        pairs = materialize(pairs, "links")
