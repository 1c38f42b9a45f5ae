"""Exact top-k search by inner product, in tiles.

The queries are a table of blocks, the vectors are dealt out to shards. Every block meets every shard once, in a
task of its own that multiplies tiles of both and keeps the best of each tile; the lists of the shards are merged
in a tree. Neither queries nor vectors come to the driver, and no task holds more than a block and a shard.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Queries of a block, and vectors of a shard at most and at least; both go through the shuffle once for each of the
# other. Queries and candidates of a tile; lists merged at a time.
QUERY_BLOCK = 1 << 16
SHARD, LEAST_SHARD = 1 << 16, 1 << 11
QUERIES, TILE = 4096, 2048
FAN_IN = 16

_EXACT = 2**53


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and ``v``, the components as doubles, of the rows that take part.

    Rows without a key, without a vector, or with a component that is null or not finite take none.
    """
    finite = F.forall(
        f"`{vector}`", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    rows = df.filter(F.col(f"`{key}`").isNotNull() & F.coalesce(finite, F.lit(False)))
    parts = F.transform(f"`{vector}`", lambda x: x.cast("double"))
    return rows.select(F.col(f"`{key}`").cast("bigint").alias("key"), parts.alias("v"))


def _matrix(column: pa.Array, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: the places of the vectors and their matrix."""
    sizes = column.value_lengths().to_numpy()
    flat, ends = column.flatten().to_numpy(), np.cumsum(sizes)
    found = {}
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        places = (ends[at] - d)[:, None] + np.arange(d)
        found[int(d)] = (at, np.floor(scale * flat[places]))
    return found


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the ``k`` highest scores with their ids, equal scores by id. ``ids`` is one row or as many as ``scores``."""
    ids = np.broadcast_to(ids, scores.shape)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _tile(queries: np.ndarray, own: np.ndarray, tile: np.ndarray, ids: np.ndarray, k: int):
    """Scores and ids of the best of one tile, whose ids rise. Places without a candidate have the least score."""
    bound = queries.shape[1] * np.abs(queries).max(initial=0) * np.abs(tile).max(initial=0)
    if bound * len(ids) < _EXACT / 2:
        # Score and place in one number that a double holds exactly: no ties are left to choose among.
        ranks = (queries @ tile.T) * len(ids) + (len(ids) - 1 - np.arange(len(ids)))
        ranks[own[:, None] == ids[None, :]] = -np.inf
        top = -np.partition(-ranks, min(k, len(ids)) - 1, axis=1)[:, :k]
        top = -np.sort(-top, axis=1)
        held = np.isfinite(top)
        whole = np.where(held, top, 0).astype(np.int64)
        scores = whole // len(ids)
        return scores, ids[len(ids) - 1 - (whole - scores * len(ids))], held
    exact = np.vectorize(int, otypes=[object])
    products = exact(queries).dot(exact(tile).T)
    if products.size and max(map(abs, (products.max(), products.min()))) >= 2**63 - 1:
        raise OverflowError("A score does not fit a long")
    scores = products.astype(np.int64)
    held = own[:, None] != ids[None, :]
    scores, picked = _best(np.where(held, scores, np.iinfo(np.int64).min + 1), ids[None, :], k)
    return scores, picked, scores > np.iinfo(np.int64).min + 1


def top_k(
    df: DataFrame,
    queries: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the ``k`` best candidates of every query.

    ``queries`` selects the rows that ask; candidates are all rows with another key and as many components.
    Scores are inner products of the components as whole numbers, exact; ties go to the smaller key. A query
    with fewer candidates gets all, without any none. Rows that share a key count as one query, asked by the
    least of their vectors, and as a candidate each. A score that fits no long raises ``OverflowError``.
    """
    rows = _usable(df, key, vector)
    asked = _usable(df.filter(queries), key, vector).groupBy("key").agg(F.min("v").alias("v"))
    blocks = max(1, math.ceil(asked.count() / query_block))
    count = rows.count()
    shard = min(SHARD, max(LEAST_SHARD, count // (4 * df.sparkSession.sparkContext.defaultParallelism)))
    shards = max(1, math.ceil(count / shard))
    # Places in the scan spread rows evenly, whatever their keys and vectors.
    place = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).alias("part")
    dealt = rows.select("key", "v", place).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block")
    table = asked.groupBy(block).agg(F.collect_list(F.struct("key", "v")).alias("asked"))
    table = table.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))))
    top = pa.list_(pa.struct([("minus", pa.int64()), ("id", pa.int64())]))
    found = pa.schema([("query", pa.int64()), ("part", pa.int64()), ("top", top)])

    def search(vectors: pa.Table, asking: pa.Table) -> pa.Table:
        if not vectors.num_rows or not asking.num_rows:
            return found.empty_table()
        part = vectors.column("part")[0].as_py()
        asks = asking.column("asked").combine_chunks().flatten()
        own = asks.field("key").to_numpy()
        keys, parts = vectors.column("key").to_numpy(), []
        candidates = _matrix(vectors.column("v").combine_chunks(), scale)
        for d, (places, matrix) in _matrix(asks.field("v"), scale).items():
            if d not in candidates:
                continue
            at, shard = candidates[d]
            order = np.argsort(keys[at], kind="stable")
            ids, shard = keys[at][order], shard[order]
            for q in range(0, len(places), QUERIES):
                names, block, best = own[places[q : q + QUERIES]], matrix[q : q + QUERIES], None
                for i in range(0, len(ids), TILE):
                    scores, picked, held = _tile(block, names, shard[i : i + TILE], ids[i : i + TILE], k)
                    scores = np.where(held, scores, np.iinfo(np.int64).min + 1)
                    if best is not None:
                        scores = np.concatenate([best[0], scores], axis=1)
                        picked = np.concatenate([best[1], picked], axis=1)
                    best = _best(scores, picked, k)
                scores, picked = best
                held = scores > np.iinfo(np.int64).min + 1
                ends = np.concatenate([[0], np.cumsum(held.sum(axis=1))]).astype(np.int32)
                lists = pa.StructArray.from_arrays([pa.array(-scores[held]), pa.array(picked[held])], ["minus", "id"])
                columns = [pa.array(names), pa.array(np.full(len(names), part)), pa.ListArray.from_arrays(pa.array(ends), lists)]
                parts.append(pa.Table.from_arrays(columns, schema=found))
        return pa.concat_tables(parts) if parts else found.empty_table()

    by = ["block", "part"]
    lists = dealt.groupBy(*by).cogroup(table.groupBy(*by))
    lists = lists.applyInArrow(search, "query long, part long, top array<struct<minus:long,id:long>>")
    merged = F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top")
    while shards > FAN_IN:
        lists = lists.groupBy("query", F.floor(F.col("part") / FAN_IN).alias("part")).agg(merged)
        shards = math.ceil(shards / FAN_IN)
    lists = lists.groupBy("query").agg(merged)
    ranked = lists.select("query", F.posexplode("top").alias("place", "best"))
    return ranked.select(
        F.col("query").alias("query_id"),
        (F.col("place") + 1).alias("rank"),
        F.col("best.id").alias("vec_id"),
        (-F.col("best.minus")).alias("score"),
    )
