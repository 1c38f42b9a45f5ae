"""Compression of vectors to codes, by Lloyd's rounds over cover trees.

A vector is cut into parts, and each part is replaced by the number of the nearest entry of its position's
codebook. The parts of a block of vectors make a cover tree for each position: a node's children have half its
reach, stand further apart than that, and one of them has the node's own centre. Points are laid out in the order
of the tree, so that a subtree is a range of them, and the sum of a range is a difference of two cumulative sums.

A round walks down the trees. If the nearest entry to a node's centre is nearer than the second by more than
twice the node's reach, it is, by the triangle inequality, the nearest to all points below, and the whole range
is assigned at once. Only the other nodes are opened, and points are compared one by one only where a leaf stays
ambiguous. Trees are built once, written to the shared folder and read in every round; between rounds the driver
sees the sums and counts of the entries, whose number does not depend on that of the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.llm.text import free_name
from tabweave.session import bounded_broadcast, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Vectors of a block, and points below which a node is not divided.
BLOCK, LEAF = 4096, 24
# Whole numbers beyond this could make a squared distance that is no long.
MOST = 1 << 27
# Entries that are nearer by less than this are told apart exactly; distances as doubles are far more precise.
SLACK = 1e-3

_BLOCK = "ids array<bigint>, labels array<{label}>, places binary, parts array<struct<order:binary,low:binary,high:binary,reach:binary,first:binary,n:binary>>"
_NODE = ("low", "high", "reach", "first", "n")


def whole_vectors(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """``key``, ``label`` and ``v``, the scaled components rounded down, of rows whose components are all finite."""
    finite = F.forall(
        f"`{vector}`", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    rows = df.filter(F.coalesce(finite, F.lit(False)))
    parts = F.transform(f"`{vector}`", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return rows.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{label}`").alias("label"), parts.alias("v"))


def _cuts(width: int, parts: int) -> list[tuple[int, int]]:
    """First and behind-last component of each part."""
    return [(width * p // parts, width * (p + 1) // parts) for p in range(parts)]


def _squares(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    away = points - centre
    return np.einsum("ij,ij->i", away, away)


def cover_tree(points: np.ndarray) -> dict[str, np.ndarray]:
    """The tree of ``points``: their ``order``, and by node the range ``low`` to ``high`` of it, the ``reach`` and its children.

    The first point of a node's range is its centre. Children stand together from node ``first`` on, ``n`` of them;
    a leaf has none. Points are whole numbers below :data:`MOST`.
    """
    order = np.arange(len(points))
    low, high, reach, first, n = [0], [len(points)], [], [], []
    at = 0
    while at < len(low):
        a, b = low[at], high[at]
        here = order[a:b]
        far = _squares(points[here], points[here[0]]) if b > a else np.zeros(0, np.int64)
        reach.append(float(np.sqrt(far.max(initial=0))))
        at += 1
        if b - a <= LEAF or reach[-1] == 0:
            first.append(0)
            n.append(0)
            continue
        # Centres further apart than half the reach, the node's own before all; each point goes to the first that covers it.
        half, left, groups = reach[-1] ** 2 / 4, here, []
        while len(left):
            near = far <= half
            groups.append(left[near])
            left = left[~near]
            if len(left):
                far = _squares(points[left], points[left[0]])
        order[a:b] = np.concatenate(groups)
        ends = a + np.cumsum([len(g) for g in groups])
        first.append(len(low))
        n.append(len(groups))
        low += [a, *ends[:-1].tolist()]
        high += ends.tolist()
    whole = [np.array(x, np.int32) for x in (low, high, first, n)]
    return {"order": order.astype(np.int32), "low": whole[0], "high": whole[1], "reach": np.array(reach), "first": whole[2], "n": whole[3]}


def _nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each point, of equal ones the first, and the squared distance, both exact."""
    away = np.empty((len(points), len(entries)), np.int64)
    for e, entry in enumerate(entries):
        away[:, e] = _squares(points, entry)
    best = away.argmin(axis=1)
    return best, away[np.arange(len(points)), best]


def assigned_ranges(tree: dict[str, np.ndarray], points: np.ndarray, entries: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``low``, ``high`` and entry of ranges of the tree's order that cover all points.

    ``points`` are in that order. Entries that equal an earlier one get no point.
    """
    if not len(points):
        return
    distinct = np.sort(np.unique(entries, axis=0, return_index=True)[1])
    entries = entries[distinct]
    nodes = np.zeros(1, np.int64)
    while len(nodes):
        away = np.sqrt(np.stack([_squares(points[tree["low"][nodes]], e) for e in entries], axis=1).astype(np.float64))
        best = away.argmin(axis=1)
        nearest = away[np.arange(len(nodes)), best]
        away[np.arange(len(nodes)), best] = np.inf
        sure = away.min(axis=1) - nearest > 2 * tree["reach"][nodes] + SLACK
        yield tree["low"][nodes[sure]], tree["high"][nodes[sure]], distinct[best[sure]]
        nodes = nodes[~sure]
        leaves = nodes[tree["n"][nodes] == 0]
        size = tree["high"][leaves] - tree["low"][leaves]
        at = np.repeat(tree["low"][leaves] - np.cumsum(size) + size, size) + np.arange(size.sum())
        yield at, at + 1, distinct[_nearest(points[at], entries)[0]]
        nodes = nodes[tree["n"][nodes] > 0]
        size = tree["n"][nodes]
        nodes = np.repeat(tree["first"][nodes] - np.cumsum(size) + size, size) + np.arange(size.sum())


def _loaded(row: dict, cuts: list[tuple[int, int]]) -> Iterator[tuple[int, dict[str, np.ndarray], np.ndarray]]:
    """Position, tree and points in its order, for each part of a block."""
    places = np.frombuffer(row["places"], np.int32).reshape(len(row["ids"]), -1).astype(np.int64)
    kinds = {"order": np.int32, "low": np.int32, "high": np.int32, "reach": np.float64, "first": np.int32, "n": np.int32}
    for p, (a, b) in enumerate(cuts):
        tree = {k: np.frombuffer(row["parts"][p][k], kind) for k, kind in kinds.items()}
        yield p, tree, places[tree["order"], a:b]


def _trees(rows: DataFrame, width: int, cuts: list[tuple[int, int]]) -> DataFrame:
    """Blocks of at most :data:`BLOCK` vectors of one partition, with a tree for each position."""
    label = rows.schema["label"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                column = batch.column("v")
                if (column.value_lengths().to_numpy(zero_copy_only=False) != width).any():
                    raise ValueError(f"Vectors must all have {width} components, as that of the least key")
                places = column.flatten().to_numpy(zero_copy_only=False)
                if np.abs(places).max(initial=0) > MOST:
                    raise OverflowError(f"Components must stay below {MOST} when scaled, for distances are longs")
                places = places.reshape(batch.num_rows, width).astype(np.int64)
                parts = [{k: x.tobytes() for k, x in cover_tree(places[:, a:b]).items()} for a, b in cuts]
                node = pa.list_(pa.struct([(k, pa.binary()) for k in ("order", *_NODE)]))
                ids, labels = batch.column("key"), batch.column("label")
                schema = schema or pa.schema(
                    [("ids", pa.list_(ids.type)), ("labels", pa.list_(labels.type)), ("places", pa.binary()), ("parts", node)]
                )
                ends = pa.array([0, batch.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(ends, ids),
                        pa.ListArray.from_arrays(ends, labels),
                        pa.array([places.astype(np.int32).tobytes()], pa.binary()),
                        pa.array([parts], node),
                    ],
                    schema=schema,
                )

    return rows.mapInArrow(build, _BLOCK.format(label=label))


def _totals(trees: DataFrame, cuts: list[tuple[int, int]], books: list[np.ndarray]) -> DataFrame:
    """By part, entry and place within the part: the ``total`` of the components and their number ``n``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(book.shape, np.int64) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            for row in batch.to_pylist():
                for p, tree, points in _loaded(row, cuts):
                    sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0)])
                    for low, high, entry in assigned_ranges(tree, points, books[p]):
                        np.add.at(totals[p], entry, sums[high] - sums[low])
                        np.add.at(counts[p], entry, high - low)
        for p, (total, count) in enumerate(zip(totals, counts, strict=True)):
            entry, place = (x.ravel() for x in np.indices(total.shape))
            columns = [np.full(len(entry), p), entry, place, total.ravel(), count[entry]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "total", "n"])

    found = trees.select("ids", "places", "parts").mapInArrow(add, "part long, entry long, place long, total long, n long")
    return found.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def _coded(trees: DataFrame, cuts: list[tuple[int, int]], books: list[np.ndarray]) -> DataFrame:
    """``key``, ``label``, ``code`` and ``error`` of every vector, by the codebooks as they are."""
    label = trees.schema["labels"].dataType.elementType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(["ids", "places", "parts"]).to_pylist()):
                error = np.zeros(len(row["ids"]), np.int64)
                codes = np.zeros((len(row["ids"]), len(cuts)), np.uint8)
                for p, tree, points in _loaded(row, cuts):
                    entries = np.empty(len(points), np.int64)
                    for low, high, entry in assigned_ranges(tree, points, books[p]):
                        size = high - low
                        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
                        entries[at] = np.repeat(entry, size)
                    codes[tree["order"], p] = entries
                    error[tree["order"]] += _squares(points, books[p][entries])
                digits = [c.tobytes().hex() for c in codes]
                columns = [batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(digits), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "label", "code", "error"])

    return trees.mapInArrow(encode, f"key long, label {label}, code string, error long")


def _first_books(rows: DataFrame, cuts: list[tuple[int, int]], entries: int) -> list[np.ndarray]:
    """The parts of the vectors with the least keys. Of vectors that share a key the least counts; no key comes last."""
    order = F.col("key").asc_nulls_last()
    keys = [r.key for r in rows.select("key").distinct().orderBy(order).limit(entries).collect()]
    named = F.col("key").isin([k for k in keys if k is not None])
    chosen = rows.filter(named | F.col("key").isNull() if None in keys else named)
    least = chosen.groupBy("key").agg(F.min("v").alias("v")).orderBy(order).collect()
    return [np.array([r.v[a:b] for r in least], np.int64).reshape(len(least), b - a) for a, b in cuts]


def compress(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``key``, ``label``, ``code``, ``error`` and ``label_error`` of every vector; and the codebooks by part.

    Components are whole numbers, ``floor(scale * x)``; vectors that are null or hold a null or a component that is
    not finite are left out. A codebook starts as the parts of the ``entries`` least keys (of fewer, if there are
    fewer); each round assigns every part to the nearest entry, of equally near ones the first, and moves each used
    entry to the mean of its parts, rounded down. A code has two digits a part, an error is the sum of the squared
    distances, and the label's error their sum over all vectors of the label, rows without one together. Repeated
    rows count each, null keys come last. Other columns are not kept. Vectors of different lengths are refused
    (``ValueError``), as are components beyond :data:`MOST` (``OverflowError``); an empty vector has parts without
    components; an empty table has no codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("A code has two digits a part")
    rows = whole_vectors(df, key, vector, label, scale)
    least = rows.orderBy(F.col("key").asc_nulls_last()).select(F.size("v").alias("n")).limit(1).collect()
    width = least[0].n if least else 0
    cuts = _cuts(width, parts)
    if width and width * MOST > 1 << 36:
        raise ValueError("Vectors are too long for distances that are longs")
    books = _first_books(rows, cuts, entries) if least else [np.zeros((0, 0), np.int64)] * parts
    for book in books:
        if np.abs(book).max(initial=0) > MOST:
            raise OverflowError(f"Components must stay below {MOST} when scaled, for distances are longs")
    trees = materialize(_trees(rows, width, cuts), "trees")
    for _ in range(rounds if width and least else 0):
        # One row for each component of the codebooks.
        for r in _totals(trees, cuts, books).filter("n > 0").collect():
            books[r.part][r.entry, r.place] = r.total // r.n
    coded = materialize(_coded(trees, cuts, books), "codes")
    of, total = free_name("_of", coded.columns), "label_error"
    errors = materialize(coded.groupBy(F.col("label").alias(of)).agg(F.sum("error").alias(total)), "errors")
    found = coded.join(bounded_broadcast(errors, errors.count()), coded["label"].eqNullSafe(errors[of]))
    return found.select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", total), books
