"""Near-duplicates by SimHash, found through the bit counts of fingerprint segments.

The 64 bits of a fingerprint are cut into segments, and the bits set in each make a vector. Two fingerprints
differ in at least as many bits as their vectors differ in Manhattan distance. Vectors at distance 2 or less
have a common vector at distance 1 or less, so each fingerprint is put into its own grid cell and those one
step away; fingerprints that meet in a cell are compared exactly. Around cells that are dense, the grid is refined
to segments of one bit, whose cells hold 65 fingerprints at most, and these are dealt out to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.llm.graph import components, local_stars
from tabweave.llm.text import free_name
from tabweave.session import BROADCAST_ROWS, bounded_broadcast, materialize

SEED = 42
# Segments of a fingerprint, of 4 bits each.
SEGMENTS = 16
# Bits by which linked fingerprints may differ; the grid's step allows no more than 2.
DISTANCE = 2
# Cells with more fingerprints than this are refined to single bits instead of compared pair by pair.
PAIRWISE = 256
# Cells with more fingerprints of their own than this are refined by Spark, and so are those a step away. Any other
# cell is in reach of 33 cells, so that a task meets 33 times as many fingerprints in it at most.
DENSE = 1 << 11
# Rows of the grid that a task compares at a time, and shingles counted at a time.
CHUNK = 1 << 18
SHINGLES = 1 << 16


def simhash(text: bytes | None, shingle: int) -> int:
    """The fingerprint: a bit is set if it is set in over half the hashes of the shingles, repeats included.

    Words are parted by ASCII white space, A-Z in lower case. Fewer words than a shingle has are hashed as a
    whole; without words the fingerprint is 0.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    parts = zip(*(words[i:] for i in range(shingle)), strict=False)
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(p), SEED) for p in parts), np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SHINGLES):
        bits = np.unpackbits(hashes[i : i + SHINGLES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """``key`` and ``fp``, the fingerprint of every whole text as a signed long. Null texts have fingerprint 0."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([simhash(x.as_py(), shingle) for x in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(values.view(np.int64))], ["key", "fp"])

    return rows.mapInArrow(of, f"key {kind}, fp long")


def _placed(prints: DataFrame) -> DataFrame:
    """``fp``, ``own``, its cell, and ``steps``, what leads from it to itself and to the cells one step away, with nulls."""
    width = 64 // SEGMENTS
    counts = [F.bit_count(F.shiftright("fp", width * i).bitwiseAND((1 << width) - 1)) for i in range(SEGMENTS)]
    place = sum((n.cast("bigint") * (1 << 3 * i) for i, n in enumerate(counts)), F.lit(0).cast("bigint"))
    up = [F.when(n < width, F.lit(1 << 3 * i).cast("bigint")) for i, n in enumerate(counts)]
    down = [F.when(n > 0, F.lit(-(1 << 3 * i)).cast("bigint")) for i, n in enumerate(counts)]
    return prints.select("fp", place.alias("own"), F.array(F.lit(0).cast("bigint"), *up, *down).alias("steps"))


def grid(prints: DataFrame) -> DataFrame:
    """``cell`` and ``fp``: every distinct fingerprint in its own cell and in those one step away."""
    steps = _placed(prints).select("fp", "own", F.explode("steps").alias("step")).filter("step IS NOT NULL")
    return steps.select((F.col("own") + F.col("step")).alias("cell"), "fp")


def dense_cells(prints: DataFrame) -> DataFrame:
    """``cell``: those that more than ``DENSE`` distinct fingerprints have as their own, and those a step away."""
    own = _placed(prints).groupBy("own").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("fp"))
    return grid(own.filter(F.col("n") > DENSE).select("fp")).select("cell").distinct()


def links_by_bits(prints: DataFrame) -> DataFrame:
    """``a`` and ``b``: links between fingerprints that share a neighbour at one flipped bit, to the least of these.

    A neighbour is that of 65 distinct fingerprints at most, so that no group is large, and nothing is left to verify.
    """
    near = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    points = prints.select(F.explode(near).alias("point"), "fp")
    met = points.groupBy("point").agg(F.collect_set("fp").alias("met")).filter(F.size("met") > 1)
    return met.select(F.explode("met").alias("a"), F.array_min("met").alias("b")).filter("a != b")


def _refined(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of one large cell: those that share a neighbour at one flipped bit.

    With segments of a single bit the Manhattan distance is the Hamming distance, so nothing is left to verify,
    and the work is in proportion to the fingerprints. Links are to the least of those that share a neighbour.
    """
    flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
    points = (prints[:, None] ^ flips[None, :]).ravel()
    owners = np.repeat(prints, len(flips))
    order = np.lexsort((owners, points))
    points, owners = points[order], owners[order]
    first = np.concatenate([[True], points[1:] != points[:-1]])
    heads = owners[np.maximum.accumulate(np.where(first, np.arange(len(points)), 0))]
    return owners[~first], heads[~first]


def _compared(cells: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links between the fingerprints of each cell; ``cells`` is sorted."""
    left, right = [], []
    starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    sizes = np.diff(np.append(starts, len(cells)))
    for s, n in zip(starts[sizes > PAIRWISE], sizes[sizes > PAIRWISE], strict=True):
        a, b = _refined(prints[s : s + n])
        left.append(a)
        right.append(b)
    ends = np.repeat(np.where(sizes > PAIRWISE, starts, starts + sizes), sizes)
    here, lag = np.arange(len(cells)), 1
    while len(here := here[here + lag < ends[here]]):
        near = np.bitwise_count(prints[here] ^ prints[here + lag]) <= DISTANCE
        left.append(prints[here[near]])
        right.append(prints[here[near] + lag])
        lag += 1
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def links(prints: DataFrame) -> DataFrame:
    """``a`` and ``b``: links at ``DISTANCE`` or less that connect all fingerprints of ``fp`` that such links connect.

    Each task reduces the links it verifies to stars, so their number is at most that of the fingerprints it
    read, not of the pairs among them. A task holds the fingerprints of one cell, of which there is a bound: dense
    cells and those around them are linked by single bits instead, with the same outcome.
    """
    nodes = prints.select("fp").distinct()
    dense = materialize(dense_cells(nodes), "dense")
    cells, number = grid(nodes), dense.count()
    if number == 0:
        return _links_in_cells(cells)
    dense = bounded_broadcast(dense, number)
    crowded = cells.join(dense, "cell", "left_semi").select("fp").distinct()
    return _links_in_cells(cells.join(dense, "cell", "left_anti")).unionByName(links_by_bits(crowded))


def _links_in_cells(cells: DataFrame) -> DataFrame:
    """Verified links between the fingerprints of every cell, as stars of what a task reads."""
    cells = cells.repartition(F.col("cell")).sortWithinPartitions("cell", "fp")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(cell, fp):
            a, b = _compared(cell, fp.view(np.uint64))
            if len(a):
                a, b = local_stars(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        held, rows = [], 0
        for batch in batches:
            held.append((batch.column("cell").to_numpy(), batch.column("fp").to_numpy()))
            rows += batch.num_rows
            if rows < CHUNK:
                continue
            cell, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            # The last cell may go on in the next batch.
            cut = int(np.searchsorted(cell, cell[-1]))
            yield from flush(cell[:cut], fp[:cut])
            held, rows = [(cell[cut:], fp[cut:])], 0
        if held:
            yield from flush(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return cells.mapInArrow(linked, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``key``, ``fp`` and ``component``, the least key that links reach, for every row of ``docs``.

    Fingerprints, two numbers a row, are written to the shared folder once. Only distinct ones are linked, so
    a group of copies is one node. Null and empty texts have fingerprint 0 and belong together; a null key is
    never a component's name, unless all keys of the component are null. Repeated rows stay as they are.
    """
    prints = materialize(fingerprints(docs, key, text, shingle), "prints")
    nodes = prints.groupBy("fp").agg(F.min("key").alias("least"))
    roots = components(links(nodes), "a", "b")
    placed = nodes.join(roots, nodes.fp == roots.node, "left")
    placed = placed.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = placed.join(least, "root").select("fp", "component")
    return prints.join(named, "fp").select(F.col("key").alias(key), "fp", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with one document of each component, that with the least key; the rest as they are.

    Rows that share a key are one document, of which one row stays, chosen by its hash. A row without a key cannot
    be named as a component's document, nor told from others, and stays. Null and empty texts are one component.
    Keys decide, so that texts are neither sorted nor aggregated: those that go are broadcast if they are few.
    """
    found = near_duplicates(docs, key, text, shingle).filter(F.col(key).isNotNull())
    name = free_name("_odd", docs.columns)
    keys = found.groupBy(F.col(key).alias(name)).agg(
        F.max(F.col(key) == F.col("component")).alias("kept"), F.count(F.lit(1)).alias("n")
    )
    odd = materialize(keys.filter("NOT kept OR n > 1"), "odd")
    rest = _without(docs, key, odd.select(name))
    repeated = odd.filter("kept").select(name)
    if repeated.isEmpty():
        return rest
    return rest.unionByName(_one_row(docs.join(repeated, docs[key] == repeated[name], "left_semi"), key))


def _without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose key is not among the distinct keys ``gone``; rows without a key stay."""
    rows = gone.count()
    gone = bounded_broadcast(gone, rows) if rows <= BROADCAST_ROWS else gone.hint("shuffle_hash")
    return docs.join(gone, docs[key] == gone[gone.columns[0]], "left_anti")


def _one_row(docs: DataFrame, key: str) -> DataFrame:
    """One row of every key, by the hash of the whole row, then by its place in a table written once."""
    place, order = free_name("_place", docs.columns), free_name("_order", docs.columns)
    placed = materialize(docs.withColumn(place, F.monotonically_increasing_id()), "repeated")
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    first = placed.groupBy(F.col(f"`{key}`")).agg(F.min(F.struct(digest.alias("h"), F.col(place).alias("p"))).alias(order))
    first = first.select(F.col(f"{order}.p").alias(order))
    return placed.join(first, placed[place] == first[order], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
