"""Repeated windows of a fixed length, found by content: the frame of both substring operators.

Every window of ``length`` symbols has an anchor, the least hash of its runs of ``gram`` symbols. Equal
windows have equal anchors, so a window can only be repeated if its anchor is, and all places of a window
meet where their anchor is sent. Consecutive windows with one anchor travel together as a unit. The work is
in proportion to the text, however often its passages repeat:

1. Anchors are counted over all documents. The repeated ones become a bitmap of fixed size; a wrong bit only
   sends a unit too many.
2. Units with such anchors are cut. Of equal units of a task, the one in the first place is sent on with its
   symbols; the others are known to be repeated.
3. Units are dealt out by anchor, and a solver judges the windows of each shard. An anchor with very many places
   would bring all the different texts around one phrase to one shard; its units are cut into their windows, which
   are dealt out by a digest of the whole window and compared by it, so no shard holds such an anchor.
4. What is to be removed goes back to the documents as ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.llm.text import free_name
from tabweave.session import materialize

# Bits of the map of repeated anchors, a power of 2: 8 MiB for every task, whatever the corpus.
MAP_BITS = 1 << 26
# Bytes of unit symbols that a task holds before it sends them on.
HELD = 64 << 20

# Places from which on an anchor's units are cut into windows, and bytes of a window's digest, fewer than a window has.
HOT_PLACES = 4096
DIGEST = 16

_MIX = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xBF58476D1CE4E5B9)
_SPREAD = 0xD6E8FEB86659FD93


@dataclass
class Units:
    """Units of a shard: their symbols end to end, and for each unit its length, first place and number of places.

    ``order`` is the rank of its document, ``start`` the place of its first symbol there.
    """

    symbols: np.ndarray
    sizes: np.ndarray
    order: np.ndarray
    start: np.ndarray
    count: np.ndarray


@dataclass(frozen=True)
class Scheme:
    """What is searched: windows of ``length`` symbols, anchors of ``gram`` (a power of 2), a shard's solver.

    ``symbols`` turns a text into an array, by which equal windows meet; it may have equal numbers for different
    symbols. ``pieces`` gives a function that cuts symbols out of a text as bytes, ``loaded`` turns such bytes into
    symbols end to end and their number by unit, exactly. The solver gets units and tells for each of their
    windows, unit by unit, whether it is to be removed. ``chunk`` is the number of bytes at which a shard is
    closed; a shard never splits an anchor. ``everywhere`` tells whether all places of a repeated window are
    removed, else all but the first.
    """

    length: int
    gram: int
    symbols: Callable[[bytes], np.ndarray]
    pieces: Callable[[bytes], Callable[[int, int], bytes]]
    loaded: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    solver: Callable[[Units, int], np.ndarray]
    chunk: int
    everywhere: bool


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` symbols, by doubling."""
    h = (symbols.astype(np.uint64) + np.uint64(1)) * _MIX
    h ^= h >> np.uint64(29)
    width = 1
    while width < gram:
        h = (h[:-width] * _TURN) ^ (h[width:] >> np.uint64(17)) ^ (h[width:] * _MIX)
        h ^= h >> np.uint64(31)
        width *= 2
    return h


def _sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over each ``width`` consecutive values, from running results of both directions."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    block = np.empty(rows * width, values.dtype)
    block[: len(values)] = values
    block[len(values) :] = values[-1]
    block = block.reshape(rows, width)
    ahead = op.accumulate(block, axis=1).ravel()
    back = op.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n], ahead[width - 1 : width - 1 + n])


def anchors_of(symbols: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """The hashes, and their anchor by window. ``symbols`` must hold a window at least."""
    hashes = gram_hashes(symbols, scheme.gram)
    return hashes, _sliding(hashes, scheme.length - scheme.gram + 1, np.minimum)


def _anchor_places(hashes: np.ndarray, anchors: np.ndarray, width: int) -> np.ndarray:
    """The hash of each place that is the anchor of some window; a place counts once."""
    padded = np.concatenate([np.zeros(width - 1, np.uint64), anchors, np.zeros(width - 1, np.uint64)])
    return hashes[_sliding(padded, width, np.maximum) == hashes]


def runs(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each run with one anchor."""
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    return first, np.diff(np.append(first, len(anchors)))


def repeated_anchors(rows: DataFrame, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Bitmap of the anchors that have more than one place in all texts of ``rows``; and those with very many."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, np.uint64)]
            for value in batch.column("text"):
                symbols = scheme.symbols(value.as_py() or b"")
                if len(symbols) >= scheme.length:
                    hashes, anchors = anchors_of(symbols, scheme)
                    found.append(_anchor_places(hashes, anchors, scheme.length - scheme.gram + 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["anchor"])

    counts = rows.select("text").mapInArrow(places, "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts.filter("n > 1"), "anchors")
    bit = F.col("anchor").bitwiseAND(MAP_BITS - 1)
    word = F.shiftright(bit, 6).cast("int").alias("word")
    words = counts.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(anchor & 63 as int))")).alias("bits"))
    # At most MAP_BITS / 64 rows, however many anchors there are.
    found = words.toArrow()
    bits = np.zeros(MAP_BITS // 64, np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    # One anchor for HOT_PLACES places at most: 8 bytes for some 100 kB of text.
    hot = counts.filter(F.col("n") >= HOT_PLACES).select("anchor").toArrow()["anchor"].to_numpy()
    return bits.view(np.uint64), hot


def _in_map(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    place = anchors & np.uint64(MAP_BITS - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


_UNIT = {
    "anchor": pa.int64(), "key": pa.int64(), "hash": pa.int64(), "start": pa.int64(), "windows": pa.int64(),
    "count": pa.int64(), "symbols": pa.binary(),
}
_RANGE = ["key", "hash", "low", "high"]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _first(key: int | None, start: int) -> tuple:
    """Order of places; a null key comes last."""
    return (key is None, key or 0, start)


def _joined(units: list[list]) -> list[list]:
    """Units of windows that are known to be repeated, with those of one text that follow each other as one."""
    out: list[list] = []
    for unit in units:
        last = out[-1] if out else None
        if last and unit[6] is last[6] is None and unit[1:3] == last[1:3] and unit[3] == last[3] + last[4]:
            last[4] += unit[4]
        else:
            out.append(unit)
    return out


def _cut(rows: DataFrame, scheme: Scheme, sent) -> DataFrame:
    """Units of repeated anchors, with their symbols; without, if an equal one of the task is in an earlier place."""

    def packed(units: list[list]) -> pa.RecordBatch:
        columns = zip(*units, strict=True) if units else [[]] * len(_UNIT)
        arrays = [pa.array(c, kind) for c, kind in zip(columns, _UNIT.values(), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, list(_UNIT))

    def known(unit: list) -> list:
        """The unit as one that is known to be repeated: any task may have it, and those of one text need not meet."""
        unit[0], unit[6] = _signed(((unit[1] or 0) * _SPREAD + unit[3]) % (1 << 64)), None
        return unit

    def met(first: dict, new: list, ready: list) -> bool:
        """Put a unit among the ``first`` of the task; those it shows to be repeated become ready. Is it a new one?"""
        old = first.setdefault(new[6], new)
        if old is new:
            return True
        old[5] = new[5] = old[5] + 1
        here, there = _first(new[1], new[3]), _first(old[1], old[3])
        if here < there:
            first[new[6]], new = new, old
        ready.append(new if here == there else known(new))
        return False

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, whole, ready, size = {}, {}, [], 0
        bitmap, hot = sent.value[0], frozenset(sent.value[1].tolist())
        for batch in batches:
            for key, value in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                text = value.as_py() or b""
                symbols = scheme.symbols(text)
                if len(symbols) < scheme.length:
                    continue
                anchors = anchors_of(symbols, scheme)[1]
                start, windows = runs(anchors)
                kept = _in_map(bitmap, anchors[start])
                if not kept.any():
                    continue
                piece, digest = scheme.pieces(text), _signed(xxhash.xxh64_intdigest(text, 42))
                names = anchors[start[kept]].view(np.int64).tolist()
                for anchor, s, n in zip(names, start[kept].tolist(), windows[kept].tolist(), strict=True):
                    unit = piece(s, s + n + scheme.length - 1)
                    if anchor not in hot:
                        if met(first, [anchor, key, digest, s, n, 1, unit], ready):
                            size += len(unit)
                        continue
                    here, (there, parts) = _first(key, s), whole.get(unit, (None, ()))
                    if there is not None and there < here:
                        # All its windows are repeated by an equal unit, whose windows are so as well.
                        for part in parts:
                            part[5] = 2
                        ready.append(known([anchor, key, digest, s, n, 1, unit]))
                        continue
                    made, late = [], []
                    for i in range(s, s + n):
                        name = xxhash.xxh3_128_digest(piece(i, i + scheme.length))
                        part = [int.from_bytes(name[:8], "little", signed=True), key, digest, i, 1, 1, name]
                        if met(first, part, late):
                            size += 40 * DIGEST
                            made.append(part)
                    ready += _joined(late)
                    whole[unit] = (here, made)
                    size += len(unit)
            if size > HELD:
                ready += first.values()
                first, whole, size = {}, {}, 0
            if len(ready) >= 10_000:
                yield packed(ready)
                ready = []
        yield packed(ready + list(first.values()))

    kinds = ", ".join(f"{n} {'binary' if n == 'symbols' else 'long'}" for n in _UNIT)
    return rows.mapInArrow(cut, kinds)


def _ranges(unit: np.ndarray, low: np.ndarray, marked: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit, first and behind-last symbol of each run of marked windows; ``unit`` and ``low`` are given by window."""
    at = np.flatnonzero(marked)
    if not len(at):
        return at, at, at
    opens = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(unit[at]) > 0)])
    closes = np.append(opens[1:], True)
    return unit[at[opens]], low[at[opens]], low[at[closes]] + length


def _firsts(values: list[bytes], order: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[list[int], list[int]]:
    """Of equal units of a shard, the one in the first place, with the places of all; and the others.

    Units of equal places, whose documents share a key, are none of them others.
    """
    first: dict[bytes, int] = {}
    kept, later = [], []
    for i, (value, here) in enumerate(zip(values, zip(order.tolist(), start.tolist(), strict=True), strict=True)):
        j = first.setdefault(value, i)
        if j == i:
            continue
        there = (int(order[j]), int(start[j]))
        count[i] = count[j] = count[i] + count[j]
        if here < there:
            first[value], i = i, j
        (kept if here == there else later).append(i)
    return [*first.values(), *kept], later


def _judged(table: pa.Table, scheme: Scheme) -> pa.RecordBatch:
    """Ranges to remove of the units of a shard."""
    values = table.column("symbols").to_pylist()
    keys, hashes = table.column("key").combine_chunks(), table.column("hash").combine_chunks()
    order = np.unique(keys.fill_null(0).to_numpy(), return_inverse=True)[1]
    order = np.where(keys.is_null().to_numpy(zero_copy_only=False), len(values), order)
    start, count = table.column("start").to_numpy(), table.column("count").to_numpy().copy()
    firsts, later = _firsts(values, order, start, count)
    symbols, sizes = scheme.loaded([values[i] for i in firsts])
    every = table.column("windows").to_numpy() + scheme.length - 1
    at = np.array(firsts)
    marked = scheme.solver(Units(symbols, sizes, order[at], start[at], count[at]), scheme.length)
    windows = every[at] - scheme.length + 1
    unit = np.repeat(np.arange(len(at)), windows)
    offset = np.arange(len(unit)) - np.repeat(np.cumsum(windows) - windows, windows)
    owner, low, high = _ranges(unit, start[at][unit] + offset, marked, scheme.length)
    rest = np.array(later, np.int64)
    owner = pa.array(np.concatenate([at[owner], rest]))
    low, high = np.concatenate([low, start[rest]]), np.concatenate([high, start[rest] + every[rest]])
    return pa.RecordBatch.from_arrays([keys.take(owner), hashes.take(owner), pa.array(low), pa.array(high)], _RANGE)


def _judged_windows(table: pa.Table, scheme: Scheme) -> pa.RecordBatch:
    """Ranges to remove of windows that are compared by their digests."""
    values = table.column("symbols").to_pylist()
    keys, hashes = table.column("key").combine_chunks(), table.column("hash").combine_chunks()
    order = np.unique(keys.fill_null(0).to_numpy(), return_inverse=True)[1]
    order = np.where(keys.is_null().to_numpy(zero_copy_only=False), len(values), order)
    start, count = table.column("start").to_numpy(), table.column("count").to_numpy().copy()
    firsts, later = _firsts(values, order, start, count)
    at = np.array([*later, *(i for i in firsts if scheme.everywhere and count[i] > 1)], np.int64)
    low = pa.array(start[at])
    return pa.RecordBatch.from_arrays([keys.take(at), hashes.take(at), low, pa.array(start[at] + scheme.length)], _RANGE)


def _judged_units(table: pa.Table, scheme: Scheme) -> Iterator[pa.RecordBatch]:
    """Ranges to remove of a shard, which may have units and single windows."""
    single = pc.equal(pc.binary_length(table.column("symbols")), DIGEST)
    for part, judge in ((table.filter(pc.invert(single)), _judged), (table.filter(single), _judged_windows)):
        if part.num_rows:
            yield judge(part, scheme)


def _shard_end(table: pa.Table, scheme: Scheme) -> int:
    """Units that make the next shard: whole anchors, up to the chunk's size if that ends one. 0: the anchor goes on."""
    anchors = table.column("anchor").to_numpy()
    ends = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
    if not len(ends):
        return 0
    sizes = np.cumsum(pc.binary_length(table.column("symbols")).to_numpy())
    fit = ends[sizes[ends - 1] <= scheme.chunk]
    return int(fit[-1] if len(fit) else ends[0])


def _solve(units: DataFrame, scheme: Scheme) -> DataFrame:
    """Ranges to remove: of units that are known to be repeated, all; of the rest, what the solver marks."""
    dealt = units.repartition(F.col("anchor")).sortWithinPartitions("anchor")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            known = table.filter(table.column("symbols").is_null())
            if known.num_rows:
                low = known.column("start").to_numpy()
                high = low + known.column("windows").to_numpy() + scheme.length - 1
                columns = [known.column(c).combine_chunks() for c in ("key", "hash")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(low), pa.array(high)], _RANGE)
            rest = table.filter(table.column("symbols").is_valid())
            if not rest.num_rows:
                continue
            held.append(rest)
            size += rest.column("symbols").nbytes
            while size >= scheme.chunk:
                whole = pa.concat_tables(held).combine_chunks()
                cut = _shard_end(whole, scheme)
                if cut:
                    yield from _judged_units(whole.slice(0, cut), scheme)
                held = [whole.slice(cut)]
                size = held[0].column("symbols").nbytes
                if not cut:
                    break
        if held:
            yield from _judged_units(pa.concat_tables(held), scheme)

    return dealt.mapInArrow(solve, ", ".join(f"{n} long" for n in _RANGE))


def united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same symbols as disjoint ranges that do not touch, in order."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def remove_repeated(
    docs: DataFrame,
    key: str,
    text: str,
    scheme: Scheme,
    keep: Callable[[bytes, list[tuple[int, int]]], tuple[int, bytes]],
) -> DataFrame:
    """``docs`` with ``size``, ``spans`` and ``kept``; columns of these names are replaced.

    ``spans`` are the ranges of symbols that the scheme removes. ``keep`` takes a text and its ranges and returns
    the number of its symbols and what is left of it. The key must be a number. A null text is an empty one, a
    null key comes last, and rows that share a key are told apart by a hash of their text.
    """
    added = ("size", "spans", "kept")
    base = docs.drop(*[a for a in added if a not in (key, text)])
    named = F.col(f"`{key}`").cast("bigint"), F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    rows = base.select(named[0].alias("key"), named[1].alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(repeated_anchors(rows, scheme))
    ranges = _solve(_cut(rows, scheme, sent), scheme)
    spans = ranges.groupBy("key", "hash").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    k, h, t = (free_name(x, base.columns) for x in ("_key", "_hash", "_text"))
    wide = base.withColumns({k: named[0], h: F.xxhash64(named[1])})
    found = wide.join(spans, wide[k].eqNullSafe(spans["key"]) & (wide[h] == spans["hash"]), "left")
    # The bytes are made behind the join, so that the text goes through it once.
    of = F.coalesce(wide[text].cast("binary"), F.lit(b"")).alias(t)
    found = found.select(*[wide[c] for c in base.columns], of, spans["spans"])
    schema = base.schema.fields
    width = len(schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
        for batch in batches:
            sizes, spans, kept = [], [], []
            for value, found in zip(batch.column(width), batch.column(width + 1).to_pylist(), strict=True):
                parts = united([(r["low"], r["high"]) for r in found or []])
                size, rest = keep(value.as_py(), parts)
                sizes.append(size)
                spans.append([{"low": a, "high": b} for a, b in parts])
                kept.append(rest)
            columns = [pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())]
            names = [*batch.schema.names[:width], *added]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *columns], names)

    out = T.StructType([*schema, T.StructField("size", T.LongType())])
    out.add("spans", T.ArrayType(T.StructType([T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])))
    return found.mapInArrow(finish, out.add("kept", T.BinaryType()))
