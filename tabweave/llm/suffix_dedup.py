"""Removal of repeated byte strings by suffix arrays.

A shard's units are one text, whose suffixes are sorted by the difference cover of 3: suffixes at places not
divisible by 3 are sorted by their triples, and where triples repeat, by recursion on their names; the rest
follow from those one place on and are merged in. Suffixes that begin with the same string are then
neighbours, and neighbours are compared over the string's length.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from tabweave.llm.anchors import Scheme, Units, remove_repeated

LENGTH = 400
GRAM = 128
# Bytes at which a shard is closed; names of its triples fit 21 bits.
CHUNK = 2 << 20
# Neighbours compared at a time.
PAIRS = 1 << 14


def _packed(fields: list[np.ndarray], most: list[int]) -> np.ndarray:
    """One number per row that orders as the row's fields do; ``most`` has the greatest value of each field."""
    widths = [max(1, int(m).bit_length()) for m in most]
    while sum(widths) > 63:
        # Too wide for a number: ranks stand in for the first two fields.
        pair = fields[0].astype(np.int64) << widths[1] | fields[1]
        ranks = np.unique(pair, return_inverse=True)[1]
        fields, widths = [ranks, *fields[2:]], [max(1, len(ranks).bit_length()), *widths[2:]]
    packed = fields[0].astype(np.int64)
    for field, width in zip(fields[1:], widths[1:], strict=True):
        packed = (packed << width) | field
    return packed


def _sorted_names(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the numbers, and their dense ranks from 1 in that order."""
    order = np.argsort(packed)
    packed = packed[order]
    return order, np.cumsum(np.concatenate([[1], packed[1:] != packed[:-1]]))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the sorted suffixes of ``text``, whose symbols are 1 and up; a suffix comes before its extensions."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    padded = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    most = int(padded.max())
    # A place behind the end, if it is of the sample, makes the triples of the first third end with a 0.
    ones = np.arange(1, n + (n % 3 == 1), 3)
    sample = np.concatenate([ones, np.arange(2, n, 3)])
    order, names = _sorted_names(_packed([padded[sample + i] for i in range(3)], [most] * 3))
    ranks = np.zeros(n + 3, np.int64)
    if names[-1] == len(names):
        ordered = sample[order]
    else:
        named = np.empty(len(sample), np.int64)
        named[order] = names
        ordered = sample[suffix_array(named)]
    ranks[ordered] = np.arange(1, len(ordered) + 1)
    ordered = ordered[ordered < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(_packed([padded[rest], ranks[rest + 1]], [most, len(ranks)]))]
    # How many of the sample come before each of the rest, from those of either kind.
    before = np.zeros(len(rest), np.int64)
    for depth in (1, 2):
        against = ordered[ordered % 3 == depth]
        at = np.concatenate([against, rest])
        packed = _packed([*(padded[at + i] for i in range(depth)), ranks[at + depth]], [most] * depth + [len(ranks)])
        before += np.searchsorted(packed[: len(against)], packed[len(against) :])
    out = np.empty(n, np.int64)
    out[np.arange(len(rest)) + before] = rest
    out[np.arange(len(ordered)) + np.searchsorted(before, np.arange(len(ordered)), side="right")] = ordered
    return out


def repeated_strings(units: Units, length: int) -> np.ndarray:
    """By place of the units that begins a string of ``length``: does the same begin anywhere else?"""
    ends = np.cumsum(units.sizes)
    # A 1 behind each unit; bytes are 2 and up.
    text = np.insert(units.symbols.astype(np.int64) + 2, ends, 1)
    begins = ends - units.sizes + np.arange(len(ends))
    windows = units.sizes - length + 1
    unit = np.repeat(np.arange(len(windows)), windows)
    offset = np.arange(len(unit)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = begins[unit] + offset
    number = np.full(len(text), -1, np.int64)
    number[place] = np.arange(len(place))
    order = suffix_array(text)
    order = order[number[order] >= 0]
    strings = np.lib.stride_tricks.sliding_window_view(text.astype(np.uint16), length)
    equal = np.zeros(max(len(order) - 1, 0), bool)
    # Most neighbours that differ do so in the 64 bytes at the end.
    tails = strings[:, length - 64 :]
    for i in range(0, len(equal), PAIRS):
        left, right = order[i : i + PAIRS], order[i + 1 : i + PAIRS + 1]
        left = left[: len(right)]
        same = (tails[left] == tails[right]).all(axis=1)
        same[same] = (strings[left[same]] == strings[right[same]]).all(axis=1)
        equal[i : i + len(same)] = same
    marked = np.zeros(len(place), bool)
    marked[number[order[1:][equal]]] = True
    marked[number[order[:-1][equal]]] = True
    return marked | (units.count[unit] > 1)


def _bytes(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def _pieces(text: bytes) -> Callable[[int, int], bytes]:
    return lambda low, high: text[low:high]


def _loaded(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return _bytes(b"".join(units)), np.array([len(u) for u in units])


SCHEME = Scheme(LENGTH, GRAM, _bytes, _pieces, _loaded, repeated_strings, CHUNK, everywhere=True)


def _kept_bytes(text: bytes, ranges: list[tuple[int, int]]) -> tuple[int, bytes]:
    kept, at = [], 0
    for low, high in ranges:
        kept.append(text[at:low])
        at = high
    return len(text), b"".join([*kept, text[at:]])


def remove_repeated_strings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``size`` (bytes), ``spans`` of the bytes removed, and ``kept``, the other bytes joined.

    A byte is removed if a string of 400 bytes that covers it also begins anywhere else, in the same document or
    another; overlaps count, and no string goes over the end of a document. Strings are judged on the texts as
    they come in. A repeated row is another place.
    """
    return remove_repeated(docs, key, text, SCHEME, _kept_bytes)
