"""Removal of repeated word windows by FM-indexes.

A shard's units are indexed as one text: suffixes are sorted as deep as a window is long, and the symbols
before them are kept in a wavelet matrix. Each unit is then streamed from its end to its start. A backward
search extends the match by one word at a time; when it is as long as a window, the interval of the index
holds all its places, of which the first counts, and the match is cut by a word before the next step. Matching
statistics are thus known up to the window's length, which is the threshold.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from tabweave.llm.anchors import Scheme, Units, remove_repeated

LENGTH = 20
GRAM = 8
# Bytes of words at which a shard is closed.
CHUNK = 8 << 20


def word_codes(text: bytes) -> np.ndarray:
    """32-bit hashes of the words, unchanged, parted by ASCII white space.

    They only bring equal windows together; windows are compared by their words, see :func:`numbered_words`.
    """
    words = text.split()
    return np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint32, len(words))


def word_pieces(text: bytes) -> Callable[[int, int], bytes]:
    """A function that gives the words from one place to before another, joined by spaces."""
    words = text.split()
    return lambda low, high: b" ".join(words[low:high])


def numbered_words(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all units, end to end, equal for equal words only, and the words of each unit."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    found = []
    for unit in units:
        words = unit.split()
        found.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
    return np.concatenate(found), np.array([len(f) for f in found])


def _ranks(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks from 1 of pairs of ranks, and the order of the pairs."""
    pairs = first.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64)
    order = np.argsort(pairs)
    ordered = pairs[order]
    steps = np.concatenate([[1], ordered[1:] != ordered[:-1]])
    ranks = np.empty(len(pairs), np.int64)
    ranks[order] = np.cumsum(steps)
    return ranks, order


def _ahead(ranks: np.ndarray, by: int) -> np.ndarray:
    """The rank ``by`` places further on; 0 behind the end."""
    out = np.zeros_like(ranks)
    if by < len(ranks):
        out[: len(ranks) - by] = ranks[by:]
    return out


class WaveletMatrix:
    """Symbols by bits, the highest first: at each level a bit vector in 64-bit words with counts by word."""

    def __init__(self, symbols: np.ndarray, most: int):
        self.levels = max(1, int(most).bit_length())
        self.size = len(symbols)
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (symbols >> level) & 1
            packed = np.packbits(np.append(bits, np.zeros(64 - self.size % 64, bits.dtype)).astype(bool), bitorder="little")
            words = packed.view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.words.append(words)
            self.counts.append(counts)
            self.zeros.append(self.size - int(counts[-1]))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        self.base = self._descend(np.zeros(most + 1, np.int64), np.arange(most + 1))

    def _descend(self, places: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            word = places >> 6
            below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[i][word] + np.bitwise_count(self.words[i][word] & below)
            places = np.where((symbols >> level) & 1 == 1, self.zeros[i] + ones, places - ones)
        return places

    def rank(self, places: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._descend(places, symbols) - self.base[symbols]


class FmIndex:
    """Index of units for searches of up to ``depth`` symbols. Symbols are 1 and up; 0 ends a unit."""

    def __init__(self, text: np.ndarray, depth: int):
        most = int(text.max(initial=0))
        ranks, width = text.astype(np.int64), 1
        while width * 2 <= depth:
            ranks, order = _ranks(ranks, _ahead(ranks, width))
            width *= 2
        # Two overlapping halves compare the first `depth` symbols.
        whole, self.suffixes = _ranks(ranks, _ahead(ranks, depth - width))
        before = _ahead(ranks, depth - 1 - width) if depth - 1 > width else np.zeros_like(ranks)
        self.tree = WaveletMatrix(text[self.suffixes - 1], most)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=most + 1))])
        self.same = self._groups(whole)
        self.shorter = self._groups(_ranks(ranks, before)[0])

    def _groups(self, ranks: np.ndarray) -> np.ndarray:
        """Bounds of the groups of suffixes with equal ranks, in suffix order, as (group of each place, bounds)."""
        ordered = ranks[self.suffixes]
        opens = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        return np.cumsum(opens) - 1, np.append(np.flatnonzero(opens), len(ordered))

    def step(self, low: np.ndarray, high: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches with one more symbol in front."""
        both = self.tree.rank(np.concatenate([low, high]), np.concatenate([symbols, symbols]))
        return self.starts[symbols] + both[: len(low)], self.starts[symbols] + both[len(low) :]

    def shorten(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches of full depth without their last symbol."""
        group, bounds = self.shorter
        return bounds[group[low]], bounds[group[low] + 1]


def repeated_windows(units: Units, length: int) -> np.ndarray:
    """By window of the units: does the same stand in an earlier place?"""
    codes = np.unique(units.symbols, return_inverse=True)[1] + 1
    ends = np.cumsum(units.sizes)
    begins = ends - units.sizes
    # A 0 behind each unit.
    text = np.insert(codes, ends, 0)
    begins = begins + np.arange(len(begins))
    index = FmIndex(text, length)
    windows = units.sizes - length + 1
    unit = np.repeat(np.arange(len(windows)), windows)
    offset = np.arange(len(unit)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = (units.order[unit] << 32) + units.start[unit] + offset
    by_place = np.full(len(text), np.iinfo(np.int64).max)
    by_place[begins[unit] + offset] = place
    group, bounds = index.same
    earliest = np.minimum.reduceat(by_place[index.suffixes], bounds[:-1])
    first = np.empty(len(text), np.int64)
    # Stream all units in step, longest first, so that those still going are the first ones.
    by_size = np.argsort(-units.sizes, kind="stable")
    last, sizes = begins[by_size] + units.sizes[by_size] - 1, units.sizes[by_size]
    low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), len(text), np.int64)
    going = len(sizes)
    for t in range(int(sizes.max(initial=0))):
        going = int(np.searchsorted(-sizes[:going], -t, side="left"))
        low, high = low[:going], high[:going]
        if t >= length:
            low, high = index.shorten(low)
        at = last[:going] - t
        low, high = index.step(low, high, text[at])
        if t >= length - 1:
            first[at] = earliest[group[low]]
    return first[begins[unit] + offset] < place


SCHEME = Scheme(LENGTH, GRAM, word_codes, word_pieces, numbered_words, repeated_windows, CHUNK, everywhere=False)


def _kept_words(text: bytes, ranges: list[tuple[int, int]]) -> tuple[int, bytes]:
    words = text.split()
    kept, at = [], 0
    for low, high in ranges:
        kept += words[at:low]
        at = high
    return len(words), b" ".join(kept + words[at:])


def remove_repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``size`` (words), ``spans`` of the words removed, and ``kept``, the others joined by spaces.

    A word is removed if a window of 20 words that covers it also starts earlier: in a document with a smaller
    key, or before it in the same. Windows are judged on the texts as they come in. Rows that share a key are
    one document to this order: equal windows at one place of theirs are not earlier than each other.
    """
    return remove_repeated(docs, key, text, SCHEME, _kept_words)
