"""Benchmark decontamination by MinHash containment.

An item is in a document if the document has at least a given share of the item's distinct word shingles.
Items are parted by size, and each part has its own sketch size: one more than the shingles an item of the
part may miss. The sketch of an item is its shingles with the smallest hashes, so a document that holds the
item, however long it is, has at least one of them. What the sketches find is verified with all shingles.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.llm.text import free_name

SHINGLE = 5
THRESHOLD = 0.8
# Items are sent to the tasks in blocks of about this many words; each block is one pass over the documents.
BLOCK_WORDS = 500_000

# Bytes of ASCII that are neither letters nor digits part words.
_PARTS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """The words, A-Z in lower case: runs of ASCII letters and digits and of all other characters."""
    return text.lower().translate(_PARTS).split() if text else []


def shingles(words: list[bytes], n: int) -> list[bytes]:
    """The shingles of ``n`` words, repeats included; of fewer words, none."""
    return list(map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False)))


def least_shared(n: int, threshold: float) -> int:
    """The least number of ``n`` shingles that is the share ``threshold`` of them."""
    return max(1, math.ceil(n * threshold - 1e-9))


def sketch_size(n: int, threshold: float) -> int:
    """Sketch size of the part that items of ``n`` shingles belong to, sizes from a power of 2 to below the next."""
    largest = (1 << n.bit_length()) - 1
    return largest - least_shared(largest, threshold) + 1


@dataclass
class Index:
    """The items of a block: shingle sets by item, and the items by the shingles of their sketches.

    An item of fewer words than a shingle is one shingle of its own length, a whole number of words like any other;
    ``lengths`` has the lengths of the block's shingles.
    """

    threshold: float
    shingle: int
    lengths: set[int] = field(default_factory=set)
    ids: list = field(default_factory=list)
    sets: list[frozenset[bytes]] = field(default_factory=list)
    needed: list[int] = field(default_factory=list)
    by_shingle: dict[bytes, list[int]] = field(default_factory=lambda: defaultdict(list))

    def add(self, item, text: bytes | None) -> None:
        words = words_of(text)
        if not words:
            return
        length = min(self.shingle, len(words))
        found = frozenset(shingles(words, length))
        self.lengths.add(length)
        ranked = sorted(found, key=lambda s: (xxhash.xxh64_intdigest(s), s))
        sketch = ranked[: sketch_size(len(found), self.threshold)]
        # Shingles that a document with the item may miss can all be in the sketch.
        self.needed.append(max(1, len(sketch) - (len(found) - least_shared(len(found), self.threshold))))
        for s in sketch:
            self.by_shingle[s].append(len(self.ids))
        self.ids.append(item)
        self.sets.append(found)

    def search(self, text: bytes | None) -> list[tuple[int, int]]:
        """Places of the items that the document holds, each with the number of its shingles found."""
        words = words_of(text)
        parts = [s for n in sorted(self.lengths) for s in shingles(words, n)]
        hits = set(filter(self.by_shingle.__contains__, parts))
        if not hits:
            return []
        counts = Counter(i for s in hits for i in self.by_shingle[s])
        found, whole = [], None
        for i, n in counts.items():
            if n < self.needed[i]:
                continue
            whole = set(parts) if whole is None else whole
            shared = len(self.sets[i] & whole)
            if shared >= least_shared(len(self.sets[i]), self.threshold):
                found.append((i, shared))
        return found


def _blocks(items: DataFrame, key: str, text: str, shingle: int, threshold: float, block_words: int) -> Iterator[Index]:
    """The items in blocks of a bounded number of words; the driver holds one at a time."""
    rows = items.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)) / 4
    blocks = max(1, math.ceil((rows.agg(F.sum(size)).first()[0] or 0) / block_words))
    for b in range(blocks):
        index = Index(threshold, shingle)
        for row in rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).toLocalIterator():
            index.add(row.id, bytes(row.text) if row.text is not None else None)
        # Items of one text are found together; their order does not matter.
        yield index


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """A row for every document and item it holds: both keys, ``shared`` and ``containment``.

    Whole texts are searched. Items without words are in no document; an item of fewer words than a shingle is in the
    documents in which all its words stand together. Null texts hold nothing, null keys are reported as null,
    repeated documents or items are reported as often as they occur. Documents are not shuffled.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("binary").alias("text"))
    kinds = [rows.schema["doc"].dataType, items.schema[item_key].dataType]
    names = [key, free_name(item_key, [key]), "shared", "containment"]
    schema = f"`{names[0]}` {kinds[0].simpleString()}, `{names[1]}` {kinds[1].simpleString()}, shared long, containment double"
    found = None
    for index in _blocks(items, item_key, item_text, shingle, threshold, block_words):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            of_item = pa.array(index.ids) if index.ids else pa.nulls(0)
            for batch in batches:
                docs_at, items_at, shared = [], [], []
                for at, value in enumerate(batch.column("text")):
                    for i, n in index.search(value.as_py()):
                        docs_at.append(at)
                        items_at.append(i)
                        shared.append(n)
                if docs_at:
                    share = [n / len(index.sets[i]) for i, n in zip(items_at, shared, strict=True)]
                    columns = [batch.column("doc").take(pa.array(docs_at)), of_item.take(pa.array(items_at))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(shared), pa.array(share)], names)

        part = rows.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return found


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
               shingle: int = SHINGLE, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the documents that hold an item; the rest as they are. See :func:`find_leaks`."""
    kept = docs
    for index in _blocks(items, item_key, item_text, shingle, threshold, block_words):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        place = docs.columns.index(text)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                texts = batch.column(place).cast(pa.binary())
                yield batch.filter(pa.array([not index.search(x.as_py()) for x in texts], pa.bool_()))

        kept = kept.mapInArrow(keep, docs.schema)
    return kept
