"""Collocations: phrases whose words stand together more often than their parts suggest.

Frequent phrases are mined level by level over relations of occurrences, which are persisted in the order of the
text. A relation is kept in blocks of documents: at each place of a block stands the number of the frequent phrase
that begins there, or 0, and a 0 stands between pieces. A level

1. joins the relation with itself on the block and the adjacent place: two frequent phrases one place apart make
   an occurrence of a phrase that is a word longer. Both sides are in order, so the join is a merge, and pieces
   are never crossed;
2. counts the occurrences by phrase, in each task first, and keeps the groups that are frequent;
3. semi-joins the occurrences with these groups, which gives the next relation, and writes it to the shared folder.

A phrase is as frequent as each of its parts at most, so nothing frequent is lost. Phrases are pairs of numbers of
shorter ones, which is exact; their words are put together from the groups alone at the end.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabweave.llm.text import UPPER
from tabweave.session import BROADCAST_ROWS, bounded_broadcast, materialize

LEAST, LONGEST, COVERED, MOST = 100, 5, 100, 2000
# Words of a block, besides those of its last document; and pairs that a task counts at a time.
BLOCK = 1 << 18
PAIRS = 1 << 20
# Relations are long binary values: a reader takes a group of few blocks at a time, and none of a whole file.
_WRITTEN = {"compression": "zstd", "parquet.block.size": 4 << 20}
# A language's phrases are ranked in so many parts first.
SPREAD = 64

_BREAK = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(UPPER.encode() + _BREAK + b"\t", UPPER.lower().encode() + b"\n" * len(_BREAK) + b" ")


def _planes(values: np.ndarray) -> bytes:
    """The numbers with all first bytes before all second ones, and so on, as far as there are any; it compresses well."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return bytes([width]) + values.astype("<u4").view(np.uint8).reshape(-1, 4).T[:width].tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    parts = np.frombuffer(planes, np.uint8, offset=1).reshape(planes[0], -1)
    whole = np.zeros((parts.shape[1], 4), np.uint8)
    whole[:, : planes[0]] = parts.T
    return whole.view("<u4").ravel()


class _Words:
    """Words of one block with their numbers, from 1; 0 stands between pieces."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict(count(1).__next__, {b"": -1, b"\n": 0})
        self.codes: list[np.ndarray] = []

    def add(self, text: bytes) -> int:
        words = text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        words.append(b"\n")
        codes = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        self.codes.append(codes[codes >= 0].astype(np.uint32))
        return len(self.codes[-1])

    def row(self) -> tuple[list[bytes], np.ndarray, bytes]:
        codes = np.concatenate(self.codes)
        words = [w for w, n in self.numbers.items() if n > 0]
        return words, np.bincount(codes, minlength=len(words) + 1)[1:], _planes(codes)


def word_blocks(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Blocks of documents of one language: ``lang``, ``block``, the ``words`` with their ``counts``, and the ``codes`` in order."""
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("text"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names, held, size = count(TaskContext.get().partitionId() << 32), {}, 0

        def packed() -> pa.RecordBatch:
            made = [(name, next(names), *block.row()) for name, block in held.items()]
            kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
            columns = zip(*made, strict=True) if made else [[]] * 5
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["lang", "block", "words", "counts", "codes"])

        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                if name not in held:
                    held[name] = _Words()
                size += held[name].add(value.as_py())
                if size >= BLOCK:
                    yield packed()
                    held, size = {}, 0
        yield packed()

    return rows.mapInArrow(cut, "lang string, block long, words array<string>, counts array<bigint>, codes binary")


def numbered(groups: DataFrame, name: str) -> DataFrame:
    """``groups`` with an ``id`` from 1 without gaps, written to the shared folder.

    The places in the partitions are written; the counts of earlier partitions, a number each, are added.
    """
    placed = materialize(groups.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    if sum(r.n for r in sizes) >= 1 << 32:
        raise OverflowError("Numbers of frequent phrases have 32 bits")
    starts, at = [], 1
    for r in sizes:
        starts.append((r._part, at))
        at += r.n
    offsets = groups.sparkSession.createDataFrame(starts, "_part long, _start long")
    placed = placed.join(F.broadcast(offsets), part == offsets["_part"])
    return placed.withColumn("id", F.col("_at").bitwiseAND((1 << 33) - 1) + F.col("_start")).drop("_at", "_part", "_start")


def adjacent(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The merge join on adjacent places: where two phrases stand one place apart, and the pair of their numbers."""
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    return at, (ids[at].astype(np.uint64) << np.uint64(32) | ids[at + 1]).view(np.int64)


def _counted(relation: DataFrame) -> DataFrame:
    """``key`` and number ``n`` of the pairs of some blocks at a time; a pair may come again."""

    def some(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["key", "n"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [np.empty(0, np.int64)], 0
        for batch in batches:
            for planes in batch.column("ids"):
                held.append(adjacent(_numbers(planes.as_py()))[1])
                size += len(held[-1])
                if size >= PAIRS:
                    yield some(held)
                    held, size = [np.empty(0, np.int64)], 0
        yield some(held)

    return relation.select("ids").mapInArrow(pairs, "key long, n long")


def _by_block(relation: DataFrame) -> DataFrame:
    """``block``, and the ``key`` of every pair in it."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, planes in zip(batch.column("block").to_pylist(), batch.column("ids"), strict=True):
                keys = np.unique(adjacent(_numbers(planes.as_py()))[1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block)), pa.array(keys)], ["block", "key"])

    return relation.select("block", "ids").mapInArrow(pairs, "block long, key long")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one by one, as each is large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _written(blocks: list[int], relation: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(relation, pa.binary())], ["block", "ids"])


def _of_words(blocks: DataFrame, groups: DataFrame, size: int, bound: int) -> DataFrame:
    """The relation of the frequent words: ``block`` and ``ids``."""
    sent = None
    if size <= bound:
        known: dict[str, dict[str, int]] = defaultdict(dict)
        for lang, word, number in zip(*groups.select("lang", "word", "id").toArrow().to_pydict().values(), strict=True):
            known[lang][word] = number
        sent = blocks.sparkSession.sparkContext.broadcast(dict(known))
        rows = blocks.select("block", "codes", "lang", "words")
    else:
        each = blocks.select("lang", "block", F.posexplode("words").alias("place", "word"))
        rows = _found(blocks.select("block", "codes", "lang", F.size("words").alias("words")), each.join(groups, ["lang", "word"]))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                if sent is not None:
                    of = sent.value.get(row["lang"], {})
                    ids = np.array([0, *(of.get(w, 0) for w in row["words"])], np.uint32)
                else:
                    ids = np.zeros(row["words"] + 1, np.uint32)
                    ids[np.array(row["places"]) + 1] = row["numbers"]
                ids = ids[_numbers(row["codes"])]
                if ids.any():
                    yield _written([row["block"]], [_planes(ids)])

    return rows.mapInArrow(take, "block long, ids binary")


def _longer(relation: DataFrame, groups: DataFrame, size: int, bound: int) -> DataFrame:
    """The relation of the frequent phrases that are a word longer than those of ``relation``."""
    sent, rows = None, relation.select("block", "ids")
    if size <= bound:
        found = groups.select("key", "id").toArrow()
        keys, ids = found["key"].to_numpy(), found["id"].to_numpy()
        order = np.argsort(keys)
        sent = relation.sparkSession.sparkContext.broadcast((keys[order], ids[order].astype(np.uint32)))
    else:
        # In a block, pairs are in order of their keys.
        rows = _found(rows, _by_block(relation).select("block", F.col("key").alias("place"), "key").join(groups, "key"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                ids = _numbers(row["ids"])
                at, pairs = adjacent(ids)
                if sent is not None:
                    keys, numbers = sent.value
                else:
                    keys, numbers = np.array(row["places"]), np.array(row["numbers"], np.uint32)
                    order = np.argsort(keys)
                    keys, numbers = keys[order], numbers[order]
                place = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
                longer = np.zeros(len(ids), np.uint32)
                longer[at] = np.where(keys[place] == pairs, numbers[place], 0)
                if longer.any():
                    yield _written([row["block"]], [_planes(longer)])

    return rows.mapInArrow(take, "block long, ids binary")


def _found(rows: DataFrame, each: DataFrame) -> DataFrame:
    """``rows`` by block with the ``places`` and ``numbers`` of their frequent groups; a block's are as many as its words at most."""
    pairs = each.groupBy("block").agg(F.collect_list(F.struct("place", "id")).alias("_found"))
    joined = rows.join(pairs, "block")
    return joined.select(*rows.columns, F.col("_found.place").alias("places"), F.col("_found.id").alias("numbers"))


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, bound: int = BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``words``, ``phrase`` and ``a`` of the phrases of up to ``longest`` words that occur ``least`` times; and ``lang`` and ``n``.

    Groups are sent to all tasks if they are ``bound`` rows at most, else joined with the pairs of the blocks.
    """
    blocks = materialize(word_blocks(docs, text, lang), "blocks", **_WRITTEN)
    totals = blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, c: s + c)).alias("n"))
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", "w.words", "w.counts")
    words = each.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("a")).filter(F.col("a") >= least)
    groups = numbered(words, "words")
    named = [materialize(groups.select("id", "lang", F.array("word").alias("words"), "a"), "phrases")]
    size = groups.count()
    relation = _of_words(blocks, groups, size, bound)
    for _ in range(longest - 1):
        if not size:
            break
        # Written in the order of the text, so that the next join finds both sides in order.
        relation = materialize(relation, "occurrences", **_WRITTEN)
        pairs = _counted(relation).groupBy("key").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
        groups = numbered(pairs, "pairs")
        size = groups.count()
        named.append(materialize(_worded(groups, named[-1]), "phrases"))
        if size:
            relation = _longer(relation, groups, size, bound)
    whole = named[0]
    for more in named[1:]:
        whole = whole.unionByName(more)
    return whole.select("lang", "words", F.array_join("words", " ").alias("phrase"), "a"), totals


def _worded(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """The words of phrases that are pairs of ``parts`` one word apart."""
    first, second = F.shiftrightunsigned("key", 32), F.col("key").bitwiseAND((1 << 32) - 1)
    left = parts.select(F.col("id").alias("_first"), "lang", "words")
    right = parts.select(F.col("id").alias("_second"), F.element_at("words", -1).alias("_last"))
    joined = groups.join(left, first == left["_first"]).join(right, second == right["_second"])
    return joined.select("id", "lang", F.concat("words", F.array("_last")).alias("words"), "a")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    covered: int = COVERED,
    bound: int = BROADCAST_ROWS,
) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of the phrases of two words and more.

    Words are parted by spaces and tabs, A-Z in lower case; no phrase goes over one of ``.,;:!?`` or a line end. ``a``
    is how often the phrase occurs, overlaps counted, ``l`` and ``r`` how often its parts do at the cut with the
    least score, ``n`` the number of words, all by language. The score is 1000 a n / (l r), rounded down, in exact
    arithmetic; of equal cuts the first counts. A phrase is left out if a longer one that holds it occurs at least
    ``covered`` hundredths as often. Null languages are ``und``, null texts are empty, repeated rows count each;
    other columns are not looked at.
    """
    phrases, totals = frequent_phrases(docs, text, lang, least, longest, bound)
    candidates = phrases.filter(F.size("words") > 1).join(bounded_broadcast(totals, totals.count()), "lang")

    def part(first: int | Column, size: Column) -> Column:
        return F.array_join(F.slice("words", first, size), " ")

    k, m = F.col("k"), F.size("words")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), m - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "n", "k", part(1, k).alias("first"), part(k + 1, m - k).alias("rest"))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    wide = {c: f"CAST({c} AS DECIMAL(16,0))" for c in "anlr"}
    score = F.expr(f"(CAST(1000 AS DECIMAL(4,0)) * {wide['a']} * {wide['n']}) DIV ({wide['l']} * {wide['r']})")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(best)
    # The parts of every longer candidate, with how often it occurs.
    size = F.explode(F.sequence(F.lit(2), m - 1)).alias("size")
    inner = candidates.filter(m > 2).select("lang", "words", "a", size)
    inner = inner.select("lang", "words", "a", "size", F.explode(F.sequence(F.lit(1), m - F.col("size") + 1)).alias("at"))
    inner = inner.groupBy("lang", part(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").filter("longer IS NULL OR 100 * longer < %d * a" % covered)
    return kept.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def top_collocations(docs: DataFrame, most: int = MOST, **options) -> DataFrame:
    """The first ``most`` collocations of each language with their ``rank``: by score, then by ``a``, then by phrase.

    A language is ranked in parts first, so that no task gets all of its phrases.
    """
    found = collocations(docs, **options)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))).orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= most)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
