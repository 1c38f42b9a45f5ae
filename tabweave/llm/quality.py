"""Quality classifier by nearest-neighbour voting over latent-semantic vectors.

A text's terms are hashed words, pairs of neighbouring character classes, and marks of its length and of how
often it repeats itself. Terms are weighted by their frequency in all documents and projected by a truncated
singular value decomposition of a bounded sample of labelled texts. A document's score is the vote of its
nearest labelled texts, each weighted by its cosine.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Labelled texts that are learnt from and sent to every task: at most so many, those with the smallest hash.
LABELLED = 6000
WORDS = 4096
DIMENSIONS = 64
NEIGHBOURS = 15
# Documents whose term vectors and cosines a task holds at a time.
BLOCK = 256
SEED = 7

# Character classes: other, lower case or beyond ASCII, upper case, digit, space, line end, sentence mark, symbol.
_CLASS = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        1 if _b > 127 or _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c in " \t" else
        5 if _c in "\r\n" else 6 if _c in ".,;:?'\"()-" else 7 if 32 < _b < 127 else 0
    )
_PAIRS = 64
_MARKS = 64
TERMS = WORDS + _PAIRS + _MARKS
# Weight of character pairs and of marks beside that of words.
_PAIR_WEIGHT, _MARK_WEIGHT = 6.0, 2.0


def term_vector(text: bytes | None) -> np.ndarray:
    """Term frequencies of a whole text. An empty or null text has marks only."""
    out = np.zeros(TERMS, np.float32)
    text = text or b""
    running = text.lower().split()
    words, total = Counter(running), len(running)
    if words:
        places = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % WORDS
        counts = np.fromiter(words.values(), np.float64, len(words))
        out[:WORDS] = np.log1p(np.bincount(places, counts, WORDS))
    if len(text) > 1:
        classes = _CLASS[np.frombuffer(text, np.uint8)]
        pairs = np.bincount(classes[:-1] * 8 + classes[1:], minlength=_PAIRS) / (len(text) - 1)
        out[WORDS : WORDS + _PAIRS] = np.sqrt(pairs) * _PAIR_WEIGHT
    lines = [line for line in text.split(b"\n") if line.strip()]
    marks = (
        min(int(np.log2(total + 1)), 15),
        16 + int(15 * len(words) / max(total, 1)),
        32 + int(7 * len(set(lines)) / max(len(lines), 1)),
        40 + int(7 * max(words.values(), default=0) / max(total, 1)),
        # Words that stand behind themselves.
        48 + min(int(60 * sum(map(operator.eq, running, running[1:])) / max(total, 1)), 15),
    )
    for m in marks:
        out[WORDS + _PAIRS + m] = _MARK_WEIGHT
    return out


@dataclass(frozen=True)
class Model:
    """What every task needs: a bounded number of vectors, whatever the size of the corpus."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def embed(self, terms: np.ndarray) -> np.ndarray:
        """Latent vectors of length 1, or 0 where nothing is known of a text."""
        latent = terms @ self.projection
        length = np.linalg.norm(latent, axis=1, keepdims=True)
        return latent / np.where(length > 0, length, 1)

    def vote(self, latent: np.ndarray) -> np.ndarray:
        """Share of the neighbours' similarity that is labelled 1; a half without any similar neighbour."""
        if not len(self.labels):
            return np.full(len(latent), 0.5)
        cosines = latent @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64) ** 8
        whole = weights.sum(axis=1)
        score = (weights * self.labels[near]).sum(axis=1) / np.where(whole > 0, whole, 1)
        return np.clip(np.where(whole > 0, score, 0.5), 0, 1)


def decompose(terms: np.ndarray, labels: np.ndarray, weights: np.ndarray, dimensions: int, neighbours: int) -> Model:
    """The model of labelled term vectors; ``weights`` are those of the terms. Randomised, with a fixed seed."""
    rng = np.random.default_rng(SEED)
    if not len(terms):
        return Model(np.zeros((len(weights), 1), np.float32), np.zeros((0, 1), np.float32), labels, neighbours)
    weighted = terms * weights
    weighted /= np.linalg.norm(weighted, axis=1, keepdims=True) + 1e-9
    size = min(dimensions + 16, *weighted.shape)
    basis = weighted.T @ rng.standard_normal((len(weighted), size)).astype(np.float32)
    for _ in range(3):
        basis, _ = np.linalg.qr(weighted.T @ (weighted @ np.linalg.qr(basis)[0]))
    _, strength, right = np.linalg.svd(weighted @ basis, full_matrices=False)
    kept = min(dimensions, int((strength > 1e-6).sum()))
    # Directions are evened out half-way, so that the strongest, language, does not decide alone.
    axes = (basis @ right[:kept].T) / np.sqrt(strength[:kept])
    projection = (weights[:, None] * axes).astype(np.float32)
    model = Model(projection, np.zeros((0, kept), np.float32), labels, neighbours)
    return Model(projection, model.embed(terms).astype(np.float32), labels, neighbours)


def _term_weights(docs: DataFrame, text: str) -> np.ndarray:
    """Weight of each term, the logarithm of the inverse share of all documents that have it."""
    rows = docs.select(F.col(f"`{text}`").cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(TERMS + 1, np.int64), 0
        for batch in batches:
            for value in batch.column("text"):
                counts[:TERMS] += term_vector(value.as_py()) > 0
            rows += batch.num_rows
        counts[TERMS] = rows
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["term", "n"])

    # One row per term comes to the driver, and one for the number of documents.
    totals = rows.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(TERMS + 1)
    for row in totals:
        counts[row.term] = row.n
    return (np.log((1 + counts[TERMS]) / (1 + counts[:TERMS])) + 0.1).astype(np.float32)


def _examples(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Term vectors and labels of at most ``most`` labelled texts, those with the smallest hashes."""
    labelled = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    labelled = labelled.groupBy(F.col(key).alias("key")).agg(F.max(label).alias("label"))
    chosen = labelled.orderBy(F.xxhash64("key"), "key").limit(most)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    # The chosen labels are bounded by `most`.
    rows = rows.join(F.broadcast(chosen), "key").select("key", "label", "text")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for value in batch.column("text"):
                vector = term_vector(value.as_py())
                used = np.flatnonzero(vector).astype(np.uint16)
                packed.append(used.tobytes() + vector[used].tobytes())
            columns = [batch.column("key"), batch.column("label").cast(pa.float64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "label", "terms"])

    kind = rows.schema["key"].dataType.simpleString()
    packed = rows.mapInArrow(terms, f"key {kind}, label double, terms binary")
    # Repeated keys could bring more rows than labels.
    found = packed.orderBy(F.xxhash64("key", "terms"), "key").limit(most).collect()
    matrix = np.zeros((len(found), TERMS), np.float32)
    for i, row in enumerate(found):
        used = len(row.terms) // 6
        matrix[i, np.frombuffer(row.terms, np.uint16, used)] = np.frombuffer(row.terms, np.float32, used, 2 * used)
    return matrix, np.array([row.label for row in found], np.float64)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most: int = LABELLED,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
) -> Model:
    """Learn from the documents of ``labels``, whose ``label`` is 0 or 1.

    Term weights count all documents; examples are at most ``most`` labelled texts, chosen by hash. Of several
    labels for a key the greatest counts; null keys, null labels and labels without a document are left out.
    Without any example all scores are a half.
    """
    weights = _term_weights(docs, text)
    terms, marks = _examples(docs, labels, key, text, label, most)
    return decompose(terms, marks, weights, dimensions, neighbours)


def _scores(texts: pa.Array, model: Model) -> np.ndarray:
    """Scores of the texts, a block at a time."""
    out = [np.empty(0)]
    for i in range(0, len(texts), BLOCK):
        terms = np.array([term_vector(x.as_py()) for x in texts[i : i + BLOCK]])
        out.append(model.vote(model.embed(terms)))
    return np.concatenate(out)


def score_quality(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score``, 0 to 1, of every row; empty and null texts are scored like any other."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["key"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(_scores(batch.column("text"), sent.value))
            yield pa.RecordBatch.from_arrays([batch.column("key"), found], ["key", "score"])

    return rows.mapInArrow(score, f"key {kind}, score double").withColumnRenamed("key", key)


def keep_quality(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, as they are.

    Null and empty texts are scored like any other; keys are not looked at, so null and repeated ones change nothing.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(place).cast(pa.binary()), sent.value) >= least))

    return docs.mapInArrow(keep, docs.schema)
