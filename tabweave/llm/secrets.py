"""Secrets in texts: known forms, and strings that a tokenizer's vocabulary does not know.

A subword vocabulary covers what people write: words of prose and names in code take few tokens for many
characters. Random strings are in no vocabulary, so that nearly every character or two takes a token of its own.
Runs of key characters with few characters a token are therefore secrets, unless they are a digest or an
identifier, which are as random but not secret.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Bytes a vocabulary may have at most, as every task gets it.
MOST_BYTES = 16 << 20

# A key word, a sign and a value; the value must have 6 characters.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "token")

# Runs of this many key characters at least are tested, and are random with fewer characters a token than this.
LEAST = 20
RATIO = 1.8
# Characters that are given to the tokenizer at a time.
PIECE = 256
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+" % LEAST)
EDGES = "+/_=-"
# Hexadecimal digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGESTS = frozenset((32, 40, 56, 64, 96, 128))
KNOWN = re.compile(
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"  # UUIDs
    r"|sha(?:256|384|512)-[A-Za-z0-9+/]+"  # digests of web resources
    r"|[0-9][0-9/_-]*"  # numbers and dates
)
WHOLE_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
# Words, numbers and the signs between them are told apart before they are looked up in the vocabulary.
SPLIT = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+"
# What a text must hold to have any span; checked for a whole batch at a time.
GATE = rf"""(?i:(?:password|passwd|secret|token|api_?key)["']? *[:=])|[A-Za-z0-9+/_=-]{{{LEAST}}}"""


@lru_cache(maxsize=4)
def _encoding(vocabulary: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines()) if token}
    return tiktoken.Encoding("secrets", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def characters_a_token(run: str, encoding: tiktoken.Encoding) -> float:
    """Characters of the run by token. Long runs are cut into pieces, as merging is not linear."""
    return len(run) / sum(len(encoding.encode_ordinary(run[i : i + PIECE])) for i in range(0, len(run), PIECE))


def is_known(run: str) -> bool:
    """Is the run a digest or an identifier?"""
    return bool(KNOWN.fullmatch(run) or (len(run) in DIGESTS and WHOLE_HEX.fullmatch(run)))


def spans_of(text: str, encoding: tiktoken.Encoding, ratio: float = RATIO) -> list[tuple[int, int, str, float | None]]:
    """Start, end, kind and characters a token of every span of a text, by start, then by kind."""
    found = [(m.start(), m.end(), 0, None) for m in ASSIGN.finditer(text) if len(m[2]) >= VALUE]
    found += [(m.start(), m.end(), 1, None) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2, None) for m in HEX.finditer(text)]
    known = sorted(found)
    at, reach = 0, 0
    for m in RUN.finditer(text):
        run = m[0].strip(EDGES)
        if len(run) < LEAST or is_known(run):
            continue
        start = m.start() + len(m[0]) - len(m[0].lstrip(EDGES))
        # A run inside a known span is that secret, not another one.
        while at < len(known) and known[at][0] <= start:
            reach = max(reach, known[at][1])
            at += 1
        if start + len(run) <= reach:
            continue
        rate = characters_a_token(run, encoding)
        if rate < ratio:
            found.append((start, start + len(run), 3, rate))
    found.sort(key=lambda s: (s[0], s[2], s[1]))
    return [(start, end, KINDS[kind], rate) for start, end, kind, rate in found]


def find_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, ratio: float = RATIO
) -> DataFrame:
    """``key`` and ``spans`` (``kind``, ``start``, ``end``, ``ratio``) of every row, whose whole text is looked at.

    Kinds are ``assign`` (a key word with its value), ``access``, ``hex`` and ``token``, a random run; only the last
    has a ratio, its characters a token. Places are code points, the end exclusive; spans are in order of their
    start, then of their kind, and spans of two kinds may overlap. A random run within another span is left out.
    Null and empty texts have no span, repeated rows are looked at each, null keys stay; other columns are not kept.
    ``vocabulary`` is a tiktoken file that the driver reads and sends to the tasks, at most 16 MiB.
    """
    with open(vocabulary, "rb") as file:
        ranks = file.read(MOST_BYTES + 1)
    if len(ranks) > MOST_BYTES:
        raise ValueError(f"{vocabulary} has more than {MOST_BYTES} bytes")
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(sent.value)
        for batch in batches:
            texts = batch.column("text")
            spans = [[]] * len(texts)
            for i in pc.indices_nonzero(pc.match_substring_regex(texts, GATE).fill_null(False)).to_pylist():
                spans[i] = [
                    {"kind": k, "start": a, "end": b, "ratio": r} for a, b, k, r in spans_of(texts[i].as_py(), encoding, ratio)
                ]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(spans, span)], ["key", "spans"])

    found = rows.mapInArrow(find, f"key {kind}, spans array<struct<kind:string,start:bigint,end:bigint,ratio:double>>")
    return found.select(F.col("key").alias(key), "spans")
