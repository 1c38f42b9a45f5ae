"""Words and names shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_count(text: Column) -> Column:
    """Number of words of ``text`` as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and all other characters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, with underscores before it until no column of ``taken`` has the name."""
    lowered = {t.lower() for t in taken}
    while wanted.lower() in lowered:
        wanted = f"_{wanted}"
    return wanted
