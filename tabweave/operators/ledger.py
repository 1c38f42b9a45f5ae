"""File usage as a sum of signed events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usage_events(changes: DataFrame) -> DataFrame:
    """Request changes ``(op, request, old_file, new_file)`` as signed events ``(file, request, delta)``.

    An insert uses the new file, a delete frees the old one, an update does both.
    """
    frees = F.when(F.col("op").isin("update", "delete"), F.struct(F.col("old_file").alias("file"), F.lit(-1).alias("delta")))
    uses = F.when(F.col("op").isin("insert", "update"), F.struct(F.col("new_file").alias("file"), F.lit(1).alias("delta")))
    signed = changes.select("request", F.explode(F.array_compact(F.array(frees, uses))).alias("_e"))
    return signed.select("_e.file", "request", "_e.delta").filter(F.col("file").isNotNull() & F.col("request").isNotNull())


def file_usage(events: DataFrame, by: Sequence[str] = ("file", "request")) -> DataFrame:
    return events.groupBy(*by).agg(F.sum("delta").cast("bigint").alias("uses"))
