"""Many-valued fields as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_values(
    df: DataFrame, column: str, keep: Sequence[str], value: str = "value", position: str | None = None
) -> DataFrame:
    """One row per element of a list; rows without elements go.

    The outer form with a filter on the position computes the list once; for the plain form Spark
    first repeats the list's whole expression in two filters.
    """
    at = position or "_position"
    rows = df.select(*keep, F.posexplode_outer(column).alias(at, value)).filter(F.col(at).isNotNull())
    return rows.withColumn(at, F.col(at).cast("bigint")) if position else rows.drop(at)


def explode_parts(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """A two-level field in long form: one row per part, as ``(…, elem, key, value)``."""
    elements = explode_values(df, column, keep, "_parts", "elem")
    parts = elements.select(*keep, "elem", F.explode_outer("_parts").alias("key", "value"))
    return parts.filter(F.col("key").isNotNull())
