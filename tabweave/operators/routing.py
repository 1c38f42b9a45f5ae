"""One sheet to several targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.text import source_col


def default_bundle(bundle: Column, default: str) -> Column:
    return F.coalesce(bundle, F.lit(default))


def route_targets(df: DataFrame, column: str, routes: Mapping[str, Sequence[str]], out: str = "target") -> DataFrame:
    """Tag each row with the targets that claim its value, in one scan; rows no target claims are left out.

    A value that several targets claim gives one row per target.
    """
    claims: dict[str, list[str]] = {}
    for target, values in routes.items():
        for value in values:
            claims.setdefault(value, []).append(target)
    known = F.create_map(*[x for v, t in claims.items() for x in (F.lit(v), F.array(*map(F.lit, t)))])
    picked = df.filter(source_col(column).isin(*claims))
    return picked.withColumn(out, F.explode(F.try_element_at(known, source_col(column))))


def write_routed(df: DataFrame, path: str, by: str = "target") -> None:
    """Write all targets from one scan, each into its own folder; no shuffle, so a large target stays spread."""
    df.write.partitionBy(by).parquet(path)
