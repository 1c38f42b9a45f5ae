"""Plans of file copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.text import source_col
from tabweave.operators.numbering import HOT_ROWS, running_number
from tabweave.session import materialize

_CLAIM, _NTH, _START, _PLACE = "_claim", "_nth", "_start", "_place"


def _cut(path: Column) -> tuple[Column, Column, Column]:
    """Folder, stem and suffix of a path."""
    folder = F.regexp_extract(path, r"^(.*/)?", 0)
    name = F.substring_index(path, "/", -1)
    suffix = F.regexp_extract(name, r"[^.](\.[^.]+)$", 1)
    return folder, F.substring(name, F.lit(1), F.length(name) - F.length(suffix)), suffix


def clash_name(path: Column, nth: Column) -> Column:
    """The path of the n-th claimant: itself for the first, then ``name_1.ext``, ``name_2.ext``, …"""
    folder, stem, suffix = _cut(path)
    numbered = F.concat(folder, stem, F.lit("_"), (nth - 1).cast("string"), suffix)
    return F.when(nth == 1, path).otherwise(numbered)


def _numbered(paths: DataFrame) -> DataFrame:
    """``(base, k)`` of the ``path``s that look like the k-th further claimant of a base."""
    folder, stem, suffix = _cut(F.col("path"))
    k = F.regexp_extract(stem, r"_([1-9][0-9]{0,8})$", 1)
    base = F.concat(folder, F.regexp_replace(stem, r"_[1-9][0-9]{0,8}$", ""), suffix)
    return paths.select(base.alias("base"), k.alias("k")).filter("k <> ''").select("base", F.col("k").cast("bigint").alias("k"))


def free_numbers(claims: DataFrame, taken: DataFrame, base: str, nth: str, out: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The ``nth`` number, from 1, of those from 0 on that ``taken`` does not hold, as ``out`` of each row of ``claims``.

    ``claims`` has ``base`` and ``nth``, distinct within a base; ``taken`` has distinct ``(base, k)``. The k-th taken
    number has as many free ones before it as its value less its rank. Claimants and taken numbers are merged by
    that count, so a row's running number, less its own, is how many taken ones it has to step over. No group is
    gathered: both running numbers are made by ranges where a group is large.
    """
    rank, at, kind, tie, place = "_rank", "_at", "_kind", "_tie", "_order"
    ranked = running_number(taken.select(base, "k"), [base], ["k"], rank, hot_rows)
    before = ranked.select(base, (F.col("k") - F.col(rank) + 1).alias(at), F.lit(0).alias(kind), F.col("k").alias(tie))
    asks = claims.withColumns({at: F.col(nth) - 1, kind: F.lit(1), tie: F.lit(0).cast("bigint")})
    both = asks.unionByName(before, allowMissingColumns=True)
    merged = running_number(both, [base], [at, kind, tie], place, hot_rows).filter(F.col(kind) == 1)
    return merged.withColumn(out, F.col(place) - 1).drop(at, kind, tie, place)


def number_clashes(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    out: str,
    hot_rows: int = HOT_ROWS,
    given: DataFrame | None = None,
    had: str | None = None,
) -> DataFrame:
    """Give every row of one path a path of its own, in key order.

    Rows without a path are groups of their own, so they gather nowhere. Names that another row asks for as they
    are, such as ``a_1.png``, are left to that row. ``given`` has the paths ``to`` that are taken already; numbers go
    on behind them. Where the column ``had`` has a path, the row keeps it.
    """
    alone = F.concat_ws("\x00", F.lit(""), *order)
    asks = F.col(path) if had is None else F.when(F.col(had).isNull(), F.col(path))
    grouped = df.withColumn(_CLAIM, F.coalesce(asks, alone))
    numbered = running_number(grouped, [_CLAIM], order, _NTH, hot_rows)
    start = F.lit(0).cast("bigint")
    if given is not None:
        taken = given.select(F.col("to").alias("path")).distinct()
        taken = taken.select(F.col("path").alias("base"), F.lit(0).cast("bigint").alias("k")).unionByName(_numbered(taken))
        taken = taken.groupBy(F.col("base").alias("_base")).agg((F.max("k") + 1).alias("_start"))
        numbered = numbered.join(taken, F.col(_CLAIM) == F.col("_base"), "left").drop("_base")
        start = F.coalesce(F.col("_start"), start)
    numbered = numbered.withColumn(_START, start)
    # Numbers that are asked for as part of a name, of the names that some row claims; usually there are none.
    names = df.select(F.col(path).alias("path")).filter("path IS NOT NULL").distinct()
    asked = materialize(_numbered(names).distinct(), "asked")
    if asked.isEmpty():
        placed = numbered.withColumn(_PLACE, F.col(_START) + F.col(_NTH) - 1)
    else:
        numbered = materialize(numbered, "claims")
        starts = numbered.groupBy(_CLAIM).agg(F.max(_START).alias(_START))
        behind = asked.withColumnRenamed("base", _CLAIM).join(starts, _CLAIM).filter(F.col("k") >= F.col(_START))
        behind = materialize(behind.select(_CLAIM, (F.col("k") - F.col(_START)).alias("k")), "asked")
        held = behind.select(_CLAIM).distinct()
        usual = numbered.join(held, _CLAIM, "left_anti").withColumn(_PLACE, F.col(_NTH) - 1)
        stepped = free_numbers(numbered.join(held, _CLAIM, "left_semi"), behind, _CLAIM, _NTH, _PLACE, hot_rows)
        placed = usual.unionByName(stepped).withColumn(_PLACE, F.col(_START) + F.col(_PLACE))
    named = clash_name(F.col(path), F.col(_PLACE) + 1)
    named = named if had is None else F.coalesce(F.col(had), named)
    return placed.withColumn(out, named).select(*map(source_col, df.columns), out)


def copy_manifest(
    df: DataFrame, src: str, dest: str, key: Sequence[str], file_exists: str = "rename", move: bool = False
) -> DataFrame:
    """One row per copy: where from, where to, and whether the source goes away."""
    if file_exists == "rename":
        planned = number_clashes(df, dest, key, "copy_to")
    elif file_exists in ("replace", "use existing"):
        planned = df.withColumn("copy_to", F.col(dest))
    else:
        raise ValueError(f"Unknown clash rule {file_exists!r}")
    return planned.select(*key, F.col(src).alias("copy_from"), "copy_to", F.lit(move).alias("move"))
