"""Running numbers that survive hot groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabweave.functions.text import source_col
from tabweave.session import materialize

# A group with more rows than this is numbered by many tasks.
HOT_ROWS = 1_000_000

_POS = "_pos"
_RANGE = "_range"


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with its group columns out of the way of the frame it is joined back to."""
    return df.withColumnsRenamed({n: f"_of_{n}" for n in names})


def _same(names: Sequence[str]) -> Column:
    matched = F.lit(True)
    for n in names:
        matched = matched & source_col(n).eqNullSafe(source_col(f"_of_{n}"))
    return matched


def _ranged_number(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str, rows: int, hot_rows: int
) -> DataFrame:
    """Number rows after a range partitioning on (group, order), which also cuts a single group.

    There are as many ranges as keep each near ``hot_rows`` rows, however many rows there are.

    The place of a row in its range is written to a table, so it is fixed once for all readers; the
    rows of a group in earlier ranges, a table with one row per group and range, are then added.
    """
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // hot_rows))
    ordered = df.repartitionByRange(ranges, *groups, *order).sortWithinPartitions(*groups, *order)
    placed = materialize(ordered.withColumn(_POS, F.monotonically_increasing_id()), "numbering")
    # The upper bits of the position are the number of the range.
    placed = placed.withColumn(_RANGE, F.shiftright(_POS, 33))
    counts = placed.groupBy(*groups, _RANGE).agg(F.min(_POS).alias("_first"), F.count(F.lit(1)).alias("_count"))
    before = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first") + 1
    offsets = _renamed(counts.select(*groups, _RANGE, shift.alias("_shift")), [*groups, _RANGE])
    joined = placed.join(offsets, _same([*groups, _RANGE]))
    return joined.select(*map(source_col, df.columns), (F.col(_POS) + F.col("_shift")).alias(name))


def running_number(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Number the rows of each group from 1 by ``order``, which must not tie within a group.

    Groups of usual size take one window. Groups above ``hot_rows`` are numbered by many tasks, so no
    task ever holds more than a range of a group. Without groups, the whole frame is one hot group.
    """
    if not groups:
        return _ranged_number(df, [], order, name, df.count(), hot_rows)
    window = Window.partitionBy(*groups).orderBy(*order)
    # At most rows / hot_rows groups are hot; counting is a pruned scan with partial aggregation.
    hot = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_count")).filter(F.col("_count") > hot_rows)
    rows = hot.agg(F.sum("_count")).first()[0]
    hot = _renamed(hot.select(*groups), groups)
    if rows is None:
        return df.withColumn(name, F.row_number().over(window).cast("bigint"))
    usual = df.join(hot, _same(groups), "left_anti")
    heavy = df.join(hot, _same(groups), "left_semi")
    return usual.withColumn(name, F.row_number().over(window).cast("bigint")).unionByName(
        _ranged_number(heavy, groups, order, name, rows, hot_rows)
    )
