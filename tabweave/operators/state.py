"""Ingest state as frames: change detection, orphans, rollback, progress, errors.

An id map holds ``(migration, src_key, dest_id, status, rollback_action, row_hash)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.constants import FAILED, IGNORED, NEEDS_UPDATE, ROLLBACK_DELETE
from tabweave.functions.text import source_col

NEW, CHANGED, UNCHANGED, GONE = "new", "changed", "unchanged", "gone"

DROP_MAP, DELETE_TARGET, KEEP_TARGET = "drop_map", "delete_target", "keep_target"


def classify_rows(source: DataFrame, known: DataFrame, key: str = "src_key", digest: str = "row_hash") -> DataFrame:
    """Compare a sheet with its id map by key and hash, as ``(key, change)``.

    A known row marked for update counts as changed.
    """
    return _compared(source, known, key, digest).select(key, "change")


def _compared(source: DataFrame, known: DataFrame, key: str, digest: str) -> DataFrame:
    """``(key, change, _stale)``; stale are the known rows marked for update.

    Both sides are stacked and aggregated by key, which combines before the shuffle and needs no join.
    """
    # Two numbers stand for a digest: aggregates over numbers hash, those over text would have to sort.
    one, two = F.xxhash64(F.lit(1), F.col(digest)), F.xxhash64(F.lit(2), F.col(digest))
    stale = F.col("status") == NEEDS_UPDATE if "status" in known.columns else F.lit(False)
    before = known.select(
        key, F.lit(False).alias("_now"), one.alias("_one"), two.alias("_two"), F.coalesce(stale, F.lit(False)).alias("_stale")
    )
    now = source.select(
        key, F.lit(True).alias("_now"), one.alias("_one"), two.alias("_two"), F.lit(False).alias("_stale")
    )
    is_now = F.col("_now")
    sides = before.unionByName(now).groupBy(key).agg(
        F.max(~is_now).alias("_was"),
        F.max(is_now).alias("_is"),
        F.max(F.when(~is_now, F.col("_one"))).alias("_old_one"),
        F.max(F.when(~is_now, F.col("_two"))).alias("_old_two"),
        F.max(F.when(is_now, F.col("_one"))).alias("_new_one"),
        F.max(F.when(is_now, F.col("_two"))).alias("_new_two"),
        F.max("_stale").alias("_stale"),
    )
    same = F.col("_old_one").eqNullSafe(F.col("_new_one")) & F.col("_old_two").eqNullSafe(F.col("_new_two"))
    change = (
        F.when(~F.col("_is"), GONE)
        .when(~F.col("_was"), NEW)
        .when(F.col("_stale") | ~same, CHANGED)
        .otherwise(UNCHANGED)
    )
    return sides.select(key, change.alias("change"), "_stale")


def rows_to_import(
    source: DataFrame,
    known: DataFrame,
    key: str = "src_key",
    digest: str = "row_hash",
    track_changes: bool = True,
    update: bool = False,
    limit: int = 0,
) -> DataFrame:
    """The sheet's rows an import has to process.

    ``update`` takes all known rows again, ``limit`` the first rows by key; 0 means no limit. Rows marked for
    update, stubs among them, are taken whether changes are tracked or not.
    """
    if not update:
        changes = _compared(source, known, key, digest)
        wanted = [NEW, CHANGED] if track_changes else [NEW]
        taken = F.col("change").isin(*wanted) | (F.col("_stale") & (F.col("change") == CHANGED))
        source = source.join(changes.filter(taken).select(key), key, "left_semi")
    if limit:
        source = source.orderBy(F.col(key).try_cast("bigint"), key).limit(limit)
    return source


def last_rows(sheet: DataFrame, order: str, key: str = "src_key") -> DataFrame:
    """Of rows with one key only the last by ``order``, as a later row of a sheet updates an earlier one.

    Keys are counted first, without the rows; only if some repeat are rows joined with the few that do.
    """
    repeated = sheet.groupBy(key).agg(F.count(F.lit(1)).alias("_count"), F.max(order).alias("_last"))
    repeated = repeated.filter(F.col("_count") > 1).select(F.col(key).alias("_key"), "_last")
    if repeated.isEmpty():
        return sheet
    same = F.col(key).eqNullSafe(F.col("_key"))
    single = sheet.join(repeated, same, "left_anti")
    last = sheet.join(repeated, same & F.col(order).eqNullSafe(F.col("_last"))).select(sheet.columns)
    return single.unionByName(last.dropDuplicates([key]))


def orphans(id_map: DataFrame, source: DataFrame, key: str = "src_key") -> DataFrame:
    """Id-map rows whose source key left the sheet."""
    return id_map.join(source.select(key).distinct(), key, "left_anti")


def status_filter(id_map: DataFrame, statuses: Sequence[str] | str = (FAILED, IGNORED)) -> DataFrame:
    """Id-map rows in one of the given states, a list or a comma list."""
    names = [s.strip() for s in statuses.split(",")] if isinstance(statuses, str) else list(statuses)
    return id_map.filter(F.col("status").isin(*names))


def rollback_action() -> Column:
    """What the rollback of an id-map row does, besides removing the row itself."""
    undo = F.col("rollback_action").isNull() | (F.col("rollback_action") == ROLLBACK_DELETE)
    return F.when(F.col("dest_id").isNull(), DROP_MAP).when(undo, DELETE_TARGET).otherwise(KEEP_TARGET)


def rollback_plan(id_map: DataFrame, statuses: Sequence[str] | str | None = None) -> DataFrame:
    rows = id_map if statuses is None else status_filter(id_map, statuses)
    return rows.withColumn("action", rollback_action())


def rolled_back(id_map: DataFrame, statuses: Sequence[str] | str | None = None) -> tuple[DataFrame, DataFrame]:
    """What a rollback takes away: the ``dest_id`` of targets, and the ``(migration, src_key)`` of id-map rows."""
    plan = rollback_plan(id_map, statuses)
    doomed = plan.filter(F.col("action") == DELETE_TARGET).select("dest_id").distinct()
    if statuses is None:
        return doomed, id_map.select("migration", "src_key")
    # A row without a target goes alone; a row with one takes all map rows of that target along.
    done = plan.filter(F.col("action") != DROP_MAP).select("dest_id").distinct()
    dropped = plan.filter(F.col("action") == DROP_MAP).select("migration", "src_key")
    return doomed, id_map.join(done, "dest_id", "left_semi").select("migration", "src_key").unionByName(dropped)


def rollback(
    id_map: DataFrame, target: DataFrame, statuses: Sequence[str] | str | None = None, id_column: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """The target and the id map as they are after a rollback."""
    doomed, dropped = rolled_back(id_map, statuses)
    kept_rows = target.join(doomed.withColumnRenamed("dest_id", id_column), id_column, "left_anti")
    if statuses is None:
        return kept_rows, id_map.limit(0)
    kept_map = id_map.join(dropped, ["migration", "src_key"], "left_anti")
    return kept_rows, kept_map.select(id_map.columns)


def progress(id_map: DataFrame) -> DataFrame:
    """Row counts per job and status, per job, and over all; sums are marked by NULL names.

    Rows are counted once; the group totals are made from the few counts.
    """
    counts = id_map.groupBy("migration", "status").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.rollup("migration", "status").agg(F.sum("n_rows").alias("n_rows"))


def progress_ratio(id_map: DataFrame, totals: DataFrame) -> DataFrame:
    """``done / total`` per job, for ``totals(migration, total)``; an empty job is finished."""
    done = id_map.groupBy("migration").agg(F.count(F.lit(1)).alias("done"))
    counted = totals.join(done, "migration", "left").withColumn("done", F.coalesce("done", F.lit(0)))
    ratio = F.when(F.col("total") == 0, F.lit(1.0)).otherwise(F.col("done") / F.col("total"))
    return counted.withColumn("finished", ratio)


def isolate_errors(df: DataFrame, casts: Mapping[str, tuple[str, str]], error: str = "error") -> DataFrame:
    """Cast columns without ever raising: ``out: (source, type)``; the first bad cell becomes the row's error."""
    outs, problems = {}, []
    for out, (column, kind) in casts.items():
        value = source_col(column).try_cast(kind)
        outs[out] = value
        words = F.concat(F.lit(f"Not of type {kind}: "), source_col(column).cast("string"))
        problems.append(F.when(value.isNull() & source_col(column).isNotNull(), words))
    return df.withColumns({**outs, error: F.coalesce(*problems)})
