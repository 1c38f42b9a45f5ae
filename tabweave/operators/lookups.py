"""Lookups: every dimension is reduced to one row per key, then joined from the left.

Id maps grow with the data, so they are not hinted for broadcast: Spark broadcasts a side it knows to be small,
and adaptive execution splits the hot keys of a large left side. Vocabularies are counted first, and broadcast
if they are within the bound.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.text import key_text, source_col, target_id
from tabweave.session import BROADCAST_ROWS, bounded_broadcast, materialize

_KEY, _HIT = "_lookup_key", "_lookup_hit"

# Partitions that rows without a key are spread over.
SALTS = 4096


def _as_text(key: Column, collation: str | None) -> Column:
    return F.collate(key.cast("string"), collation) if collation else key.cast("string")


def one_per_key(dimension: DataFrame, key: Column, hit: Column, collation: str | None = None) -> DataFrame:
    """Reduce a dimension to its least hit per key, partly before the shuffle. Keys are compared as text."""
    return dimension.select(_as_text(key, collation).alias(_KEY), hit.alias(_HIT)).filter(F.col(_KEY).isNotNull()).groupBy(_KEY).agg(
        F.min(_HIT).alias(_HIT)
    )


def left_lookup(
    df: DataFrame, key: Column, dimension: DataFrame, out: str, spread: Column | None = None, collation: str | None = None
) -> DataFrame:
    """Add ``out``: the hit of ``key`` in a dimension made by :func:`one_per_key`, NULL on a miss.

    Optional references leave many rows without a key. With ``spread``, any column that varies, these
    rows go to many partitions instead of the one of NULL; the salt is no key of the dimension.
    """
    asked = _as_text(_asked(key, spread), collation)
    return df.join(dimension, asked == F.col(_KEY), "left").withColumnRenamed(_HIT, out).drop(_KEY)


def _asked(key: Column, spread: Column | None) -> Column:
    key = key.cast("string")
    if spread is None:
        return key
    salt = F.concat(F.lit("\x00no key "), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("string"))
    return F.coalesce(key, salt)


def entities_of(
    entities: DataFrame, entity_type: str, value_key: str, bundle: str | None = None, bundle_key: str | None = None
) -> DataFrame:
    """The rows of an entity table ``(entity_type, bundle_key, bundle, value_key, value, id)`` a lookup may hit."""
    picked = entities.filter((F.col("entity_type") == entity_type) & (F.col("value_key") == value_key))
    if bundle is not None:
        picked = picked.filter(F.col("bundle") == bundle)
    if bundle_key is not None:
        picked = picked.filter(F.col("bundle_key") == bundle_key)
    return picked


def entity_lookup(
    df: DataFrame,
    value: str,
    entities: DataFrame,
    out: str,
    ignore_case: bool = False,
    row_key: str | None = None,
    collation: str | None = None,
) -> DataFrame:
    """Value to entity id, for ``entities`` with ``value`` and ``id`` columns; the least id of several.

    Values are the same if a named ``collation`` says so, such as ``UNICODE_CI_AI``, under which neither case nor
    accents count; else letter by letter, or with ``ignore_case`` in lower case.

    A list of values becomes the list of its hits, for which ``row_key`` must tell the rows apart.
    """
    fold = F.lower if ignore_case and not collation else (lambda c: c)
    dimension = one_per_key(entities, fold(F.col("value")), F.col("id"), collation)
    # A vocabulary is counted, up to the bound, so that a small one costs no shuffle of the rows.
    rows = dimension.limit(BROADCAST_ROWS + 1).count()
    dimension = bounded_broadcast(dimension, rows)
    if df.schema[value].dataType.typeName() != "array":
        spread = source_col(row_key) if row_key else None
        return left_lookup(df, fold(source_col(value)), dimension, out, spread, collation)
    # A row's own values only, as many as its cell holds.
    parts = df.select(F.col(row_key).alias("_row_key"), F.posexplode(source_col(value)).alias("_at", "_part"))
    hits = left_lookup(parts, fold(F.col("_part")), dimension, "_id", collation=collation).filter(F.col("_id").isNotNull())
    listed = hits.groupBy("_row_key").agg(F.array_sort(F.collect_list(F.struct("_at", "_id"))).alias("_ids"))
    listed = listed.select("_row_key", F.transform("_ids", lambda s: s["_id"]).alias(out))
    return df.join(listed, F.col(row_key) == F.col("_row_key"), "left").drop("_row_key")


def only_asked(known: DataFrame, key: str, df: DataFrame, asked: Column) -> DataFrame:
    """The rows of ``known`` that the few rows of ``df`` ask for; ``known`` is scanned and not shuffled."""
    keys = df.select(asked.cast("string").alias("_asked")).filter(F.col("_asked").isNotNull()).distinct()
    return known.join(F.broadcast(keys), source_col(key).cast("string") == F.col("_asked"), "left_semi")


def id_map_of(id_map: DataFrame, migration: str, df: DataFrame | None = None, asked: Column | None = None) -> DataFrame:
    """Known ids of one job as a dimension, or those that ``df`` asks for; rows without a target do not count."""
    rows = id_map.filter((F.col("migration") == migration) & F.col("dest_id").isNotNull())
    rows = rows if df is None else only_asked(rows, "src_key", df, asked)
    return one_per_key(rows, F.col("src_key"), F.col("dest_id"))


def migration_lookup(
    df: DataFrame,
    value: Sequence[str] | str,
    id_map: DataFrame,
    migrations: Sequence[str] | str,
    out: str,
    source_ids: Mapping[str, Sequence[str]] | None = None,
    row_key: str | None = None,
    own: tuple[str, DataFrame] | None = None,
    few: bool = False,
) -> DataFrame:
    """Source key to target id through the id maps of other jobs; the first hit in listed order.

    Each map may be asked with key columns of its own, ``source_ids``; all others with ``value``.
    ``own`` is the running job and the rows of its sheet, which count as known to that job. If there are ``few``
    rows, so that their keys can be broadcast, they are written once and a map is cut down to what they ask before
    it is joined, instead of being shuffled whole.
    """
    names = [migrations] if isinstance(migrations, str) else list(migrations)
    columns = [value] if isinstance(value, str) else list(value)
    spread = source_col(row_key) if row_key else None
    hits = []
    df = materialize(df, "asking") if few and id_map is not None else df
    asking = df if few else None
    for i, name in enumerate(names):
        asked = list((source_ids or {}).get(name, columns))
        key = F.when(
            F.coalesce(*[F.when(source_col(c).isNotNull(), F.lit(True)) for c in asked]),
            key_text([source_col(c) for c in asked]),
        )
        if id_map is not None:
            df = left_lookup(df, key, id_map_of(id_map, name, asking, key), f"_hit_{i}", spread)
            hits.append(f"_hit_{i}")
        if own is not None and own[0] == name:
            df = df.withColumn(f"_key_{i}", key)
            df = self_lookup(df, f"_key_{i}", own[1], name, f"_own_{i}", row_key).drop(f"_key_{i}")
            hits.append(f"_own_{i}")
    return df.withColumn(out, F.coalesce(*hits)).drop(*hits)


def self_lookup(
    df: DataFrame, parent: str, rows: DataFrame, migration: str, out: str, row_key: str | None = None
) -> DataFrame:
    """Reference to another row of the same sheet, whatever the order: ``rows`` holds the sheet's ``src_key``.

    Only keys are shuffled; the id follows from the key.
    """
    keys = rows.select(F.col("src_key").alias(_KEY)).filter(F.col(_KEY).isNotNull()).distinct()
    asked = _asked(source_col(parent), source_col(row_key) if row_key else None)
    found = df.join(keys.withColumn(_HIT, F.lit(True)), asked == F.col(_KEY), "left")
    made = target_id(F.lit(migration), source_col(parent).cast("string"))
    return found.withColumn(out, F.when(F.col(_HIT), made)).drop(_KEY, _HIT)


def stubs(references: DataFrame, known: DataFrame, key: str = "src_key") -> DataFrame:
    """Distinct referenced keys that no known row has, each flagged as a stub."""
    wanted = references.select(key).filter(F.col(key).isNotNull()).distinct()
    return wanted.join(known.select(key).distinct(), key, "left_anti").withColumn("is_stub", F.lit(True))


def with_stubs(rows: DataFrame, references: DataFrame, key: str = "src_key") -> DataFrame:
    """Rows followed by the stubs their references need."""
    return rows.withColumn("is_stub", F.lit(False)).unionByName(stubs(references, rows, key), allowMissingColumns=True)


def members(*values: Column) -> Column:
    """Several single lookups as one list; the field is skipped when nothing was found."""
    found = F.array_compact(F.array(*values))
    return F.when(F.size(found) > 0, found)


def load_entity(
    df: DataFrame, value: str, targets: DataFrame, out: str, id_column: str = "id", row_key: str | None = None, few: bool = False
) -> DataFrame:
    """Target id to the full row it names, as a struct. Ids are unique in a target table.

    If there are ``few`` rows, the targets are cut down to those they name before they are joined.
    """
    if few:
        df = materialize(df, "asking")
        targets = only_asked(targets, id_column, df, source_col(value))
    rows = targets.select(source_col(id_column).cast("string").alias(_KEY), F.struct("*").alias(out))
    asked = _asked(source_col(value), source_col(row_key) if row_key else None)
    return df.join(rows, asked == F.col(_KEY), "left").drop(_KEY)
