"""The mapping catalog as tables.

``groups(grp, tags)``, ``migrations(migration, grp, tags)``,
``steps(migration, dest, weight, pos, plugin, sources, lookup_migrations)``, ``depends(migration, requires)``
and ``requests(id, label, active, file, sheet, original_mapping, owner)``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.constants import (
    DERIVED_MARK,
    DERIVED_TAG,
    GROUP_NAME_FORMAT,
    MIGRATION_NAME_FORMAT,
    ORPHANS_TAG,
    REQUEST_TAG_FORMAT,
    TEMPLATE_TAG,
)
from tabweave.operators.numbering import HOT_ROWS, running_number


def filled(pattern: str, **parts: Column) -> Column:
    """A name format with columns in its places."""
    pieces, rest = [], pattern
    while rest:
        text, brace, tail = rest.partition("{")
        if text:
            pieces.append(F.lit(text))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        pieces.append(parts[name].cast("string"))
    return F.concat(*pieces)


def group_name(request: Column) -> Column:
    return filled(GROUP_NAME_FORMAT, request=request)


def migration_name(group: Column, migration: Column) -> Column:
    return filled(MIGRATION_NAME_FORMAT, group=group, migration=migration)


def request_tag(request: Column) -> Column:
    return filled(REQUEST_TAG_FORMAT, request=request)


def templates(groups: DataFrame) -> DataFrame:
    """Groups offered as templates: tagged so, and not derived themselves."""
    tags = F.col("tags")
    return groups.filter(
        F.coalesce(F.array_contains(tags, TEMPLATE_TAG) & ~F.array_contains(tags, DERIVED_TAG), F.lit(False))
    )


def manages_orphans(migrations: DataFrame) -> DataFrame:
    return migrations.filter(F.coalesce(F.array_contains("tags", ORPHANS_TAG), F.lit(False)))


def mapping_of(
    fields: DataFrame,
    group: str | None = None,
    by: str = "grp",
    order: Sequence[str] = ("migration", "pos"),
    name: str = "weight",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Destinations of a group, or of all groups, with a weight that runs on across their migrations."""
    picked = fields if group is None else fields.filter(F.col(by) == group)
    numbered = running_number(picked, [by], order, name, hot_rows)
    return numbered.withColumn(name, F.col(name) - 1)


def used_columns(steps: DataFrame, by: Sequence[str] = ("migration",)) -> DataFrame:
    """Source columns the steps read, one row per use; ``@`` references are left out, duplicates stay."""
    reads = F.coalesce("sources", F.array().cast("array<string>"))
    if "source_ids" in steps.columns:
        asked = F.flatten(F.map_values(F.coalesce("source_ids", F.create_map().cast("map<string,array<string>>"))))
        reads = F.when(F.col("plugin") == "migration_lookup", F.concat(reads, asked)).otherwise(reads)
    return steps.select(*by, F.explode(reads).alias("source_column")).filter(~F.col("source_column").startswith("@"))


def derive_migrations(requests: DataFrame, migrations: DataFrame) -> DataFrame:
    """The jobs of each active request: its group's migrations under derived names and tags."""
    active = requests.filter("active").select(
        F.col("id").alias("request"), "owner", F.split_part("original_mapping", F.lit(":"), F.lit(2)).alias("grp")
    )
    jobs = active.join(migrations, "grp")
    group = group_name(F.col("request"))
    own = F.array(F.lit(DERIVED_MARK), F.lit(DERIVED_TAG), request_tag(F.col("request")))
    tags = F.array_distinct(F.concat(F.coalesce("tags", F.array().cast("array<string>")), own))
    return jobs.select(
        "request",
        "owner",
        F.col("migration").alias("original"),
        group.alias("grp"),
        migration_name(group, F.col("migration")).alias("migration"),
        tags.alias("tags"),
    )


def derive_lookups(lookups: DataFrame, migrations: DataFrame, request: Column) -> DataFrame:
    """Lookup references ``(migration, lookup)`` under their new names.

    A reference to the same group is renamed, any other is left alone.
    """
    groups = migrations.select(F.col("migration").alias("lookup"), F.col("grp").alias("_lookup_grp")).distinct()
    named = lookups.join(migrations.select("migration", "grp"), "migration").join(groups, "lookup", "left")
    same = F.coalesce(F.col("grp") == F.col("_lookup_grp"), F.lit(False))
    group = group_name(request)
    return named.select(
        *lookups.columns,
        migration_name(group, F.col("migration")).alias("derived_migration"),
        F.when(same, migration_name(group, F.col("lookup"))).otherwise(F.col("lookup").cast("string")).alias("derived_lookup"),
    )


def derive_dependencies(depends: DataFrame, migrations: DataFrame, request: Column) -> DataFrame:
    """Dependencies ``(migration, requires)`` under their new names; those outside the group are dropped."""
    groups = migrations.select("migration", "grp")
    other = groups.select(F.col("migration").alias("requires"), F.col("grp").alias("_requires_grp"))
    inside = depends.join(groups, "migration").join(other, "requires").filter(F.col("grp") == F.col("_requires_grp"))
    group = group_name(request)
    return inside.select(
        *depends.columns,
        migration_name(group, F.col("migration")).alias("derived_migration"),
        migration_name(group, F.col("requires")).alias("derived_requires"),
    )


def unused_destinations(properties: DataFrame, mappings: DataFrame, on: Sequence[str]) -> DataFrame:
    """Target properties that no mapping fills."""
    return properties.join(mappings.select(*on).distinct(), list(on), "left_anti")


def auto_map(unused: DataFrame, sources: DataFrame, on: Sequence[str]) -> DataFrame:
    """Unused target properties that a source column of the same name can fill by a plain copy."""
    return unused.join(sources, list(on)).withColumn("plugin", F.lit("get"))


def dangling_refs(mappings: DataFrame, removed: DataFrame, dest: str = "dest", source: str = "source") -> DataFrame:
    """Mappings that would remain although the mapping they read is removed."""
    gone = removed.select(F.col(dest).alias(source)).distinct()
    return mappings.join(removed.select(dest).distinct(), dest, "left_anti").join(gone, source, "left_semi")


def available_sources(layers: Sequence[DataFrame], by: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """What a mapping may read, from several layers of one shape; of equal names the later layer wins.

    The winner is an aggregate that combines before the shuffle, so no name gathers its rows in one task.
    """
    stacked = None
    for priority, layer in enumerate(layers):
        part = layer.select(*by, *payload).withColumn("_priority", F.lit(priority))
        stacked = part if stacked is None else stacked.unionByName(part)
    last = stacked.groupBy(*by).agg(F.max_by(F.struct(*payload), "_priority").alias("_last"))
    return last.select(*by, *[F.col("_last")[c].alias(c) for c in payload])


def is_protected(name: Column, prefixes: Sequence[str]) -> Column:
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | name.startswith(prefix)
    return hit


def sync_export(items: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Catalog items ``(name, body)`` fit to leave: names under the protected prefixes stay home."""
    return items.filter(~is_protected(F.col("name"), prefixes))


def sync_import(inbound: DataFrame, current: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Inbound catalog items, with all protected items exactly as they are now."""
    protected = is_protected(F.col("name"), prefixes)
    return inbound.filter(~protected).unionByName(current.filter(protected))


@dataclass(frozen=True)
class Permissions:
    """The permission for each operation on an own request, that to create one, and that to do all."""

    operations: Mapping[str, str]
    create: str
    admin: str


def job_mapping(steps: DataFrame, migration: str) -> dict[str, list[dict]]:
    """The mapping of one job from catalog rows ``(migration, dest, weight, pos, plugin, sources, options)``.

    Destinations come by weight, their steps by ``pos``. ``options`` maps names to JSON texts; one source is a name,
    several are a list. The rows of one job, a few for each of its fields, come to the driver.
    """
    rows = steps.filter(F.col("migration") == migration)
    mapping: dict[str, list[dict]] = {}
    for row in sorted(rows.collect(), key=lambda r: (r.weight, r.dest, r.pos)):
        step = {"plugin": row.plugin, **{k: json.loads(v) for k, v in (row.options or {}).items()}}
        if row.sources:
            step["source"] = row.sources[0] if len(row.sources) == 1 else list(row.sources)
        mapping.setdefault(row.dest, []).append(step)
    if not mapping:
        raise ValueError(f"The catalog has no steps of {migration}")
    return mapping


def derived_access(items: DataFrame, user: Column) -> DataFrame:
    """Derived groups or migrations ``(tags, owner)`` the user owns."""
    derived = F.coalesce(F.array_contains("tags", DERIVED_TAG), F.lit(False))
    return items.filter(derived & F.coalesce(F.col("owner") == user, F.lit(False)))


def check_access(checks: DataFrame, requests: DataFrame, grants: DataFrame, permissions: Permissions) -> DataFrame:
    """The allowed ones of ``checks(user, id, operation)``, for ``grants(user, permission)``.

    An owner needs the permission of the operation; to ``create`` needs no ownership; an administrator may do all.
    """
    needed = {**permissions.operations, "create": permissions.create}
    table = F.create_map(*[F.lit(x) for op, p in needed.items() for x in (op, p)])
    asked = checks.withColumn("permission", F.try_element_at(table, F.col("operation")))
    owned = requests.select("id", F.col("owner").alias("user"))
    held = grants.select("user", "permission").distinct()
    granted = asked.join(held, ["user", "permission"], "left_semi")
    own = granted.filter(F.col("operation") != "create").join(owned, ["id", "user"], "left_semi")
    made = granted.filter(F.col("operation") == "create")
    ruled = asked.join(held.filter(F.col("permission") == permissions.admin), "user", "left_semi")
    return own.unionByName(made).unionByName(ruled).select("user", "id", "operation").distinct()


def may(requests: DataFrame, user: str, operation: str, granted: Sequence[str], permissions: Permissions) -> DataFrame:
    """Requests on which one user may do an operation, given the user's permissions."""
    if permissions.admin in granted:
        return requests
    if operation not in permissions.operations or permissions.operations[operation] not in granted:
        return requests.filter(F.lit(False))
    return requests.filter(F.col("owner") == user)


def request_dependencies(requests: DataFrame, mappings: DataFrame, migrations: DataFrame) -> DataFrame:
    """What each request depends on: its original migrations that still exist, and its group.

    ``mappings(id, original_migration)``; the group is named by ``original_mapping`` as ``type:group``.
    """
    kind = F.split_part("original_mapping", F.lit(":"), F.lit(1))
    known = F.when(kind == "migration_group", F.split_part("original_mapping", F.lit(":"), F.lit(2)))
    group = F.coalesce(known, F.raise_error(F.concat(F.lit("Unknown type of original mapping: "), kind)).cast("string"))
    existing = (
        mappings.select("id", F.col("original_migration").alias("migration"))
        .distinct()
        .join(migrations.select("migration").distinct(), "migration", "left_semi")
    )
    return existing.select("id", F.lit("migration").alias("type"), F.col("migration").alias("name")).unionByName(
        requests.select("id", F.lit("migration_group").alias("type"), group.alias("name"))
    )


def rederive(catalog: DataFrame, derived: DataFrame, requests: DataFrame) -> DataFrame:
    """The catalog after requests changed: rows ``(grp, …)`` of every touched group give way to its new rows.

    ``requests(grp, active)`` are the touched groups; an inactive group only loses its rows.
    """
    touched = requests.select("grp").distinct()
    active = requests.filter("active").select("grp").distinct()
    fresh = derived.join(active, "grp", "left_semi")
    return catalog.join(touched, "grp", "left_anti").unionByName(fresh)
