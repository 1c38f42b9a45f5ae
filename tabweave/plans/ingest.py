"""Import and rollback of jobs and of groups of jobs."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.constants import FAILED, IMPORTED, KEY_SEPARATOR, NEEDS_UPDATE, ORPHANS_TAG
from tabweave.functions.steps import Context
from tabweave.functions.text import row_hash, source_col, target_id
from tabweave.operators import hashtree, state
from tabweave.operators.routing import default_bundle
from tabweave.plans.compiler import (
    COPIES,
    MESSAGES,
    REPORT,
    STATUS,
    STUBS,
    asks_for_stubs,
    compile_mapping,
    ends_after_own,
    plans_copies,
)
from tabweave.plans.ordering import levels_of
from tabweave.plans.store import ID_MAP, Store
from tabweave.plans.store import COPIES as COPY_ROWS
from tabweave.plans.store import MESSAGES as MESSAGE_ROWS
from tabweave.session import BROADCAST_ROWS, bounded_broadcast
from tabweave.sources.delimited import with_keys

# Id maps of more bytes than this are cut down to what the few rows of an incremental import ask.
LARGE_MAPS = 64 << 20

_ERROR, _HASH, _CAST = "_key_error", "_sheet_row_hash", "_cast_error"


@dataclass
class Job:
    """One derived migration: a sheet, its key, the mapping, and the type of its target."""

    name: str
    mapping: Mapping
    target: str
    keys: Mapping[str, str]
    requires: Sequence[str] = ()
    default_bundle: str | None = None
    tags: Sequence[str] = ()
    track_changes: bool = True
    rollback_action: str | None = None
    # A derived job keeps its keys instead of taking those of the request's template.
    keep_source: bool = False
    # Spark types of target fields; a row with a cell that is not of its type fails alone.
    types: Mapping[str, str] = field(default_factory=dict)


@dataclass
class Options:
    """``limit`` 0 is off; ``update`` takes known rows again; ``force`` ignores unmet requirements."""

    limit: int = 0
    update: bool = False
    force: bool = False
    run_ts: datetime.datetime | None = None
    allowed_paths: Sequence[str] = ()
    allowed_schemes: Sequence[str] = ()
    strict_paths: bool = False


@dataclass
class Group:
    """The jobs of one request over one sheet, with the tables their lookups may use.

    ``row_column`` names the sheet's column of row numbers, which is no cell: of rows with one key the
    last wins. Without it the choice among them is arbitrary, but the same on every run.
    """

    jobs: Sequence[Job]
    sheet: DataFrame
    row_column: str | None = None
    entities: DataFrame | None = None
    files: DataFrame | None = None
    _staged: dict = field(default_factory=dict)

    def levels(self) -> list[list[Job]]:
        by_name = {j.name: j for j in self.jobs}
        return [[by_name[n] for n in level] for level in levels_of({j.name: j.requires for j in self.jobs})]


def staged_sheet(store: Store, group: Group) -> DataFrame:
    """The parsed sheet with its row hashes as a table, made once for all jobs of the group.

    Each job then reads the hash and the columns it maps, not the whole sheet.
    """
    if group._staged.get("root") != store.root:
        group._staged.clear()
        group._staged["root"] = store.root
    if "sheet" not in group._staged:
        path = store.staging("sheet")
        cells = [source_col(c) for c in group.sheet.columns if c != group.row_column]
        hashed = group.sheet.withColumn(_HASH, row_hash(cells))
        hashed.write.parquet(path)
        group._staged["path"] = path
        group._staged["sheet"] = store.spark.read.schema(hashed.schema).parquet(path)
    return group._staged["sheet"]


def release_sheet(store: Store, group: Group) -> None:
    """Give the staged sheet up; a later import stages the sheet as it is then."""
    if "path" in group._staged:
        store.discard(group._staged["path"])
    group._staged.clear()


def _context(store: Store, group: Group, job: Job, options: Options) -> Context:
    targets: dict[str, DataFrame] = {}
    for other in group.jobs:
        rows = store.read(f"targets/{other.target}", other.name)
        if rows is not None:
            known = targets.get(other.target)
            targets[other.target] = rows if known is None else known.unionByName(rows, allowMissingColumns=True)
    extra = {} if options.run_ts is None else {"run_ts": options.run_ts}
    return Context(
        migration=job.name,
        allowed_paths=options.allowed_paths,
        allowed_schemes=options.allowed_schemes,
        strict_paths=options.strict_paths,
        entities=group.entities,
        id_map=store.all_rows("id_map", ID_MAP),
        targets=targets,
        files=group.files,
        stub_jobs=[other.name for other in group.jobs],
        copies=store.all_rows("copies", COPY_ROWS) if plans_copies(job.mapping) and store.exists(f"{store.root}/copies") else None,
        **extra,
    )


def _keyed(store: Store, group: Group, job: Job) -> DataFrame:
    """The sheet's rows by key, the last of each. Rows without any key go by their number, or their hash."""
    keyed = with_keys(staged_sheet(store, group).withColumnRenamed(_HASH, "row_hash"), job.keys, error=_ERROR)
    number = F.col("row_hash") if group.row_column is None else source_col(group.row_column).cast("string")
    bad = F.col(_ERROR).isNotNull() & (F.coalesce(F.replace("src_key", F.lit(KEY_SEPARATOR), F.lit("")), F.lit("")) == "")
    keyed = keyed.withColumn(_ERROR, F.when(bad, F.concat(F.lit("Row "), number, F.lit(": "), F.col(_ERROR))).otherwise(F.col(_ERROR)))
    keyed = keyed.withColumn("src_key", F.when(bad, F.concat(F.lit("row "), number)).otherwise(F.col("src_key")))
    # Jobs with the same key columns need to look for repeated keys once only.
    known = ("unique", *job.keys.items())
    if known in group._staged:
        return keyed
    last = state.last_rows(keyed, group.row_column or "row_hash")
    if last is keyed:
        group._staged[known] = True
    return last


def import_job(store: Store, group: Group, job: Job, options: Options | None = None) -> None:
    """Bring a job's target, id map and messages up to date with its sheet.

    The pipelines run once, into a staging table; all that is kept derives from that table, so a run
    that is repeated after a failure gives the same rows and ids.
    """
    options = options or Options()
    sheet, known = _keyed(store, group, job), store.id_map(job.name)
    tree, leaves, within = None if options.update else store.tree(job.name), None, F.lit(True)
    if tree is not None:
        # Ranges of keys in which nothing changed are neither read nor joined.
        leaves = hashtree.differing_ranges(sheet, tree)
        within = hashtree.in_ranges(F.col("src_key"), tree.lows, leaves)
    part, known = sheet.filter(within), known.filter(within)
    # A first import has nothing to compare with, so nothing is shuffled for it.
    todo = state.rows_to_import(
        part,
        known,
        track_changes=job.track_changes,
        update=options.update or not store.has("id_map", job.name),
        limit=options.limit,
    )
    compared = None
    if store.has("id_map", job.name):
        # What is to be imported again is read several times; the comparison with the id map runs once.
        compared = store.staging(f"{job.name}-todo")
        todo.write.parquet(compared)
        todo = store.spark.read.schema(todo.schema).parquet(compared)
    context = _context(store, group, job, options)
    context.few = compared is not None and store.bytes_of("id_map") > LARGE_MAPS and todo.count() <= BROADCAST_ROWS
    good, imported = todo.filter(F.col(_ERROR).isNull()), None
    while True:
        result = compile_mapping(good, job.mapping, context, ["src_key", "row_hash"])
        if not ends_after_own(job.mapping, job.name):
            break
        # Rows may end because of what they refer to; those that referred to them are looked at again, until
        # the rows that stay are the rows that were referred to. Each round goes a step along the references.
        path = store.staging(f"{job.name}-kept")
        result.filter(F.col(STATUS) == IMPORTED).select("src_key").write.parquet(path)
        context.own = store.spark.read.schema("src_key string").parquet(path)
        before, imported = imported, context.own.count()
        if imported == before:
            break
    values = [c for c in result.columns if c not in ("src_key", "row_hash", *REPORT)]
    if "bundle" in values and job.default_bundle:
        result = result.withColumn("bundle", default_bundle(F.col("bundle"), job.default_bundle))
    elif job.default_bundle:
        result, values = result.withColumn("bundle", F.lit(job.default_bundle)), [*values, "bundle"]
    if job.types:
        result = typed_fields(result, job.types)
    bad = todo.filter(F.col(_ERROR).isNotNull()).select(
        "src_key",
        "row_hash",
        F.lit(FAILED).alias(STATUS),
        F.array(F.struct(F.lit("error").alias("level"), F.col(_ERROR).alias("text"))).alias(MESSAGES),
    )
    staged = store.staging(job.name)
    result = result.unionByName(bad, allowMissingColumns=True)
    result.write.parquet(staged)
    rows = store.spark.read.schema(result.schema).parquet(staged)
    # Nothing new leaves the tables as they are; a first import makes them even when empty.
    if not store.has("id_map", job.name) or not rows.isEmpty():
        # Stubs first: a run repeated after a failure sees the rows as new until their id map is written.
        if asks_for_stubs(job.mapping) and job.name in _keep_stubs(store, group, rows):
            # Stubs of the job itself may lie in any range.
            known, leaves = store.id_map(job.name).filter(within), None
        _keep_rows(store, job, rows, values, known)
    if ORPHANS_TAG in job.tags:
        remove_orphans(store, job, part, within)
    store.keep_tree(job.name, leaves)
    store.discard(staged)
    if compared is not None:
        store.discard(compared)


def typed_fields(result: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast target fields; a row with a cell that is not of its type fails with a message, and no other row does.

    An empty cell is NULL. Rows that ended for another reason keep theirs.
    """
    absent = [name for name in types if name not in result.columns]
    if absent:
        raise ValueError(f"Fields with a type are not mapped: {', '.join(absent)}")
    cells = {n: F.nullif(source_col(n), F.lit("")) for n in types if result.schema[n].dataType == T.StringType()}
    checked = state.isolate_errors(result.withColumns(cells), {n: (n, kind) for n, kind in types.items()}, error=_CAST)
    failed = (F.col(STATUS) == IMPORTED) & F.col(_CAST).isNotNull()
    said = F.array(F.struct(F.lit("error").alias("level"), F.col(_CAST).alias("text")))
    before = F.coalesce(F.col(MESSAGES), F.array().cast(result.schema[MESSAGES].dataType))
    messages = F.when(failed, F.concat(before, said)).otherwise(F.col(MESSAGES))
    return checked.withColumns({STATUS: F.when(failed, F.lit(FAILED)).otherwise(F.col(STATUS)), MESSAGES: messages}).drop(_CAST)


def _keep_rows(store: Store, job: Job, rows: DataFrame, values: Sequence[str], known: DataFrame) -> None:
    """Write what ``rows`` change: their targets, messages, copies and map rows; all else stays as it is.

    ``known`` has the map rows of all their keys.
    """
    made = target_id(F.lit(job.name), F.col("src_key"))
    imported = F.col(STATUS) == IMPORTED
    again, first = rows.filter(imported).select("src_key"), not store.has("id_map", job.name)
    # A row that is no longer imported keeps the target it once had, so that a rollback finds it.
    fresh = rows.filter(imported).select(made.alias("id"), *[source_col(v) for v in values], F.lit(False).alias("is_stub"))
    store.change(f"targets/{job.target}", job.name, fresh)

    said = rows.select("src_key", F.explode(MESSAGES).alias("_m")).select("src_key", "_m.level", "_m.text")
    quiet = rows.filter(F.coalesce(F.size(MESSAGES), F.lit(0)) <= 0).select("src_key")
    store.change("messages", job.name, said.select(*MESSAGE_ROWS.names), quiet)
    if plans_copies(job.mapping):
        planned = rows.filter(imported).select("src_key", F.explode(COPIES).alias("_c")).select("src_key", "_c.*")
        # A row that is no longer imported keeps its file like its target.
        store.change("copies", job.name, planned.select(*COPY_ROWS.names), again)

    entry = ["src_key", "dest_id", F.col(STATUS).alias("status"), F.lit(job.rollback_action).cast("string").alias("rollback_action"), "row_hash"]
    entries = rows.filter(imported).withColumn("dest_id", made).select(*entry)
    others = rows.filter(~imported)
    if first:
        others = others.withColumn("dest_id", F.lit(None).cast("string"))
    else:
        others = others.join(known.select("src_key", "dest_id"), "src_key", "left")
    # The id map comes last: what it does not name yet is imported again by a repeated run.
    store.change("id_map", job.name, entries.unionByName(others.select(*entry)))


def _keep_stubs(store: Store, group: Group, rows: DataFrame) -> set[str]:
    """Write the placeholder rows that lookups asked for to the jobs they belong to; the names of these jobs."""
    stubbed = set()
    wanted = rows.select(F.explode(STUBS).alias("_s")).select("_s.migration", "_s.src_key").distinct()
    for job in group.jobs:
        mine = wanted.filter(F.col("migration") == job.name)
        if mine.isEmpty():
            continue
        stubbed.add(job.name)
        # The map is cut down to the keys asked for, so that it is not shuffled for a few of them.
        known = store.id_map(job.name).filter(F.col("dest_id").isNotNull()).select("src_key")
        known = known.join(bounded_broadcast(mine.select("src_key"), mine.count()), "src_key", "left_semi")
        new = mine.join(known, "src_key", "left_anti").select("src_key")
        made = target_id(F.lit(job.name), F.col("src_key"))
        entries = new.select(
            "src_key",
            made.alias("dest_id"),
            F.lit(NEEDS_UPDATE).alias("status"),
            F.lit(job.rollback_action).cast("string").alias("rollback_action"),
            F.lit(None).cast("string").alias("row_hash"),
        )
        # Written once for both tables, since it is made from the old id map.
        path = store.staging("stubs")
        entries.write.parquet(path)
        entries = store.spark.read.schema(ID_MAP).parquet(path)
        store.change(f"targets/{job.target}", job.name, entries.select(F.col("dest_id").alias("id"), F.lit(True).alias("is_stub")))
        store.change("id_map", job.name, entries)
        store.discard(path)
    return stubbed


def remove_orphans(store: Store, job: Job, sheet: DataFrame, within: Column | None = None) -> None:
    """Drop the targets, map rows and messages of source keys that left the sheet.

    If ``sheet`` has the rows of some keys only, ``within`` tells which.
    """
    known, table = store.id_map(job.name), f"targets/{job.target}"
    known = known if within is None else known.filter(within)
    gone = state.orphans(known, sheet).filter(F.col("status") != NEEDS_UPDATE)
    path = store.staging("orphans")
    gone.write.parquet(path)
    gone = store.spark.read.schema(ID_MAP).parquet(path)
    if not gone.isEmpty():
        store.change(table, job.name, gone=gone.filter(F.col("dest_id").isNotNull()).select(F.col("dest_id").alias("id")))
        for rows in ("messages", "copies", "id_map"):
            store.change(rows, job.name, gone=gone)
    store.discard(path)


def import_group(
    store: Store, group: Group, options: Options | None = None, tag: str | None = None
) -> list[str]:
    """Import the group's jobs, or those with a tag, requirements first; the names in the order they ran."""
    options, done = options or Options(), []
    if options.run_ts is None:
        # One moment for the whole run.
        options = replace(options, run_ts=datetime.datetime.now(datetime.timezone.utc))
    try:
        for level in group.levels():
            for job in level:
                if tag is not None and tag not in job.tags:
                    continue
                unmet = [r for r in job.requires if not _is_met(store, group, r)]
                if unmet and not options.force:
                    raise ValueError(f"{job.name} requires {', '.join(unmet)}")
                import_job(store, group, job, options)
                done.append(job.name)
    finally:
        # A later import, a retry among them, stages the sheet as it is then.
        release_sheet(store, group)
    return done


def _is_met(store: Store, group: Group, name: str) -> bool:
    """Has a required job been imported? A job of the group must know every row of its sheet, any other some row."""
    if not store.has("id_map", name):
        return False
    known = store.id_map(name)
    for job in group.jobs:
        if job.name == name:
            sheet, tree = _keyed(store, group, job), store.tree(name)
            if tree is not None:
                sheet, known = hashtree.parted(sheet, known, tree, hashtree.differing_ranges(sheet, tree))
            sheet = sheet.select("src_key")
            return sheet.join(known.select("src_key"), "src_key", "left_anti").isEmpty()
    return not known.isEmpty()


def rollback_job(store: Store, job: Job, statuses: Sequence[str] | str | None = None) -> None:
    """Undo a job, or only its rows in some states: targets go, or stay if so marked; map rows go in any case.

    Rows are marked as gone; a whole rollback leaves empty tables for the map, the messages and the copies.
    """
    marked, table = store.id_map(job.name).withColumn("migration", F.lit(job.name)), f"targets/{job.target}"
    doomed, dropped = state.rolled_back(marked, statuses)
    paths = store.staging("rollback"), store.staging("rollback")
    doomed.select(F.col("dest_id").alias("id")).write.parquet(paths[0])
    dropped.select("src_key").distinct().write.parquet(paths[1])
    doomed, dropped = store.spark.read.schema("id string").parquet(paths[0]), store.spark.read.schema("src_key string").parquet(paths[1])
    if store.has(table, job.name):
        store.change(table, job.name, gone=doomed)
    else:
        store.replace(table, job.name, store.spark.createDataFrame([], "id string"))
    for rows, schema in (("messages", MESSAGE_ROWS), ("copies", COPY_ROWS), ("id_map", ID_MAP)):
        if statuses is not None and store.has(rows, job.name):
            store.change(rows, job.name, gone=dropped)
        elif rows != "copies" or store.has(rows, job.name):
            store.replace(rows, job.name, store.spark.createDataFrame([], schema))
    for path in paths:
        store.discard(path)


def rollback_group(
    store: Store, group: Group, statuses: Sequence[str] | str | None = None, tag: str | None = None
) -> list[str]:
    """Undo the group's jobs in reverse order; the names in the order they ran."""
    done = []
    for level in reversed(group.levels()):
        for job in reversed(level):
            if tag is None or tag in job.tags:
                rollback_job(store, job, statuses)
                done.append(job.name)
    return done


def forget_group(store: Store, group: Group) -> None:
    """A deactivated or deleted request: its map, message and copy tables go, the targets stay."""
    for job in group.jobs:
        store.remove("id_map", job.name)
        store.remove("messages", job.name)
        store.remove("copies", job.name)
        store.remove("ranges", job.name)


