"""Registered queries over rules that hold for every size and shape of value."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tabweave.functions.steps import Context, register_step
from tabweave.plans.catalog import job_mapping
from tabweave.plans.compiler import accepted, compile_mapping
from tabweave.plans.ingest import Group, Job, Options, forget_group, import_group, rollback_group
from tabweave.plans.store import ID_MAP, Store
from tabweave.queries.steps import RUN_TS
from tabweave.session import delete_on_exit, scratch_path
from tabweave.sources.delimited import read_sheet
from tabweave.sources.tables import table

CODES = {"1-URGENT": "u", "2-HIGH": "h", "3-MEDIUM": "m", "O": "open", "F": "done"}


def _orders(spark, sf):
    named = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    rows = table(spark, sf, "orders").select(*[F.col(n).cast("string").alias(n) for n in named])
    return rows.withColumn("src_key", F.col("o_orderkey"))


def static_map_sizes(spark, sf):
    large = CODES | {f"code {i}": f"value {i}" for i in range(5_000)}

    def steps(size, source, **options):
        return [{"plugin": "get", "source": source}, {"plugin": "static_map", "map": size, **options}]

    pair = ["o_orderstatus", "o_orderpriority"]
    joined = {"plugin": "concat", "delimiter": "|"}
    mapping = {
        "key": "o_orderkey",
        "small": steps(CODES, "o_orderpriority", default_value="-"),
        "large": steps(large, "o_orderpriority", default_value="-"),
        "small_list": [*steps(CODES, pair, bypass=True), joined],
        "large_list": [*steps(large, pair, bypass=True), joined],
    }
    return accepted(compile_mapping(_orders(spark, sf), mapping, Context(run_ts=RUN_TS)))


def _known_customers(spark, sf):
    key = F.col("c_custkey").cast("string")
    return table(spark, sf, "customer").select(
        F.lit("customer").alias("migration"), key.alias("src_key"), F.concat(F.lit("C"), key).alias("dest_id")
    )


def sub_process_lookup(spark, sf):
    mapping = {
        "key": "o_orderkey",
        "_parts": [
            {"plugin": "concat", "source": ["o_custkey", "o_orderkey"], "delimiter": ";"},
            {"plugin": "subdelimited_explode", "delimiter": ";", "subdelimiter": "|", "keys": ["id"]},
        ],
        "_found": [
            {"plugin": "get", "source": "@_parts"},
            {"plugin": "sub_process", "process": {
                "hit": [{"plugin": "get", "source": "id"}, {"plugin": "migration_lookup", "migration": "customer", "no_stub": True},
                        {"plugin": "default_value", "default_value": "none"}]}},
        ],
    }
    context = Context(run_ts=RUN_TS, id_map=_known_customers(spark, sf))
    rows = compile_mapping(_orders(spark, sf), mapping, context, scratch=True)
    return rows.select("key", F.array_join(F.transform("_found", lambda x: x["hit"]), ",").alias("hits"))


def lookup_list(spark, sf):
    mapping = {
        "key": "o_orderkey",
        "hits": [
            {"plugin": "get", "source": ["o_custkey", "o_orderkey", "o_custkey"]},
            {"plugin": "migration_lookup", "migration": "customer", "no_stub": True, "each": True},
        ],
    }
    context = Context(run_ts=RUN_TS, id_map=_known_customers(spark, sf))
    rows = compile_mapping(_orders(spark, sf), mapping, context)
    return rows.select("key", F.array_join("hits", ",").alias("hits"))


def load_entity_list(spark, sf):
    known = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), "c_name")
    mapping = {
        "key": "o_orderkey",
        "loaded": [{"plugin": "get", "source": ["o_custkey", "o_orderkey"]}, {"plugin": "load_entity", "entity_type": "entity:customer"}],
    }
    rows = compile_mapping(_orders(spark, sf), mapping, Context(run_ts=RUN_TS, targets={"customer": known}))
    names = F.transform("loaded", lambda x: F.coalesce(x["c_name"], F.lit("none")))
    return rows.select("key", F.array_join(names, ",").alias("names"))


def ingest_references(spark, sf):
    """Parts in a tree; a part whose parent is not imported is ignored, and so are all below it."""
    key = F.col("p_partkey")
    parent = F.when(F.col("p_size") % 25 == 7, F.lit("missing")).when(key < 10, key.cast("string")).otherwise(
        F.floor(key / 10).cast("string")
    )
    sheet = table(spark, sf, "part").select(key.cast("string").alias("ID"), parent.alias("Parent"), F.col("p_name").alias("Name"))
    lookup = {"plugin": "migration_lookup", "migration": "part", "no_stub": True}
    foreign = {"plugin": "migration_lookup", "migration": "elsewhere"}
    mapping = {
        "key": "ID",
        "name": "Name",
        "parent": [{"plugin": "get", "source": "Parent"}, lookup, {"plugin": "skip_on_empty", "method": "row", "message": "No parent"}],
        "other": [{"plugin": "get", "source": "Name"}, foreign],
    }
    job = Job("part", mapping, "part", {"ID": "integer"})
    root = scratch_path(spark, "references")
    delete_on_exit(spark, root)
    store = Store(spark, root)
    import_group(store, Group([job], sheet), Options(run_ts=RUN_TS.replace(tzinfo=datetime.timezone.utc)))
    rows = store.read("targets/part", "part")
    parents = rows.select(F.col("id").alias("parent"), F.col("key").alias("parent_key"))
    found = rows.join(parents, "parent", "left")
    return found.select(F.col("key").cast("bigint").alias("key"), F.col("parent_key").cast("bigint").alias("parent_key"), F.col("other").isNull().alias("other_is_empty"))


def ingest_files_incremental(spark, sf):
    """Scans of pages whose names clash: an import of some pages, then of all, after which no name is given twice."""
    lang = F.regexp_extract("url", "/(de|en|es|fr)/", 1)
    pages = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("ID"), "url", F.concat(F.lit("bin/"), lang, F.lit(".html")).alias("To"))
    mapping = {"uri": [{"plugin": "file_copy", "source": ["url", "To"], "move": True}]}
    job = Job("file", mapping, "file", {"ID": "integer"})
    root = scratch_path(spark, "files")
    delete_on_exit(spark, root)
    store = Store(spark, root)
    for sheet in (pages.filter("CAST(ID AS BIGINT) % 3 = 0"), pages):
        import_group(store, Group([job], sheet))
    found = store.copies("file").join(store.id_map("file").select("src_key", "dest_id"), "src_key")
    rows = found.join(store.read("targets/file", "file").select(F.col("id").alias("dest_id"), "uri"), "dest_id")
    return rows.select(F.col("src_key").cast("bigint").alias("page_id"), F.col("from").alias("copy_from"), F.col("to").alias("copy_to"), "uri", "move")


def sheet_numbered(spark, sf):
    """Orders as sheets of many rows, read with their row numbers: the header of each file is row 1."""
    path = scratch_path(spark, "numbered")
    delete_on_exit(spark, path)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_orderkey") % 16).alias("bucket"))
    sheets = orders.repartition(F.col("bucket")).sortWithinPartitions("bucket", "o_orderkey")
    sheets.write.partitionBy("bucket").csv(path, header=True)
    rows = read_sheet(spark, f"{path}/*", header_row=1, row_index_column="row")
    return rows.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus", "row")


def _initials(value, dtype, cfg, ctx):
    return F.concat(F.lit(cfg.get("before", "")), F.substring(value, 1, 1))


def step_registered(spark, sf):
    """A step of the user's own among those of the library."""
    register_step("initials", _initials)
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name")
    mapping = {
        "one": [{"plugin": "get", "source": "c_mktsegment"}, {"plugin": "initials", "before": "~"}],
        "two": [{"plugin": "get", "source": ["c_mktsegment", "c_name"]}, {"plugin": "initials"}, {"plugin": "concat", "delimiter": "."}],
    }
    return accepted(compile_mapping(rows, mapping, Context(run_ts=RUN_TS), ["c_custkey"]))


def _segments(spark, sf):
    named = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("ID"), "c_name", "c_mktsegment")
    return named.withColumn("c_mktsegment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))


_CATALOG = [
    ("base", "kind", 1, 0, "get", ["c_mktsegment"], None),
    ("base", "kind", 1, 1, "skip_on_empty", None, {"method": '"row"', "message": '"no segment"'}),
    ("base", "title", 0, 0, "get", ["c_name"], None),
    ("child", "base", 0, 0, "get", ["ID"], None),
    ("child", "base", 0, 1, "migration_lookup", None, {"migration": '"base"', "no_stub": "true"}),
    ("child", "label", 1, 0, "concat", ["c_mktsegment", "c_name"], {"delimiter": '"/"'}),
]
_CATALOG_SCHEMA = "migration string, dest string, weight int, pos int, plugin string, sources array<string>, options map<string,string>"


def _catalog_group(spark, sf):
    steps = spark.createDataFrame(_CATALOG, _CATALOG_SCHEMA)
    jobs = [
        Job("base", job_mapping(steps, "base"), "node", {"ID": "integer"}),
        Job("child", job_mapping(steps, "child"), "media", {"ID": "integer"}, requires=["base"]),
    ]
    root = scratch_path(spark, "catalog")
    delete_on_exit(spark, root)
    return Store(spark, root), Group(jobs, _segments(spark, sf))


def ingest_from_catalog(spark, sf):
    """Jobs made from catalog rows, imported."""
    store, group = _catalog_group(spark, sf)
    import_group(store, group)
    known = store.id_map("child").join(store.read("targets/media", "child"), F.col("dest_id") == F.col("id"))
    titles = store.read("targets/node", "base").select(F.col("id").alias("base"), "title")
    return known.join(titles, "base", "left").select(F.col("src_key").cast("bigint").alias("key"), "label", "title")


def ingest_rollback_group(spark, sf):
    """Import two jobs, undo what was ignored in both, and forget the first: the map rows that are left."""
    store, group = _catalog_group(spark, sf)
    import_group(store, group)
    rollback_group(store, group, "ignored")
    forget_group(store, Group(group.jobs[:1], group.sheet))
    left = store.all_rows("id_map", ID_MAP).groupBy("migration", "status").agg(F.count(F.lit(1)).alias("n"))
    targets = [store.read(f"targets/{j.target}", j.name).agg(F.count(F.lit(1)).alias("n")) for j in group.jobs]
    kept = [t.select(F.lit(j.name).alias("migration"), F.lit("target").alias("status"), "n") for t, j in zip(targets, group.jobs, strict=True)]
    return left.unionByName(kept[0]).unionByName(kept[1])


_CODE = "CASE {} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CODES.items()) + " ELSE {} END"
_PRIORITY = _CODE.format("o_orderpriority", "'-'")
_BOTH = _CODE.format("o_orderstatus", "o_orderstatus") + " || '|' || " + _CODE.format("o_orderpriority", "o_orderpriority")

QUERIES = {
    "static_map_sizes": (
        static_map_sizes,
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS key, {_PRIORITY} AS small, {_PRIORITY} AS large,
                   {_BOTH} AS small_list, {_BOTH} AS large_list FROM orders""",
    ),
    "sub_process_lookup": (
        sub_process_lookup,
        """SELECT CAST(o_orderkey AS VARCHAR) AS key,
                  coalesce('C' || a.c_custkey, 'none') || ',' || coalesce('C' || b.c_custkey, 'none') AS hits
           FROM orders LEFT JOIN customer a ON a.c_custkey = o_custkey LEFT JOIN customer b ON b.c_custkey = o_orderkey""",
    ),
    "lookup_list": (
        lookup_list,
        """SELECT CAST(o_orderkey AS VARCHAR) AS key,
                  nullif(concat_ws(',', 'C' || a.c_custkey, 'C' || b.c_custkey, 'C' || a.c_custkey), '') AS hits
           FROM orders LEFT JOIN customer a ON a.c_custkey = o_custkey LEFT JOIN customer b ON b.c_custkey = o_orderkey""",
    ),
    "load_entity_list": (
        load_entity_list,
        """SELECT CAST(o_orderkey AS VARCHAR) AS key, coalesce(a.c_name, 'none') || ',' || coalesce(b.c_name, 'none') AS names
           FROM orders LEFT JOIN customer a ON a.c_custkey = o_custkey LEFT JOIN customer b ON b.c_custkey = o_orderkey""",
    ),
    "sheet_numbered": (
        sheet_numbered,
        """SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderkey % 16 ORDER BY o_orderkey) + 1 AS row FROM orders""",
    ),
    "step_registered": (
        step_registered,
        "SELECT c_custkey, '~' || c_mktsegment[1] AS one, c_mktsegment[1] || '.' || c_name[1] AS two FROM customer",
    ),
    "ingest_from_catalog": (
        ingest_from_catalog,
        """SELECT c_custkey AS key, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END || '/' || c_name AS label,
                  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS title FROM customer""",
    ),
    "ingest_rollback_group": (
        ingest_rollback_group,
        """SELECT 'child' AS migration, 'imported' AS status, count(*) AS n FROM customer
           UNION ALL SELECT 'child', 'target', count(*) FROM customer
           UNION ALL SELECT 'base', 'target', count(*) FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    ),
    "ingest_files_incremental": (
        ingest_files_incremental,
        """WITH p AS (SELECT page_id, url, regexp_extract(url, '/(de|en|es|fr)/', 1) AS lang FROM pages),
                n AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY page_id % 3 <> 0, page_id) - 1 AS nth FROM p),
                t AS (SELECT *, 'bin/' || lang || CASE WHEN nth > 0 THEN '_' || nth ELSE '' END || '.html' AS copy_to FROM n)
           SELECT page_id, url AS copy_from, copy_to, copy_to AS uri, true AS move FROM t""",
    ),
    "ingest_references": (
        ingest_references,
        """WITH RECURSIVE p AS (
             SELECT p_partkey AS key, CASE WHEN p_size % 25 = 7 THEN NULL WHEN p_partkey < 10 THEN p_partkey
                                           ELSE p_partkey // 10 END AS parent_key FROM part),
           kept AS (
             SELECT key, parent_key FROM p WHERE key = parent_key
             UNION SELECT p.key, p.parent_key FROM p JOIN kept ON p.parent_key = kept.key)
           SELECT key, parent_key, true AS other_is_empty FROM kept""",
    ),
}
