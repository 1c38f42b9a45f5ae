"""Registered queries over ingest state, ordering and the deferred queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.constants import FAILED, IGNORED, IMPORTED, ORPHANS_TAG
from tabweave.functions.steps import Context
from tabweave.functions.text import row_hash, target_id
from tabweave.operators import hashtree
from tabweave.operators import state as S
from tabweave.plans.compiler import compile_mapping, messages_of
from tabweave.plans.ingest import Group, Job, Options, import_group, rollback_job
from tabweave.plans.ordering import job_levels
from tabweave.plans.store import ID_MAP, Store
from tabweave.session import scratch_path
from tabweave.sources.tables import table
from tabweave.streaming.deferred import run_deferred

MONEY = "decimal(15,2)"


def _customer_cells(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("src_key"), "c_name", F.col("c_acctbal").cast(MONEY).cast("string").alias("c_acctbal"), "c_mktsegment"
    )


_CELLS = ("src_key", "c_name", "c_acctbal", "c_mktsegment")


def _hashed(cells: DataFrame) -> DataFrame:
    return cells.withColumn("row_hash", row_hash([F.col(c) for c in _CELLS]))


def row_hash_query(spark, sf):
    cells = _customer_cells(spark, sf)
    blank = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment"))
    return _hashed(cells.withColumn("c_mktsegment", blank)).select("src_key", "row_hash")


def _known_customers(spark, sf) -> DataFrame:
    """The last import: the poorer customers, one segment under its old name, and suppliers that are gone."""
    old = table(spark, sf, "customer").filter(F.col("c_acctbal") < 8000)
    old = old.select(
        F.col("c_custkey").cast("string").alias("src_key"),
        "c_name",
        F.col("c_acctbal").cast(MONEY).cast("string").alias("c_acctbal"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("HOUSING")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    gone = table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("src_key"), F.col("s_name").alias("c_name"), F.lit("0").alias("c_acctbal"), F.lit("").alias("c_mktsegment")
    )
    return _hashed(old.unionByName(gone)).select("src_key", "row_hash")


def classify_rows(spark, sf):
    return S.classify_rows(_hashed(_customer_cells(spark, sf)), _known_customers(spark, sf))


def classify_by_ranges(spark, sf):
    """The same by a hash tree over ranges of the known keys, of which only those that differ are read."""
    known = _known_customers(spark, sf)
    lows = [r.low for r in known.groupBy(F.substring("src_key", 1, 2)).agg(F.min("src_key").alias("low")).select("low").orderBy("low").collect()]
    return hashtree.classify_by_ranges(_hashed(_customer_cells(spark, sf)), known, hashtree.build_tree(known, lows))


def rows_to_import(spark, sf):
    """New and changed rows only."""
    return S.rows_to_import(_hashed(_customer_cells(spark, sf)), _known_customers(spark, sf)).select("src_key", "c_mktsegment")


def rows_to_import_limited(spark, sf):
    """The first rows by key of an import with a limit."""
    rows = S.rows_to_import(_hashed(_customer_cells(spark, sf)), _known_customers(spark, sf), update=True, limit=50)
    return rows.select("src_key", "c_mktsegment")


def _order_map(spark, sf) -> DataFrame:
    """Id map of an orders job: finished ones failed, pending ones were ignored, one priority has no target."""
    status = F.when(F.col("o_orderstatus") == "F", FAILED).when(F.col("o_orderstatus") == "P", IGNORED).otherwise(IMPORTED)
    dest = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.concat(F.lit("T"), F.col("o_orderkey").cast("string")))
    return table(spark, sf, "orders").select(
        F.concat(F.lit("orders-"), F.col("o_orderpriority")).alias("migration"),
        F.col("o_orderkey").cast("string").alias("src_key"),
        dest.alias("dest_id"),
        status.alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "preserve").when(F.col("o_orderpriority") == "1-URGENT", "delete").alias("rollback_action"),
    )


def _order_target(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("id"), "o_custkey")


def orphans(spark, sf):
    """Loaded orders whose key left the sheet: no line mentions them."""
    sheet = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("src_key"))
    return S.orphans(_order_map(spark, sf), sheet).select("src_key", "dest_id")


def status_filter(spark, sf):
    return S.status_filter(_order_map(spark, sf), "failed,ignored").select("src_key", "status")


def rollback_plan(spark, sf):
    return S.rollback_plan(_order_map(spark, sf)).groupBy("action", "status").agg(F.count(F.lit(1)).alias("n_rows"))


def rollback_full(spark, sf):
    rows, left = S.rollback(_order_map(spark, sf), _order_target(spark, sf))
    return rows.select(F.lit("target").alias("kind"), "id").unionByName(left.select(F.lit("map").alias("kind"), F.col("src_key").alias("id")))


def rollback_failed(spark, sf):
    rows, left = S.rollback(_order_map(spark, sf), _order_target(spark, sf), "failed,ignored")
    return rows.select(F.lit("target").alias("kind"), "id").unionByName(left.select(F.lit("map").alias("kind"), F.col("src_key").alias("id")))


def progress(spark, sf):
    return S.progress(_order_map(spark, sf))


def progress_ratio(spark, sf):
    """Imported orders against all orders, per customer's job."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("migration"), "o_orderstatus")
    totals = orders.groupBy("migration").agg(F.count(F.lit(1)).alias("total"))
    ratio = S.progress_ratio(orders.filter(F.col("o_orderstatus") == "O"), totals)
    return ratio.select("migration", "total", "done", "finished")


def row_errors(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.substring_index("url", "/", -1).alias("slug"))
    return S.isolate_errors(pages, {"number": ("slug", "int")}).select("page_id", "number", "error")


def messages(spark, sf):
    """Messages of orders that are left out, by the first destination that leaves them out."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    mapping = {
        "status": [{"plugin": "static_map", "source": "o_orderstatus", "map": {"O": "open", "F": "finished"}}],
        "priority": [
            {"plugin": "log", "source": "o_orderpriority", "template": "Priority :value", "level": "notice"},
            {"plugin": "static_map", "map": {"1-URGENT": "urgent", "2-HIGH": "high"}},
        ],
    }
    return messages_of(compile_mapping(orders, mapping, Context(), ["o_orderkey"]), ["o_orderkey"])


def group_order(spark, sf):
    """Turns as jobs, each requiring the turn before it: the level of every job."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn")
    name = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    needs = F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))
    return job_levels(turns.select(name.alias("job")), turns.select(name.alias("job"), needs.alias("requires")))


def _sheet(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("ID"), "c_name", "c_mktsegment", (F.col("c_custkey") - 1).cast("string").alias("parent")
    )


def _jobs() -> list[Job]:
    base = {
        "title": "c_name",
        "kind": [{"plugin": "static_map", "source": "c_mktsegment", "map": {"BUILDING": "b", "FURNITURE": "f", "MACHINERY": "m"}}],
    }
    child = {
        "title": "c_name",
        "node": [{"plugin": "get", "source": "ID"}, {"plugin": "migration_lookup", "migration": "base", "no_stub": True}, {"plugin": "load_entity", "entity_type": "entity:node"}],
    }
    return [
        Job("child", child, "media", {"ID": "integer"}, requires=["base"], default_bundle="file"),
        Job("base", base, "node", {"ID": "integer"}),
    ]


def ingest_group(spark, sf):
    """Two jobs over all customers through a store: import, then read the second job's target."""
    store = Store(spark, scratch_path(spark, "ingest"))
    import_group(store, Group(_jobs(), _sheet(spark, sf)), Options())
    return store.read("targets/media", "child").select("id", "title", "bundle", F.col("node.title").alias("node_title"), F.col("node.kind").alias("kind"))


def ingest_incremental(spark, sf):
    """Import an old sheet, then the current one: changed rows anew, rows that left as orphans."""
    store = Store(spark, scratch_path(spark, "incremental"))
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "HOUSING").otherwise(F.col("c_mktsegment"))
    customers = table(spark, sf, "customer")
    old = customers.filter(F.col("c_acctbal") < 8000).select(F.col("c_custkey").cast("string").alias("ID"), "c_name", segment.alias("c_mktsegment"))
    gone = table(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ID"), F.col("s_name").alias("c_name"), F.lit("none").alias("c_mktsegment"))
    now = customers.select(F.col("c_custkey").cast("string").alias("ID"), "c_name", "c_mktsegment")
    job = Job("base", {"title": "c_name", "kind": "c_mktsegment"}, "node", {"ID": "string"}, tags=[ORPHANS_TAG])
    for sheet in (old.unionByName(gone), now):
        import_group(store, Group([job], sheet))
    target = store.read("targets/node", "base")
    return store.id_map("base").join(target, F.col("dest_id") == F.col("id"), "left").select("src_key", "status", "title", "kind")


def ingest_rollback(spark, sf):
    """Import all customers, then undo the ignored rows only: the id map that is left."""
    store = Store(spark, scratch_path(spark, "rollback"))
    group = Group([_jobs()[1]], _sheet(spark, sf))
    import_group(store, group, Options())
    rollback_job(store, group.jobs[0], "failed,ignored")
    return store.all_rows("id_map", ID_MAP).select("migration", "src_key", "dest_id", "status")


def deferred_ingest(spark, sf):
    """Orders as work items of a stream; each batch writes its items with owner and group to its own folder."""
    out, checkpoint = scratch_path(spark, "deferred"), scratch_path(spark, "deferred-checkpoint")
    schema = table(spark, sf, "orders").schema
    items = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    items = items.select("o_orderkey", F.col("o_custkey").cast("string").alias("request"))

    def requests() -> DataFrame:
        active = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
        return active.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_nationkey").alias("owner"))

    def run(taken: DataFrame, number: int) -> None:
        taken.withColumn("item_id", target_id(F.col("grp"), F.col("o_orderkey").cast("string"))).write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_deferred(items, requests, run, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("o_orderkey", "request", "owner", "grp", "item_id")


_MONEY = "CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR)"
_CHANGE = """CASE WHEN NOT c_acctbal < 8000 THEN 'new' WHEN c_mktsegment = 'BUILDING' THEN 'changed' ELSE 'unchanged' END"""
_ORDER_MAP = """(SELECT 'orders-' || o_orderpriority AS migration, CAST(o_orderkey AS VARCHAR) AS src_key,
                        CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'T' || o_orderkey END AS dest_id,
                        CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'ignored' ELSE 'imported' END AS status,
                        CASE o_orderpriority WHEN '5-LOW' THEN 'preserve' WHEN '1-URGENT' THEN 'delete' END AS rollback_action
                 FROM orders)"""

QUERIES = {
    "row_hash": (
        row_hash_query,
        f"""SELECT CAST(c_custkey AS VARCHAR) AS src_key,
                   md5(c_custkey || chr(31) || c_name || chr(31) || {_MONEY} || chr(31) ||
                       CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment ELSE chr(0) END) AS row_hash
            FROM customer""",
    ),
    "classify_rows": (
        classify_rows,
        f"""SELECT CAST(c_custkey AS VARCHAR) AS src_key, {_CHANGE} AS change FROM customer
            UNION ALL SELECT 'S' || s_suppkey, 'gone' FROM supplier""",
    ),
    "classify_by_ranges": (
        classify_by_ranges,
        f"""SELECT CAST(c_custkey AS VARCHAR) AS src_key, {_CHANGE} AS change FROM customer
            UNION ALL SELECT 'S' || s_suppkey, 'gone' FROM supplier""",
    ),
    "rows_to_import": (
        rows_to_import,
        f"SELECT CAST(c_custkey AS VARCHAR) AS src_key, c_mktsegment FROM customer WHERE {_CHANGE} <> 'unchanged'",
    ),
    "rows_to_import_limited": (
        rows_to_import_limited,
        "SELECT CAST(c_custkey AS VARCHAR) AS src_key, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 50",
    ),
    "orphans": (
        orphans,
        f"SELECT src_key, dest_id FROM {_ORDER_MAP} m WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) = src_key)",
    ),
    "status_filter": (status_filter, f"SELECT src_key, status FROM {_ORDER_MAP} m WHERE status IN ('failed', 'ignored')"),
    "rollback_plan": (
        rollback_plan,
        f"""SELECT CASE WHEN dest_id IS NULL THEN 'drop_map' WHEN rollback_action = 'preserve' THEN 'keep_target'
                        ELSE 'delete_target' END AS action, status, count(*) AS n_rows
            FROM {_ORDER_MAP} m GROUP BY 1, 2""",
    ),
    "rollback_full": (
        rollback_full,
        "SELECT 'target' AS kind, 'T' || o_orderkey AS id FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')",
    ),
    "rollback_failed": (
        rollback_failed,
        """SELECT 'target' AS kind, 'T' || o_orderkey AS id FROM orders
           WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') OR o_orderstatus NOT IN ('F', 'P')
           UNION ALL SELECT 'map', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus NOT IN ('F', 'P')""",
    ),
    "progress": (
        progress,
        f"SELECT migration, status, count(*) AS n_rows FROM {_ORDER_MAP} m GROUP BY ROLLUP (migration, status)",
    ),
    "progress_ratio": (
        progress_ratio,
        """SELECT o_custkey AS migration, count(*) AS total, count(*) FILTER (o_orderstatus = 'O') AS done,
                  count(*) FILTER (o_orderstatus = 'O') / count(*) AS finished
           FROM orders GROUP BY o_custkey""",
    ),
    "row_errors": (
        row_errors,
        """WITH s AS (SELECT page_id, string_split(url, '/')[-1] AS slug FROM pages)
           SELECT page_id, TRY_CAST(slug AS INTEGER) AS number,
                  CASE WHEN TRY_CAST(slug AS INTEGER) IS NULL THEN 'Not of type int: ' || slug END AS error FROM s""",
    ),
    "messages": (
        messages,
        """SELECT o_orderkey, 'status' AS level, 'No mapping for value: P' AS text FROM orders WHERE o_orderstatus = 'P'
           UNION ALL SELECT o_orderkey, 'notice', 'Priority ' || o_orderpriority FROM orders WHERE o_orderstatus <> 'P'
           UNION ALL SELECT o_orderkey, 'status', 'No mapping for value: ' || o_orderpriority FROM orders
                     WHERE o_orderstatus <> 'P' AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
    ),
    "group_order": (
        group_order,
        """WITH RECURSIVE l AS (
             SELECT conv_id, turn, CAST(0 AS BIGINT) AS level FROM conversations c
             WHERE NOT EXISTS (SELECT 1 FROM conversations p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 1)
             UNION ALL SELECT c.conv_id, c.turn, l.level + 1 FROM conversations c JOIN l ON c.conv_id = l.conv_id AND c.turn = l.turn + 1)
           SELECT conv_id || ':' || turn AS job, level FROM l""",
    ),
    "ingest_group": (
        ingest_group,
        """SELECT sha256('child' || chr(31) || c_custkey) AS id, c_name AS title, 'file' AS bundle,
                  CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE', 'MACHINERY') THEN c_name END AS node_title,
                  CASE c_mktsegment WHEN 'BUILDING' THEN 'b' WHEN 'FURNITURE' THEN 'f' WHEN 'MACHINERY' THEN 'm' END AS kind
           FROM customer""",
    ),
    "ingest_incremental": (
        ingest_incremental,
        "SELECT CAST(c_custkey AS VARCHAR) AS src_key, 'imported' AS status, c_name AS title, c_mktsegment AS kind FROM customer",
    ),
    "ingest_rollback": (
        ingest_rollback,
        """SELECT 'base' AS migration, CAST(c_custkey AS VARCHAR) AS src_key, sha256('base' || chr(31) || c_custkey) AS dest_id,
                  'imported' AS status
           FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE', 'MACHINERY')""",
    ),
    "deferred_ingest": (
        deferred_ingest,
        """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS request, c_nationkey AS owner, 'isi__' || o_custkey AS grp,
                  sha256('isi__' || o_custkey || chr(31) || o_orderkey) AS item_id
           FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0""",
    ),
}
