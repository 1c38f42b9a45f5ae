"""Registered queries over lookups, and the flagship ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.functions.steps import Context
from tabweave.functions.text import target_id
from tabweave.operators import lookups as L
from tabweave.plans.compiler import MESSAGES, STATUS, accepted, compile_mapping
from tabweave.sources.tables import table


def _customer_map(spark, sf) -> DataFrame:
    """Id map of a job that loaded all customers."""
    return table(spark, sf, "customer").select(
        F.lit("customers").alias("migration"),
        F.col("c_custkey").cast("string").alias("src_key"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("dest_id"),
    )


def _segments(spark, sf) -> DataFrame:
    """Entity rows: the market segments as terms, each with its lower-case name as id."""
    return (
        table(spark, sf, "customer")
        .select("c_mktsegment")
        .distinct()
        .select(
            F.lit("term").alias("entity_type"),
            F.lit("vocabulary").alias("bundle_key"),
            F.lit("segments").alias("bundle"),
            F.lit("name").alias("value_key"),
            F.col("c_mktsegment").alias("value"),
            F.lower("c_mktsegment").alias("id"),
        )
    )


def _nations(spark, sf) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.lit("place").alias("entity_type"),
        F.lit("level").alias("bundle_key"),
        F.lit("nation").alias("bundle"),
        F.lit("number").alias("value_key"),
        F.col("n_nationkey").cast("string").alias("value"),
        F.col("n_name").alias("id"),
    )


STATUS_NAMES = {"O": "open", "F": "finished", "P": "pending"}
PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}

ORDER_MAPPING = {
    "_priority": [
        {"plugin": "skip_on_empty", "source": "o_orderpriority", "method": "row", "message": "Priority is missing"},
        {"plugin": "static_map", "map": PRIORITIES},
    ],
    "status_name": [{"plugin": "static_map", "source": "o_orderstatus", "map": STATUS_NAMES}],
    "priority": "@_priority",
    "customer_id": [
        {"plugin": "get", "source": "o_custkey"},
        {"plugin": "migration_lookup", "migration": "customers", "no_stub": True},
    ],
    "_customer": [{"plugin": "get", "source": "@customer_id"}, {"plugin": "load_entity", "entity_type": "entity:customer"}],
}

# The second job takes the loaded customer apart and looks its parts up.
DETAIL_MAPPING = {
    "status_name": "status_name",
    "priority": "priority",
    "customer_id": "customer_id",
    "segment": [
        {"plugin": "get", "source": "c_mktsegment"},
        {
            "plugin": "entity_lookup",
            "entity_type": "term",
            "bundle_key": "vocabulary",
            "bundle": "segments",
            "value_key": "name",
            "ignore_case": True,
        },
    ],
    "nation": [
        {"plugin": "get", "source": "c_nationkey"},
        {"plugin": "entity_lookup", "entity_type": "place", "bundle": "nation", "value_key": "number"},
    ],
}


def flagship_ingest(spark, sf):
    """Orders as sheet rows: map the status, leave out unmapped priorities, load the customer, look up its parts."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("src_key"), F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus", "o_orderpriority"
    )
    customers = table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
        "c_mktsegment",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
    )
    entities = _segments(spark, sf).unionByName(_nations(spark, sf))
    ctx = Context(migration="orders", id_map=_customer_map(spark, sf), entities=entities, targets={"customer": customers})
    loaded = accepted(compile_mapping(orders, ORDER_MAPPING, ctx, ["src_key"], scratch=True))
    flat = loaded.select("src_key", "status_name", "priority", "customer_id", "_customer.c_mktsegment", "_customer.c_nationkey")
    rows = accepted(compile_mapping(flat, DETAIL_MAPPING, ctx, ["src_key"]))
    return rows.withColumn("id", target_id(F.lit("orders"), F.col("src_key")))


def lookup_entity_ci(spark, sf):
    """Part names in another case, looked up among the parts; the least id of several hits."""
    parts = table(spark, sf, "part")
    entities = parts.select(
        F.lit("part").alias("entity_type"),
        F.lit("type").alias("bundle_key"),
        F.col("p_type").alias("bundle"),
        F.lit("name").alias("value_key"),
        F.col("p_name").alias("value"),
        F.col("p_partkey").alias("id"),
    )
    asked = parts.select("p_partkey", F.upper("p_name").alias("asked"))
    known = L.entities_of(entities, "part", "name", bundle="PROMO", bundle_key="type")
    return L.entity_lookup(asked, "asked", known, "hit", ignore_case=True)


def lookup_entity_list(spark, sf):
    """A list of values becomes the list of its hits; misses leave the list."""
    names = L.one_per_key(table(spark, sf, "customer"), F.col("c_mktsegment"), F.col("c_custkey"))
    entities = names.select(F.col("_lookup_key").alias("value"), F.col("_lookup_hit").alias("id"))
    asked = table(spark, sf, "customer").select("c_custkey", F.array(F.lower("c_mktsegment"), "c_name", F.lit("building")).alias("asked"))
    hits = L.entity_lookup(asked, "asked", entities, "hits", ignore_case=True, row_key="c_custkey")
    return hits.select("c_custkey", F.array_join(F.col("hits").cast("array<string>"), "|").alias("hits"))


def lookup_migration(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"))
    known = _customer_map(spark, sf).join(
        table(spark, sf, "customer").filter(F.col("c_acctbal") < 1000).select(F.col("c_custkey").cast("string").alias("src_key")), "src_key", "left_anti"
    )
    return L.migration_lookup(orders, "o_custkey", known, "customers", "customer_id", row_key="o_orderkey")


def lookup_self(spark, sf):
    """Each event's parent is the event before it, in the same sheet."""
    events = table(spark, sf, "events").select("event_id", (F.col("event_id") - 1).cast("string").alias("parent"))
    rows = events.select(F.col("event_id").cast("string").alias("src_key"))
    return L.self_lookup(events, "parent", rows, "events", "parent_id")


def lookup_self_skipped(spark, sf):
    """A parent that is itself left out of the import is no hit."""
    events = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("src_key"), "event_type", (F.col("event_id") - 1).cast("string").alias("parent")
    )
    mapping = {
        "kind": [{"plugin": "static_map", "source": "event_type", "map": {"click": "c", "view": "v", "purchase": "p", "signup": "s"}}],
        "parent_id": [{"plugin": "get", "source": "parent"}, {"plugin": "migration_lookup", "migration": "events", "no_stub": True}],
    }
    return accepted(compile_mapping(events, mapping, Context(migration="events"), ["src_key"]))


def lookup_multi(spark, sf):
    """Customers with a high balance first, then suppliers, each asked with a column of its own."""
    rich = table(spark, sf, "customer").filter(F.col("c_acctbal") > 5000)
    rich = rich.select(F.lit("rich").alias("migration"), F.col("c_custkey").cast("string").alias("src_key"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("dest_id"))
    suppliers = table(spark, sf, "supplier").select(
        F.lit("suppliers").alias("migration"), F.col("s_suppkey").cast("string").alias("src_key"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("dest_id")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("a"), F.col("o_custkey").cast("string").alias("b"))
    found = L.migration_lookup(orders, "a", rich.unionByName(suppliers), ["rich", "suppliers"], "hit", {"rich": ["b"]}, "o_orderkey")
    return found.select("o_orderkey", "hit")


def lookup_stub(spark, sf):
    """Parts that were loaded, followed by placeholders for the others that order lines refer to."""
    loaded = table(spark, sf, "part").filter(F.col("p_size") <= 25).select(F.col("p_partkey").alias("src_key"), "p_name")
    asked = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("src_key"))
    return L.with_stubs(loaded, asked)


def lookup_members(spark, sf):
    """Parents from two lookups in one list; without any the field is skipped."""
    events = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("src_key"), "event_type", (F.col("event_id") - 1).cast("string").alias("parent"), F.col("user_id").cast("string").alias("user")
    )
    buyers = events.filter(F.col("event_type") == "purchase").select(F.lit("buys").alias("migration"), "src_key", F.concat(F.lit("B"), "src_key").alias("dest_id"))
    poor = table(spark, sf, "customer").filter(F.col("c_acctbal") < 1000).select(F.col("c_custkey").cast("string").alias("src_key"))
    known = _customer_map(spark, sf).join(poor, "src_key", "left_anti").unionByName(buyers)
    both = L.migration_lookup(events, "parent", known, "buys", "first", row_key="src_key")
    both = L.migration_lookup(both, "user", known, "customers", "second", row_key="src_key")
    return both.select("src_key", F.array_join(L.members(F.col("first"), F.col("second")), "|").alias("members"))


def load_entity(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    loaded = L.load_entity(suppliers, "s_nationkey", table(spark, sf, "nation"), "nation", "n_nationkey")
    return loaded.select("s_suppkey", "nation.n_nationkey", "nation.n_name", "nation.n_regionkey")


def mapping_outcome(spark, sf):
    """Counts per status and first message of the flagship's first job."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("src_key"), "o_orderstatus", "o_orderpriority")
    mapping = {k: ORDER_MAPPING[k] for k in ("_priority", "status_name", "priority")}
    rows = compile_mapping(orders, mapping, Context(migration="orders"), ["src_key"])
    said = F.get(MESSAGES, F.lit(0))["text"]
    return rows.groupBy(F.col(STATUS).alias("status"), said.alias("text")).agg(F.count(F.lit(1)).alias("n_rows"))


_PRIORITY = "CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' END"

QUERIES = {
    "flagship_ingest": (
        flagship_ingest,
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS src_key,
                   CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' ELSE 'pending' END AS status_name,
                   {_PRIORITY} AS priority, 'C' || c_custkey AS customer_id, lower(c_mktsegment) AS segment,
                   n_name AS nation, sha256('orders' || chr(31) || o_orderkey) AS id
            FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
            WHERE {_PRIORITY} IS NOT NULL""",
    ),
    "mapping_outcome": (
        mapping_outcome,
        f"""SELECT CASE WHEN {_PRIORITY} IS NULL THEN 'ignored' ELSE 'imported' END AS status,
                   CASE WHEN {_PRIORITY} IS NULL THEN 'No mapping for value: ' || o_orderpriority END AS text,
                   count(*) AS n_rows
            FROM orders GROUP BY 1, 2""",
    ),
    "lookup_entity_ci": (
        lookup_entity_ci,
        """SELECT p.p_partkey, upper(p.p_name) AS asked, e.hit FROM part p LEFT JOIN
             (SELECT p_name, min(p_partkey) AS hit FROM part WHERE p_type = 'PROMO' GROUP BY p_name) e USING (p_name)""",
    ),
    "lookup_entity_list": (
        lookup_entity_list,
        """WITH s AS (SELECT c_mktsegment, min(c_custkey) AS id FROM customer GROUP BY 1)
           SELECT c_custkey, concat_ws('|', a.id, b.id) AS hits
           FROM customer c JOIN s a USING (c_mktsegment) LEFT JOIN s b ON b.c_mktsegment = 'BUILDING'""",
    ),
    "lookup_migration": (
        lookup_migration,
        """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
                  CASE WHEN NOT c_acctbal < 1000 THEN 'C' || c_custkey END AS customer_id
           FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    ),
    "lookup_self": (
        lookup_self,
        """SELECT e.event_id, CAST(e.event_id - 1 AS VARCHAR) AS parent,
                  CASE WHEN p.event_id IS NOT NULL THEN sha256('events' || chr(31) || p.event_id) END AS parent_id
           FROM events e LEFT JOIN events p ON p.event_id = e.event_id - 1""",
    ),
    "lookup_self_skipped": (
        lookup_self_skipped,
        """SELECT CAST(e.event_id AS VARCHAR) AS src_key, left(e.event_type, 1) AS kind,
                  CASE WHEN p.event_type <> 'error' THEN sha256('events' || chr(31) || p.event_id) END AS parent_id
           FROM events e LEFT JOIN events p ON p.event_id = e.event_id - 1 WHERE e.event_type <> 'error'""",
    ),
    "lookup_multi": (
        lookup_multi,
        """SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN 'C' || c_custkey
                                   WHEN s_suppkey IS NOT NULL THEN 'S' || s_suppkey END AS hit
           FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 5000
                LEFT JOIN supplier ON s_suppkey = o_orderkey""",
    ),
    "lookup_stub": (
        lookup_stub,
        """SELECT p_partkey AS src_key, p_name, false AS is_stub FROM part WHERE p_size <= 25
           UNION ALL
           SELECT DISTINCT l_partkey, CAST(NULL AS VARCHAR), true FROM lineitem
           WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""",
    ),
    "lookup_members": (
        lookup_members,
        """SELECT CAST(e.event_id AS VARCHAR) AS src_key,
                  nullif(concat_ws('|', CASE WHEN p.event_id IS NOT NULL THEN 'B' || p.event_id END,
                                        CASE WHEN c_custkey IS NOT NULL THEN 'C' || c_custkey END), '') AS members
           FROM events e LEFT JOIN events p ON p.event_id = e.event_id - 1 AND p.event_type = 'purchase'
                LEFT JOIN customer ON c_custkey = e.user_id AND NOT c_acctbal < 1000""",
    ),
    "load_entity": (
        load_entity,
        "SELECT s_suppkey, n_nationkey, n_name, n_regionkey FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey",
    ),
}
