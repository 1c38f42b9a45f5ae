"""Registered queries over the mapping catalog, with the tables standing in for large catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.constants import DERIVED_TAG, ORPHANS_TAG, TEMPLATE_TAG
from tabweave.operators.ledger import file_usage, usage_events
from tabweave.plans import catalog as C
from tabweave.sources.tables import table


def _groups(spark, sf) -> DataFrame:
    """Documents as tagged groups; the labels decide on the tags, unlabelled ones carry none."""
    labels = table(spark, sf, "labels")
    tags = F.array_compact(
        F.array(
            F.col("lang"),
            F.when(F.col("quality") == 1, TEMPLATE_TAG),
            F.when(F.col("toxic") == 1, DERIVED_TAG),
            F.when(F.col("quality") == 0, ORPHANS_TAG),
        )
    )
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("grp"), F.when(F.col("quality").isNotNull(), tags).alias("tags"), F.col("lang").alias("owner")
    )


def cat_templates(spark, sf):
    return C.templates(_groups(spark, sf)).select("grp", F.array_join("tags", ",").alias("tags"))


def cat_manage_orphans(spark, sf):
    return C.manages_orphans(_groups(spark, sf)).select("grp")


def _lines(spark, sf) -> DataFrame:
    """Order lines as destinations: supplier = group, order = migration, line number = position."""
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("grp"), F.col("l_orderkey").alias("migration"), F.col("l_linenumber").alias("pos"), "l_returnflag", "l_linestatus", "l_partkey"
    )


def cat_mapping(spark, sf):
    """The weight of every destination, running on across the migrations of its group."""
    return C.mapping_of(_lines(spark, sf).select("grp", "migration", "pos"))


def cat_used_columns(spark, sf):
    """How often each source column is used, over all lines as steps."""
    steps = _lines(spark, sf).select(
        "migration",
        F.when(F.col("l_returnflag") == "R", "migration_lookup").otherwise("get").alias("plugin"),
        F.array(F.col("l_returnflag"), F.concat(F.lit("part_"), F.col("l_partkey").cast("string")), F.concat(F.lit("@"), F.col("l_linestatus"))).alias("sources"),
        F.create_map(F.lit("other"), F.array(F.lit("other_id"), F.lit("@ref"))).alias("source_ids"),
    )
    return C.used_columns(steps).groupBy("source_column").agg(F.count(F.lit(1)).alias("n_uses"))


def _order_jobs(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("migration"), F.col("o_custkey").alias("grp"))


def cat_derive_names(spark, sf):
    """Orders as migrations of a customer's group; each refers to orders named by the parts of its lines."""
    refs = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("migration"), F.col("l_partkey").alias("lookup"))
    return C.derive_lookups(refs.distinct(), _order_jobs(spark, sf), F.col("grp"))


def cat_derive_dependencies(spark, sf):
    """Orders that follow each other, kept as a dependency inside one market segment only."""
    jobs = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    jobs = jobs.select(F.col("o_orderkey").alias("migration"), F.col("c_mktsegment").alias("grp"))
    depends = table(spark, sf, "orders").select(F.col("o_orderkey").alias("migration"), (F.col("o_orderkey") - 1).alias("requires"))
    return C.derive_dependencies(depends, jobs, F.col("grp"))


def cat_derive_jobs(spark, sf):
    """Active customers as requests: one derived job per order of the customer."""
    requests = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        (F.col("c_acctbal") >= 2000).alias("active"),
        F.concat(F.lit("migration_group:"), F.col("c_custkey").cast("string")).alias("original_mapping"),
        F.col("c_nationkey").alias("owner"),
    )
    migrations = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("migration"), F.col("o_custkey").cast("string").alias("grp"), F.array("o_orderstatus").alias("tags")
    )
    jobs = C.derive_migrations(requests, migrations)
    return jobs.select("request", "owner", "original", "grp", "migration", F.array_join("tags", ",").alias("tags"))


def cat_dependencies(spark, sf):
    """Customers as requests: the originals that still exist, here orders with lines, and the group."""
    requests = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("migration_group:"), F.col("c_mktsegment")).alias("original_mapping")
    )
    mappings = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").cast("string").alias("original_migration"))
    existing = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("migration"))
    return C.request_dependencies(requests, mappings, existing)


def _supplied(spark, sf) -> DataFrame:
    """Supplier numbers of all lines, read as part numbers."""
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("p_partkey"))


def cat_unused(spark, sf):
    """Part numbers that no line has as its supplier's."""
    return C.unused_destinations(table(spark, sf, "part").select("p_partkey", "p_name"), _supplied(spark, sf), ["p_partkey"])


def cat_auto_map(spark, sf):
    """Unused part numbers that an order number matches."""
    unused = cat_unused(spark, sf).withColumnRenamed("p_partkey", "name")
    sources = table(spark, sf, "orders").select(F.col("o_orderkey").alias("name"), F.col("o_orderpriority").alias("source"))
    return C.auto_map(unused, sources, ["name"])


def cat_dangling(spark, sf):
    """Events read their predecessor; which stay behind when all errors are removed?"""
    events = table(spark, sf, "events").select(F.col("event_id").alias("dest"), (F.col("event_id") - 1).alias("source"), "event_type")
    removed = events.filter(F.col("event_type") == "error").select("dest")
    return C.dangling_refs(events.select("dest", "source"), removed)


def cat_sources(spark, sf):
    """Customers as header columns, suppliers as earlier destinations, parts as constants; the later layer wins."""
    layers = [
        table(spark, sf, "customer").select(F.col("c_custkey").alias("name"), F.lit("sheet").alias("origin"), F.col("c_name").alias("label")),
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("name"), F.lit("processed").alias("origin"), F.col("s_name").alias("label")),
        table(spark, sf, "part").select(F.col("p_partkey").alias("name"), F.lit("system").alias("origin"), F.col("p_name").alias("label")),
    ]
    return C.available_sources(layers, ["name"], ["origin", "label"])


PROTECTED = ("https://www.", "http://blog.", "https://m.")


def _inbound(spark, sf) -> DataFrame:
    """Items of another site: all its pages, without the host's prefix."""
    short = F.regexp_replace("url", "^https?://(www|blog)[.]", "http://")
    return table(spark, sf, "pages").select(short.alias("name"), F.md5("html").alias("body"))


def _current(spark, sf) -> DataFrame:
    """Items of this site: all its pages, with bodies of its own."""
    return table(spark, sf, "pages").select(F.col("url").alias("name"), F.concat(F.lit("own "), F.col("page_id").cast("string")).alias("body"))


def cat_sync_export(spark, sf):
    return C.sync_export(_current(spark, sf), PROTECTED)


def cat_sync_import(spark, sf):
    return C.sync_import(_inbound(spark, sf), _current(spark, sf), PROTECTED)


def cat_access_derived(spark, sf):
    """Derived groups of one owner, here a language."""
    return C.derived_access(_groups(spark, sf), F.lit("en")).select("grp", "owner")


PERMISSIONS = C.Permissions(
    operations={o: f"may {o}" for o in ("view", "update", "map", "activate", "delete")}, create="may create", admin="may all"
)


def cat_access(spark, sf):
    """Who may do what: sources own documents, hold permissions by the languages they write, one is administrator."""
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    requests = documents.select(F.col("doc_id").alias("id"), F.col("source").alias("owner"))
    of_lang = {"en": "view", "de": "update", "fr": "map"}
    permission = F.lit(PERMISSIONS.operations["delete"])
    for lang, operation in of_lang.items():
        permission = F.when(F.col("lang") == lang, PERMISSIONS.operations[operation]).otherwise(permission)
    held = documents.filter(F.col("source") != "src5").select(F.col("source").alias("user"), permission.alias("permission")).distinct()
    admin = documents.filter(F.col("source") == "src7").select(F.col("source").alias("user"), F.lit(PERMISSIONS.admin).alias("permission")).distinct()
    maker = documents.filter(F.col("source") == "src1").select(F.col("source").alias("user"), F.lit(PERMISSIONS.create).alias("permission")).distinct()
    operations = F.array(*map(F.lit, ["view", "update", "map", "activate", "delete", "create", "unknown"]))
    asked = documents.select(F.explode(F.array(F.col("source"), F.lit("src7"), F.lit("src1"))).alias("user"), F.col("doc_id").alias("id"))
    checks = asked.select("user", "id", F.explode(operations).alias("operation"))
    return C.check_access(checks, requests, held.unionByName(admin).unionByName(maker), PERMISSIONS)


def cat_file_usage(spark, sf):
    """A ledger of signed events per user: errors and views take a use, all others add one."""
    delta = F.when(F.col("event_type").isin("view", "error"), -1).otherwise(1)
    signed = table(spark, sf, "events").select(F.col("user_id").alias("file"), delta.alias("delta"))
    return file_usage(signed, ["file"])


def cat_file_usage_changes(spark, sf):
    """Orders as request changes: open = insert, pending = update, finished = delete."""
    op = F.when(F.col("o_orderstatus") == "O", "insert").when(F.col("o_orderstatus") == "P", "update").otherwise("delete")
    changes = table(spark, sf, "orders").select(
        op.alias("op"), F.col("o_custkey").alias("request"), F.col("o_orderpriority").alias("old_file"), F.concat(F.lit("new "), F.col("o_orderpriority")).alias("new_file")
    )
    return file_usage(usage_events(changes), ["file", "request"])


def cat_rederive(spark, sf):
    """Two segments changed: active customers get their orders anew, inactive ones lose them."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("grp"), F.col("o_orderkey").alias("migration"))
    catalog = orders.withColumn("version", F.lit("old"))
    derived = orders.withColumn("version", F.lit("new"))
    touched = table(spark, sf, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    requests = touched.select(F.col("c_custkey").alias("grp"), (F.col("c_acctbal") >= 3000).alias("active"))
    return C.rederive(catalog, derived, requests)


_GROUPS = "documents LEFT JOIN labels USING (doc_id)"
_PROTECTED = "(name LIKE 'https://www.%' OR name LIKE 'http://blog.%' OR name LIKE 'https://m.%')"
_CURRENT = "(SELECT url AS name, 'own ' || page_id AS body FROM pages)"

QUERIES = {
    "cat_templates": (
        cat_templates,
        f"SELECT doc_id AS grp, lang || ',isi_template' AS tags FROM {_GROUPS} WHERE quality = 1 AND toxic <> 1",
    ),
    "cat_manage_orphans": (cat_manage_orphans, f"SELECT doc_id AS grp FROM {_GROUPS} WHERE quality = 0"),
    "cat_mapping": (
        cat_mapping,
        """SELECT l_suppkey AS grp, l_orderkey AS migration, l_linenumber AS pos,
                  row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) - 1 AS weight
           FROM lineitem""",
    ),
    "cat_used_columns": (
        cat_used_columns,
        """SELECT l_returnflag AS source_column, count(*) AS n_uses FROM lineitem GROUP BY 1
           UNION ALL SELECT 'part_' || l_partkey, count(*) FROM lineitem GROUP BY 1
           UNION ALL SELECT 'other_id', count(*) FROM lineitem WHERE l_returnflag = 'R'""",
    ),
    "cat_derive_names": (
        cat_derive_names,
        """SELECT r.migration, r.lookup, 'isi__' || m.o_custkey || '_' || r.migration AS derived_migration,
                  CASE WHEN l.o_custkey = m.o_custkey THEN 'isi__' || m.o_custkey || '_' || r.lookup
                       ELSE CAST(r.lookup AS VARCHAR) END AS derived_lookup
           FROM (SELECT DISTINCT l_orderkey AS migration, l_partkey AS lookup FROM lineitem) r
           JOIN orders m ON m.o_orderkey = r.migration LEFT JOIN orders l ON l.o_orderkey = r.lookup""",
    ),
    "cat_derive_dependencies": (
        cat_derive_dependencies,
        """WITH j AS (SELECT o_orderkey, c_mktsegment AS s FROM orders JOIN customer ON c_custkey = o_custkey)
           SELECT a.o_orderkey AS migration, b.o_orderkey AS requires, 'isi__' || a.s || '_' || a.o_orderkey AS derived_migration,
                  'isi__' || a.s || '_' || b.o_orderkey AS derived_requires
           FROM j a JOIN j b ON b.o_orderkey = a.o_orderkey - 1 AND a.s = b.s""",
    ),
    "cat_derive_jobs": (
        cat_derive_jobs,
        """SELECT c_custkey AS request, c_nationkey AS owner, o_orderkey AS original, 'isi__' || c_custkey AS grp,
                  'isi__' || c_custkey || '_' || o_orderkey AS migration,
                  o_orderstatus || ',isimd,isi_derived_migration,isimd:' || c_custkey AS tags
           FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_acctbal >= 2000""",
    ),
    "cat_dependencies": (
        cat_dependencies,
        """SELECT c_custkey AS id, 'migration_group' AS type, c_mktsegment AS name FROM customer
           UNION ALL SELECT o_custkey, 'migration', CAST(o_orderkey AS VARCHAR) FROM orders
                     WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    ),
    "cat_unused": (
        cat_unused,
        "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_suppkey FROM lineitem)",
    ),
    "cat_auto_map": (
        cat_auto_map,
        """SELECT p_partkey AS name, p_name, o_orderpriority AS source, 'get' AS plugin FROM part JOIN orders ON o_orderkey = p_partkey
           WHERE p_partkey NOT IN (SELECT l_suppkey FROM lineitem)""",
    ),
    "cat_dangling": (
        cat_dangling,
        """SELECT e.event_id AS dest, e.event_id - 1 AS source FROM events e JOIN events p ON p.event_id = e.event_id - 1
           WHERE e.event_type <> 'error' AND p.event_type = 'error'""",
    ),
    "cat_sources": (
        cat_sources,
        """WITH l AS (SELECT c_custkey AS name, 'sheet' AS origin, c_name AS label, 0 AS p FROM customer
                      UNION ALL SELECT s_suppkey, 'processed', s_name, 1 FROM supplier
                      UNION ALL SELECT p_partkey, 'system', p_name, 2 FROM part),
                r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY p DESC) AS n FROM l)
           SELECT name, origin, label FROM r WHERE n = 1""",
    ),
    "cat_sync_export": (cat_sync_export, f"SELECT name, body FROM {_CURRENT} c WHERE NOT {_PROTECTED}"),
    "cat_sync_import": (
        cat_sync_import,
        f"""SELECT name, body FROM (SELECT regexp_replace(url, '^https?://(www|blog)[.]', 'http://') AS name, md5(html) AS body FROM pages) i
            WHERE NOT {_PROTECTED}
            UNION ALL SELECT name, body FROM {_CURRENT} c WHERE {_PROTECTED}""",
    ),
    "cat_access_derived": (
        cat_access_derived,
        f"SELECT doc_id AS grp, lang AS owner FROM {_GROUPS} WHERE toxic = 1 AND lang = 'en'",
    ),
    "cat_access": (
        cat_access,
        """WITH held AS (SELECT DISTINCT source AS usr, CASE lang WHEN 'en' THEN 'view' WHEN 'de' THEN 'update' WHEN 'fr' THEN 'map' ELSE 'delete' END AS op
                         FROM documents WHERE source <> 'src5'),
                ops AS (SELECT unnest(['view', 'update', 'map', 'activate', 'delete', 'create', 'unknown']) AS op)
           SELECT source AS "user", doc_id AS id, held.op AS operation FROM documents JOIN held ON held.usr = source WHERE source <> 'src7'
           UNION SELECT 'src1', doc_id, 'create' FROM documents WHERE EXISTS (SELECT 1 FROM documents WHERE source = 'src1')
           UNION SELECT 'src7', doc_id, ops.op FROM documents, ops WHERE EXISTS (SELECT 1 FROM documents WHERE source = 'src7')""",
    ),
    "cat_file_usage": (
        cat_file_usage,
        """SELECT user_id AS file, CAST(sum(CASE WHEN event_type IN ('view', 'error') THEN -1 ELSE 1 END) AS BIGINT) AS uses
           FROM events GROUP BY 1""",
    ),
    "cat_file_usage_changes": (
        cat_file_usage_changes,
        """WITH e AS (SELECT o_orderpriority AS file, o_custkey AS request, -1 AS delta FROM orders WHERE o_orderstatus IN ('P', 'F')
                      UNION ALL SELECT 'new ' || o_orderpriority, o_custkey, 1 FROM orders WHERE o_orderstatus IN ('O', 'P'))
           SELECT file, request, CAST(sum(delta) AS BIGINT) AS uses FROM e GROUP BY 1, 2""",
    ),
    "cat_rederive": (
        cat_rederive,
        """SELECT o_custkey AS grp, o_orderkey AS migration,
                  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'new' ELSE 'old' END AS version
           FROM orders JOIN customer ON c_custkey = o_custkey
           WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') OR c_acctbal >= 3000""",
    ),
}
