"""Registered queries over whole imports: versioned tables, isolated failures, nested checks, listings, streams."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tabweave.functions.steps import Context
from tabweave.operators.access import longest_rule
from tabweave.operators.lookups import entity_lookup
from tabweave.plans.compiler import accepted, compile_mapping
from tabweave.plans.ingest import Group, Job, import_group, rollback_group
from tabweave.plans.store import Store
from tabweave.queries.steps import RUN_TS, _outcome
from tabweave.session import delete_on_exit, materialize, scratch_path
from tabweave.sources.delimited import accepted_files
from tabweave.sources.tables import table
from tabweave.streaming.deferred import Claims, run_deferred
from tabweave.streaming.ledger import ledger, run_ledger

KINDS = {"BUILDING": "b", "FURNITURE": "f", "MACHINERY": "m"}


def _store(spark, name: str) -> Store:
    root = scratch_path(spark, name)
    delete_on_exit(spark, root)
    return Store(spark, root)


def ingest_versions(spark, sf):
    """Import, import with some rows changed, roll back what was ignored, compact: map rows and targets that are left."""
    key = F.col("c_custkey")
    now = table(spark, sf, "customer").select(
        key.cast("string").alias("ID"), "c_name", F.when(key % 50 == 1, "NONE").otherwise(F.col("c_mktsegment")).alias("kind")
    )
    before = table(spark, sf, "customer").select(
        key.cast("string").alias("ID"), F.when(key % 100 == 0, "old").otherwise(F.col("c_name")).alias("c_name"), F.col("c_mktsegment").alias("kind")
    )
    job = Job("base", {"title": "c_name", "kind": [{"plugin": "static_map", "source": "kind", "map": KINDS}]}, "node", {"ID": "integer"})
    store = _store(spark, "versions")
    for sheet in (before, now):
        import_group(store, Group([job], sheet))
    rollback_group(store, Group([job], now), "ignored")

    def left(read: str):
        rows = store.id_map("base").join(store.read("targets/node", "base"), F.col("dest_id") == F.col("id"), "full")
        return rows.select("src_key", "status", "title", "kind", F.lit(read).alias("read"))

    # Written, since compaction takes the versions away that it reads.
    merged = materialize(left("merged"), "merged")
    for name in ("id_map", "targets/node"):
        store.compact(name, "base")
    return merged.unionByName(left("compacted"))


def ingest_row_errors(spark, sf):
    """An import of orders some of which have a bad key, a cell that no step takes, or one that is no number."""
    key = F.col("o_orderkey")
    sheet = table(spark, sf, "orders").select(
        F.when(key % 17 == 0, F.concat(F.lit("x"), key.cast("string"))).otherwise(key.cast("string")).alias("ID"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.lit("a;b|c")).alias("cell"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).when(key % 11 != 0, (key % 1000).cast("string")).otherwise("").alias("n"),
    )
    mapping = {
        "parts": [{"plugin": "subdelimited_explode", "source": "cell", "delimiter": ";", "subdelimiter": "|"}],
        "n": [{"plugin": "log", "source": "n", "template": "n is :value", "level": "notice"}],
    }
    job = Job("order", mapping, "order", {"ID": "integer"}, types={"n": "int"})
    store = _store(spark, "errors")
    import_group(store, Group([job], sheet))
    said = store.messages("order").filter("level = 'error'").select("src_key", "text")
    rows = store.id_map("order").join(said, "src_key", "left")
    rows = rows.join(store.read("targets/order", "order").select(F.col("id").alias("dest_id"), "n", F.size("parts").alias("n_parts")), "dest_id", "left")
    return rows.select("src_key", "status", "text", "n", "n_parts")


def step_sub_process_checks(spark, sf):
    """Checking steps inside a nested pipeline: a map without a match, both ways to skip, a second split."""
    key = F.col("o_orderkey")
    first = F.concat_ws("|", "o_orderstatus", "o_orderpriority", F.when(key % 3 == 0, "").otherwise("x+y*z"))
    second = F.concat(F.lit("F||"), F.when(key % 5 == 0, "n").otherwise("u+v"))
    sheet = table(spark, sf, "orders").select("o_orderkey", F.concat_ws(";", first, second).alias("cell"))
    children = {
        "code": [{"plugin": "get", "source": "s"}, {"plugin": "static_map", "map": {"O": "open", "F": "done"}}],
        "prio": [{"plugin": "get", "source": "p"}, {"plugin": "skip_on_empty", "method": "process"},
                 {"plugin": "static_map", "map": {"1-URGENT": "urgent"}, "bypass": True}],
        "bits": [{"plugin": "get", "source": "q"}, {"plugin": "subdelimited_explode", "delimiter": "+", "subdelimiter": "*", "keys": ["k"]}],
        "need": [{"plugin": "get", "source": "q"}, {"plugin": "skip_on_empty", "method": "row", "message": "no q"}],
    }
    mapping = {
        "items": [
            {"plugin": "subdelimited_explode", "source": "cell", "delimiter": ";", "subdelimiter": "|", "keys": ["s", "p", "q"]},
            {"plugin": "sub_process", "process": children},
        ]
    }
    rows = compile_mapping(sheet, mapping, Context(run_ts=RUN_TS), ["o_orderkey"])
    bits = lambda i: F.array_join(F.transform(i["bits"], lambda b: F.try_element_at(b, F.lit("k"))), "+")
    shown = F.transform("items", lambda i: F.concat_ws("/", i["code"], F.coalesce(i["prio"], F.lit("-")), bits(i)))
    return _outcome(rows.withColumn("shown", F.array_join(shown, ",")), "o_orderkey", "shown")


def step_filesize(spark, sf):
    """Byte lengths of documents, looked up in a listing of them; some are asked for by a name that is not there."""
    name = F.concat(F.lit("doc/"), F.col("doc_id").cast("string"))
    docs = table(spark, sf, "documents")
    listing = docs.select(name.alias("path"), F.octet_length("text").cast("bigint").alias("length"))
    sheet = docs.select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.concat(name, F.lit(".gone"))).otherwise(name).alias("file"))
    mapping = {"size": [{"plugin": "callback", "callable": "filesize", "source": "file"}]}
    rows = compile_mapping(sheet, mapping, Context(run_ts=RUN_TS, files=listing, key="doc_id"), ["doc_id"])
    return accepted(rows).select("doc_id", "size")


def sheet_formats(spark, sf):
    """Uploads named after pages, by their format; others than the accepted ones are refused with a reason."""
    endings = F.array(*[F.lit(x) for x in (".xlsx", ".CSV", ".ods", ".pdf", "")])
    pages = table(spark, sf, "pages").select("page_id", F.concat("url", F.get(endings, (F.col("page_id") % 5).cast("int"))).alias("path"))
    return accepted_files(pages).select("page_id", "format", "error")


def deferred_claims(spark, sf):
    """Orders as named items, some queued twice; after a failure all are given again, and each was taken up once."""
    queue, checkpoint, path, out = (scratch_path(spark, n) for n in ("queue", "claims-checkpoint", "claims", "claimed"))
    for folder in (queue, checkpoint, path, out):
        delete_on_exit(spark, folder)
    orders = table(spark, sf, "orders")
    items = orders.select(F.col("o_orderkey").cast("string").alias("item"), F.col("o_custkey").cast("string").alias("request"))
    items.unionByName(items.filter("CAST(item AS BIGINT) % 3 = 0")).write.parquet(queue)
    known = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_nationkey").alias("owner"))
    attempts = []

    def run(taken, number):
        attempts.append(number)
        taken.write.parquet(f"{out}/attempt={len(attempts)}")
        if len(attempts) == 1:
            raise RuntimeError("cut short after the items were run")

    def work(checkpoint):
        stream = spark.readStream.schema("item string, request string").parquet(queue)
        run_deferred(stream, lambda: known, run, checkpoint, Claims(path)).awaitTermination()

    try:
        work(checkpoint)
    except StreamingQueryException:
        work(checkpoint)
    return spark.read.parquet(out).select(F.col("item").cast("bigint").alias("item"), "request", "owner", "grp")


def ledger_stream(spark, sf):
    """Orders as request changes in two lots of several batches, each a run of its own: the ledger after both."""
    queue, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "ledger-checkpoint")
    for folder in (queue, checkpoint):
        delete_on_exit(spark, folder)
    op = F.when(F.col("o_orderstatus") == "O", "insert").when(F.col("o_orderstatus") == "P", "update").otherwise("delete")
    priority = F.col("o_orderpriority")
    changes = table(spark, sf, "orders").select(
        "o_orderkey", op.alias("op"), F.col("o_custkey").alias("request"), priority.alias("old_file"), F.concat(F.lit("new "), priority).alias("new_file")
    )
    store = _store(spark, "ledger")
    for lot in (0, 1):
        changes.filter(F.col("o_orderkey") % 2 == lot).repartition(2).write.mode("append").parquet(queue)
        stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(queue)
        run_ledger(stream, store, "usage", checkpoint).awaitTermination()
    return ledger(store, "usage")


def access_rules(spark, sf):
    """Pages against a table of rules that other pages make, with and without a boundary behind the directory."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    parts = F.split("url", "/")
    folder = F.array_join(F.slice(parts, 1, 3 + (F.col("page_id") % 3).cast("int")), "/")
    rules = pages.filter("page_id % 4 = 0").select(F.when(F.col("page_id") % 8 == 0, F.concat(folder, F.lit("/"))).otherwise(folder).alias("rule"))
    loose = longest_rule(pages, "url", rules, "loose")
    return longest_rule(loose, "url", rules, "strict", strict=True).select("page_id", "loose", F.rtrim("strict", F.lit("/")).alias("strict"))


def lookup_collation(spark, sf):
    """Segments in other letters, looked up by a collation for which neither case nor accents count."""
    accented = F.translate("c_mktsegment", "AEIOU", "\u00c0\u00e9\u0130\u00f6\u00dc")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", accented.alias("asked"))
    segments = customers.groupBy(F.col("c_mktsegment").alias("value")).agg(F.min("c_custkey").alias("id"))
    hits = entity_lookup(customers, "asked", segments, "hit", collation="UNICODE_CI_AI")
    return entity_lookup(hits, "asked", segments, "miss", ignore_case=True).select("c_custkey", "asked", "hit", "miss")


_KIND = "CASE c_mktsegment WHEN 'BUILDING' THEN 'b' WHEN 'FURNITURE' THEN 'f' WHEN 'MACHINERY' THEN 'm' END"

QUERIES = {
    "ingest_versions": (
        ingest_versions,
        f"""SELECT CAST(c_custkey AS VARCHAR) AS src_key, 'imported' AS status, c_name AS title, {_KIND} AS kind, read
            FROM customer CROSS JOIN (VALUES ('merged'), ('compacted')) AS r(read)
            WHERE {_KIND} IS NOT NULL AND c_custkey % 50 <> 1""",
    ),
    "ingest_row_errors": (
        ingest_row_errors,
        """WITH s AS (
             SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'x' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS src_key,
                    CASE WHEN o_orderkey % 17 = 0 THEN 'Key ID is not of type integer: x' || o_orderkey
                         WHEN o_orderpriority = '5-LOW' THEN 'The value of subdelimited_explode must be text; it was NULL'
                         WHEN o_orderstatus = 'P' THEN 'Not of type int: ' || o_orderpriority END AS text,
                    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 1000 AS INTEGER) END AS n FROM orders)
           SELECT src_key, CASE WHEN text IS NULL THEN 'imported' ELSE 'failed' END AS status, text,
                  CASE WHEN text IS NULL THEN n END AS n, CASE WHEN text IS NULL THEN 2 END AS n_parts FROM s""",
    ),
    "step_sub_process_checks": (
        step_sub_process_checks,
        """WITH t AS (
             SELECT *, CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'No mapping for value: ' || o_orderstatus
                            WHEN o_orderkey % 3 = 0 THEN 'no q' END AS text FROM orders)
           SELECT o_orderkey, CASE WHEN text IS NULL THEN 'imported' ELSE 'ignored' END AS status, text,
                  CASE WHEN text IS NULL THEN
                    CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'done' END || '/' ||
                    CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' ELSE o_orderpriority END || '/x+y,done/-/' ||
                    CASE WHEN o_orderkey % 5 = 0 THEN 'n' ELSE 'u+v' END END AS shown
           FROM t""",
    ),
    "deferred_claims": (
        deferred_claims,
        """SELECT o_orderkey AS item, CAST(o_custkey AS VARCHAR) AS request, c_nationkey AS owner, 'isi__' || o_custkey AS grp
           FROM orders JOIN customer ON c_custkey = o_custkey""",
    ),
    "ledger_stream": (
        ledger_stream,
        """WITH e AS (SELECT o_orderpriority AS file, o_custkey AS request, -1 AS delta FROM orders WHERE o_orderstatus IN ('P', 'F')
                      UNION ALL SELECT 'new ' || o_orderpriority, o_custkey, 1 FROM orders WHERE o_orderstatus IN ('O', 'P'))
           SELECT file, request, CAST(sum(delta) AS BIGINT) AS uses FROM e GROUP BY 1, 2""",
    ),
    "access_rules": (
        access_rules,
        r"""WITH p AS (SELECT page_id, url, string_split(url, '/') AS s FROM pages),
                r AS (SELECT DISTINCT array_to_string(s[1:3 + page_id % 3], '/') || CASE WHEN page_id % 8 = 0 THEN '/' ELSE '' END AS rule
                      FROM p WHERE page_id % 4 = 0),
                l AS (SELECT page_id, arg_max(rule, len(rule)) AS loose FROM p JOIN r ON starts_with(url, rule) GROUP BY 1),
                t AS (SELECT page_id, arg_max(rtrim(rule, '/'), len(rtrim(rule, '/'))) AS strict FROM p JOIN r
                      ON url = rtrim(rule, '/') OR starts_with(url, rtrim(rule, '/') || '/') GROUP BY 1)
           SELECT page_id, loose, strict FROM p LEFT JOIN l USING (page_id) LEFT JOIN t USING (page_id)""",
    ),
    "lookup_collation": (
        lookup_collation,
        """SELECT c_custkey, translate(c_mktsegment, 'AEIOU', '\u00c0\u00e9\u0130\u00f6\u00dc') AS asked,
                  (SELECT min(c_custkey) FROM customer o WHERE o.c_mktsegment = c.c_mktsegment) AS hit,
                  CASE WHEN NOT regexp_matches(c_mktsegment, '[AEIOU]') THEN c_custkey END AS miss FROM customer c""",
    ),
    "step_filesize": (
        step_filesize,
        "SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN CAST(strlen(text) AS BIGINT) END AS size FROM documents",
    ),
    "sheet_formats": (
        sheet_formats,
        """WITH p AS (SELECT page_id, url || (['.xlsx', '.CSV', '.ods', '.pdf', ''])[page_id % 5 + 1] AS path FROM pages),
                f AS (SELECT page_id, path, lower(string_split(string_split(rtrim(path, '/'), '/')[-1], '.')[-1]) AS suffix FROM p)
           SELECT page_id, CASE WHEN suffix IN ('xlsx', 'ods', 'csv') THEN suffix END AS format,
                  CASE WHEN suffix NOT IN ('xlsx', 'ods', 'csv') THEN 'Format of ' || path || ' is not one of xlsx, ods, csv' END AS error
           FROM f""",
    ),
}
