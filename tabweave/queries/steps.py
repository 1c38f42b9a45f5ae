"""Registered queries over pipeline steps."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.functions.steps import Context
from tabweave.operators.manifest import copy_manifest
from tabweave.operators.multivalue import explode_parts, explode_values
from tabweave.operators.routing import default_bundle, route_targets
from tabweave.plans.compiler import MESSAGES, STATUS, accepted, compile_mapping, messages_of
from tabweave.sources.tables import table

RUN_TS = datetime.datetime(2024, 5, 6, 7, 8, 9)


def _text(*names: str):
    return [F.col(n).cast("string").alias(n) for n in names]


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", *_text("c_name", "c_mktsegment"))


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *_text("o_custkey", "o_orderstatus", "o_orderpriority"))


def _labelled(spark, sf):
    """Documents with their labels as text; most documents have none."""
    labels = table(spark, sf, "labels").select("doc_id", *_text("quality", "toxic"))
    return table(spark, sf, "documents").select("doc_id", "lang", "source").join(labels, "doc_id", "left")


def _pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url")


def _run(df: DataFrame, mapping: dict, key: str, **context) -> DataFrame:
    return compile_mapping(df, mapping, Context(run_ts=RUN_TS, **context), [key])


def _outcome(rows: DataFrame, key: str, *values: str) -> DataFrame:
    """Status and first message beside the values of rows that were kept."""
    kept = F.col(STATUS) == "imported"
    return rows.select(
        key,
        *[F.when(kept, F.col(v)).alias(v) for v in values],
        F.col(STATUS).alias("status"),
        F.get(MESSAGES, F.lit(0))["text"].alias("text"),
    )


def step_get_ref(spark, sf):
    mapping = {"name": "c_name", "_segment": "c_mktsegment", "label": "@_segment", "again": [{"plugin": "get", "source": "@label"}]}
    return accepted(_run(_customers(spark, sf), mapping, "c_custkey"))


def step_get_multi(spark, sf):
    rows = accepted(_run(_customers(spark, sf), {"both": [{"plugin": "get", "source": ["c_name", "c_mktsegment"]}]}, "c_custkey"))
    return rows.select("c_custkey", F.to_json("both").alias("both"))


def step_get_list(spark, sf):
    """A list read again loses its empty elements."""
    mapping = {"tags": [{"plugin": "get", "source": ["lang", "quality", "toxic"]}, {"plugin": "get"}]}
    rows = accepted(_run(_labelled(spark, sf), mapping, "doc_id"))
    return rows.select("doc_id", F.array_join("tags", "|").alias("tags"))


def step_scratch_drop(spark, sf):
    mapping = {
        "_first": "c_name",
        "_both": [{"plugin": "concat", "source": ["@_first", "c_mktsegment"], "delimiter": "/"}],
        "path": "@_both",
    }
    return accepted(_run(_customers(spark, sf), mapping, "c_custkey"))


def step_default(spark, sf):
    mapping = {
        "quality": [{"plugin": "get", "source": "quality"}, {"plugin": "default_value", "default_value": "unrated"}],
        "kind": [{"plugin": "default_value", "default_value": "document"}],
    }
    return accepted(_run(_labelled(spark, sf), mapping, "doc_id"))


PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}


def step_static_map(spark, sf):
    mapping = {"priority": [{"plugin": "static_map", "source": "o_orderpriority", "map": PRIORITIES}]}
    return _outcome(_run(_orders(spark, sf), mapping, "o_orderkey"), "o_orderkey", "priority")


def step_static_map_bypass(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    mapping = {"kind": [{"plugin": "static_map", "source": "p_type", "bypass": True, "map": {"PROMO": "promotion", "ECONOMY": "budget"}}]}
    return accepted(_run(parts, mapping, "p_partkey"))


def step_static_map_large(spark, sf):
    """A map too large to search per row is joined."""
    names = {f"Brand#{i}": f"maker {i}" for i in range(100)}
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    return accepted(_run(parts, {"maker": [{"plugin": "static_map", "source": "p_brand", "map": names}]}, "p_partkey"))


def step_skip_row(spark, sf):
    mapping = {
        "quality": [{"plugin": "skip_on_empty", "source": "quality", "method": "row", "message": "Label is missing"}],
        "lang": "lang",
    }
    return _outcome(_run(_labelled(spark, sf), mapping, "doc_id"), "doc_id", "quality", "lang")


def step_skip_field(spark, sf):
    """An empty value ends its field, so the later default does not revive it."""
    mapping = {
        "quality": [
            {"plugin": "skip_on_empty", "source": "quality", "method": "process"},
            {"plugin": "default_value", "default_value": "never"},
        ],
        "lang": "lang",
    }
    return accepted(_run(_labelled(spark, sf), mapping, "doc_id"))


def step_concat(spark, sf):
    mapping = {"label": [{"plugin": "concat", "source": ["lang", "quality", "source"], "delimiter": "/"}]}
    return accepted(_run(_labelled(spark, sf), mapping, "doc_id"))


def step_urlencode(spark, sf):
    return accepted(_run(_pages(spark, sf), {"encoded": [{"plugin": "get", "source": "url"}, {"plugin": "urlencode"}]}, "page_id"))


def step_basename(spark, sf):
    return accepted(_run(_pages(spark, sf), {"name": [{"plugin": "callback", "callable": "basename", "source": "url"}]}, "page_id"))


def step_date_chunk(spark, sf):
    mapping = {
        "_chunk": [{"plugin": "default_value", "default_value": "Y-m"}, {"plugin": "callback", "callable": "date"}],
        "_name": [{"plugin": "callback", "callable": "basename", "source": "url"}],
        "path": [{"plugin": "concat", "source": ["@_chunk", "@_name"], "delimiter": "/"}],
    }
    return accepted(_run(_pages(spark, sf), mapping, "page_id"))


def step_mime(spark, sf):
    return accepted(_run(_pages(spark, sf), {"mime": [{"plugin": "callback", "callable": "mime_content_type", "source": "url"}]}, "page_id"))


def step_log(spark, sf):
    mapping = {"url": [{"plugin": "log", "source": "url", "template": "Address: :value", "level": 4}]}
    return messages_of(_run(_pages(spark, sf), mapping, "page_id"), ["page_id"])


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Two-level cells made of order columns, with blanks around some parts."""
    cell = F.concat(
        F.col("o_orderpriority"), F.lit(" | "), F.col("o_orderstatus"), F.lit(";"),
        F.col("o_custkey").cast("string"), F.lit("|"), F.col("o_orderkey").cast("string"), F.lit("| x ; last"),
    )
    return table(spark, sf, "orders").select("o_orderkey", cell.alias("cell"))


def _exploded(spark, sf, **options):
    step = {"plugin": "subdelimited_explode", "source": "cell", "delimiter": ";", "subdelimiter": "|", **options}
    rows = accepted(_run(_pairs(spark, sf), {"parts": [step]}, "o_orderkey"))
    return explode_parts(rows, "parts", ["o_orderkey"])


def step_subexplode(spark, sf):
    return _exploded(spark, sf)


def step_subexplode_keys(spark, sf):
    return _exploded(spark, sf, keys=["a", "b"], subtrim=False)


def step_subexplode_limits(spark, sf):
    return _exploded(spark, sf, limit=-1, sublimit=2)


def step_file_access(spark, sf):
    mapping = {"url": [{"plugin": "file_is_accessible", "source": "url"}]}
    rows = _run(_pages(spark, sf), mapping, "page_id", allowed_paths=["http://blog.", "http://www."], allowed_schemes=["https"])
    return _outcome(rows, "page_id", "url")


def step_file_access_open(spark, sf):
    """Without any rule every file passes, with a warning."""
    return messages_of(_run(_pages(spark, sf), {"url": [{"plugin": "file_is_accessible", "source": "url"}]}, "page_id"), ["page_id"])


def step_nested_struct(spark, sf):
    mapping = {"card/name": "c_name", "card/segment": "c_mktsegment", "card/copy": "@card/name"}
    rows = accepted(_run(_customers(spark, sf), mapping, "c_custkey"))
    return rows.select("c_custkey", "card.name", "card.segment", "card.copy")


def step_sub_process(spark, sf):
    mapping = {
        "_parts": [{"plugin": "subdelimited_explode", "source": "cell", "delimiter": ";", "subdelimiter": "|", "keys": ["a", "b"]}],
        "items": [
            {"plugin": "get", "source": "@_parts"},
            {
                "plugin": "sub_process",
                "process": {
                    "head": "a",
                    "tail": [{"plugin": "get", "source": "b"}, {"plugin": "default_value", "default_value": "none"}],
                    "both": [{"plugin": "concat", "source": ["@head", "@tail"], "delimiter": "+"}],
                },
            },
        ],
    }
    rows = accepted(_run(_pairs(spark, sf), mapping, "o_orderkey"))
    items = explode_values(rows, "items", ["o_orderkey"], "i", "elem")
    return items.select("o_orderkey", "elem", "i.head", "i.tail", "i.both")


def step_multi_value(spark, sf):
    """A step after a many-valued one works on each value."""
    mapping = {
        "url": [
            {"plugin": "get", "source": ["url", "name"]},
            {"plugin": "callback", "callable": "basename"},
            {"plugin": "static_map", "bypass": True, "map": {"": "nothing"}},
        ]
    }
    pages = _pages(spark, sf).withColumn("name", F.lit(""))
    rows = accepted(_run(pages, mapping, "page_id"))
    return rows.select("page_id", F.array_join("url", "|").alias("names"))


ROUTES = {"image": ["view", "click"], "audio": ["signup"], "video": ["purchase"], "file": ["purchase"]}


def route_targets_query(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return route_targets(events, "event_type", ROUTES).select("event_id", "target")


def default_bundle_query(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    bundle = F.when(F.col("event_type").isin("view", "click"), F.lit("image"))
    return events.select("event_id", default_bundle(bundle, "file").alias("bundle"))


def copy_manifest_query(spark, sf):
    """Parts of one name claim one file name; later claimants get a suffix."""
    parts = table(spark, sf, "part").select(
        "p_partkey", F.col("p_brand").alias("src"), F.concat(F.lit("bin/"), F.col("p_name"), F.lit(".dat")).alias("dest")
    )
    return copy_manifest(parts, "src", "dest", ["p_partkey"])


def step_file_copy(spark, sf):
    """Pages copied to one folder by language and extension; clashing names are numbered in key order."""
    pages = table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("src_key"), "url", F.regexp_extract("url", "/(de|en|es|fr)/", 1).alias("lang")
    )
    mapping = {
        "_name": [{"plugin": "concat", "source": ["lang", "lang"], "delimiter": "."}],
        "_dir": [{"plugin": "default_value", "default_value": "repo-bin:/"}],
        "_dest": [{"plugin": "concat", "source": ["@_dir", "@_name"], "delimiter": "/"}],
        "uri": [{"plugin": "file_copy", "source": ["url", "@_dest"], "file_exists": "rename"}],
    }
    return accepted(_run(pages, mapping, "src_key"))


_LABELLED = "documents LEFT JOIN labels USING (doc_id)"
_MAPPED = "CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' END"
_BASENAME = "string_split(rtrim(url, '/'), '/')[-1]"
_CELL = "o_orderpriority || ' | ' || o_orderstatus || ';' || o_custkey || '|' || o_orderkey || '| x ; last'"

QUERIES = {
    "step_get_ref": (step_get_ref, "SELECT c_custkey, c_name AS name, c_mktsegment AS label, c_mktsegment AS again FROM customer"),
    "step_get_multi": (
        step_get_multi,
        """SELECT c_custkey, '["' || c_name || '","' || c_mktsegment || '"]' AS both FROM customer""",
    ),
    "step_get_list": (step_get_list, f"SELECT doc_id, concat_ws('|', lang, quality, toxic) AS tags FROM {_LABELLED}"),
    "step_scratch_drop": (step_scratch_drop, "SELECT c_custkey, c_name || '/' || c_mktsegment AS path FROM customer"),
    "step_default": (
        step_default,
        f"SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'unrated') AS quality, 'document' AS kind FROM {_LABELLED}",
    ),
    "step_static_map": (
        step_static_map,
        f"""SELECT o_orderkey, {_MAPPED} AS priority,
                   CASE WHEN {_MAPPED} IS NULL THEN 'ignored' ELSE 'imported' END AS status,
                   CASE WHEN {_MAPPED} IS NULL THEN 'No mapping for value: ' || o_orderpriority END AS text
            FROM orders""",
    ),
    "step_static_map_bypass": (
        step_static_map_bypass,
        "SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'promotion' WHEN 'ECONOMY' THEN 'budget' ELSE p_type END AS kind FROM part",
    ),
    "step_static_map_large": (
        step_static_map_large,
        "SELECT p_partkey, 'maker ' || string_split(p_brand, '#')[2] AS maker FROM part",
    ),
    "step_skip_row": (
        step_skip_row,
        f"""SELECT doc_id, CAST(quality AS VARCHAR) AS quality, CASE WHEN quality IS NOT NULL THEN lang END AS lang,
                   CASE WHEN quality IS NULL THEN 'ignored' ELSE 'imported' END AS status,
                   CASE WHEN quality IS NULL THEN 'Label is missing' END AS text
            FROM {_LABELLED}""",
    ),
    "step_skip_field": (step_skip_field, f"SELECT doc_id, CAST(quality AS VARCHAR) AS quality, lang FROM {_LABELLED}"),
    "step_concat": (
        step_concat,
        f"SELECT doc_id, lang || '/' || coalesce(CAST(quality AS VARCHAR), '') || '/' || source AS label FROM {_LABELLED}",
    ),
    "step_urlencode": (
        step_urlencode,
        """SELECT page_id, string_split(url, '/')[1] || '/' ||
                  array_to_string(list_transform(string_split(url, '/')[2:], lambda x: url_encode(x)), '/') AS encoded
           FROM pages""",
    ),
    "step_basename": (step_basename, f"SELECT page_id, {_BASENAME} AS name FROM pages"),
    "step_date_chunk": (step_date_chunk, f"SELECT page_id, '2024-05/' || {_BASENAME} AS path FROM pages"),
    "step_mime": (
        step_mime,
        f"""SELECT page_id, CASE WHEN regexp_matches({_BASENAME}, '(?i)\\.html?$') THEN 'text/html'
                   ELSE 'application/octet-stream' END AS mime FROM pages""",
    ),
    "step_log": (step_log, "SELECT page_id, '4' AS level, 'Address: ' || url AS text FROM pages"),
    "step_subexplode": (
        step_subexplode,
        f"""WITH e AS (SELECT o_orderkey, unnest(string_split({_CELL}, ';')) AS part,
                              generate_subscripts(string_split({_CELL}, ';'), 1) - 1 AS elem FROM orders)
            SELECT o_orderkey, elem, CAST(generate_subscripts(string_split(part, '|'), 1) - 1 AS VARCHAR) AS key,
                   trim(unnest(string_split(part, '|'))) AS value FROM e""",
    ),
    "step_subexplode_keys": (
        step_subexplode_keys,
        f"""WITH e AS (SELECT o_orderkey, trim(unnest(string_split({_CELL}, ';'))) AS part,
                              generate_subscripts(string_split({_CELL}, ';'), 1) - 1 AS elem FROM orders),
                 p AS (SELECT o_orderkey, elem, generate_subscripts(string_split(part, '|'), 1) - 1 AS i,
                              unnest(string_split(part, '|')) AS value FROM e)
            SELECT o_orderkey, elem, CASE i WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE CAST(i AS VARCHAR) END AS key, value FROM p""",
    ),
    "step_subexplode_limits": (
        step_subexplode_limits,
        """SELECT o_orderkey, CAST(0 AS BIGINT) AS elem, '0' AS key, o_orderpriority AS value FROM orders
           UNION ALL SELECT o_orderkey, 0, '1', o_orderstatus FROM orders
           UNION ALL SELECT o_orderkey, 1, '0', CAST(o_custkey AS VARCHAR) FROM orders
           UNION ALL SELECT o_orderkey, 1, '1', o_orderkey || '| x' FROM orders""",
    ),
    "step_file_access": (
        step_file_access,
        """WITH p AS (SELECT page_id, url, (url LIKE 'http://blog.%' OR url LIKE 'http://www.%' OR url LIKE 'https://%') AS ok FROM pages)
           SELECT page_id, CASE WHEN ok THEN url END AS url, CASE WHEN ok THEN 'imported' ELSE 'ignored' END AS status,
                  CASE WHEN NOT ok THEN 'File is outside the allowed directories and schemes: ' || url END AS text
           FROM p""",
    ),
    "step_file_access_open": (
        step_file_access_open,
        "SELECT page_id, 'warning' AS level, 'No file access rule is set; passed unchecked: ' || url AS text FROM pages",
    ),
    "step_nested_struct": (
        step_nested_struct,
        "SELECT c_custkey, c_name AS name, c_mktsegment AS segment, c_name AS copy FROM customer",
    ),
    "step_sub_process": (
        step_sub_process,
        f"""WITH e AS (SELECT o_orderkey, unnest(string_split({_CELL}, ';')) AS part,
                              generate_subscripts(string_split({_CELL}, ';'), 1) - 1 AS elem FROM orders),
                 p AS (SELECT o_orderkey, elem, trim(string_split(part, '|')[1]) AS head,
                              coalesce(trim(string_split(part, '|')[2]), 'none') AS tail FROM e)
            SELECT o_orderkey, elem, head, tail, head || '+' || tail AS "both" FROM p""",
    ),
    "step_multi_value": (step_multi_value, f"SELECT page_id, {_BASENAME} || '|nothing' AS names FROM pages"),
    "route_targets": (
        route_targets_query,
        """SELECT event_id, 'image' AS target FROM events WHERE event_type IN ('view', 'click')
           UNION ALL SELECT event_id, 'audio' FROM events WHERE event_type = 'signup'
           UNION ALL SELECT event_id, 'video' FROM events WHERE event_type = 'purchase'
           UNION ALL SELECT event_id, 'file' FROM events WHERE event_type = 'purchase'""",
    ),
    "default_bundle": (
        default_bundle_query,
        "SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'image' ELSE 'file' END AS bundle FROM events",
    ),
    "step_file_copy": (
        step_file_copy,
        """WITH p AS (SELECT page_id, regexp_extract(url, '/(de|en|es|fr)/', 1) AS lang FROM pages),
                n AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY page_id) AS nth FROM p)
           SELECT CAST(page_id AS VARCHAR) AS src_key,
                  'repo-bin://' || lang || CASE WHEN nth > 1 THEN '_' || (nth - 1) ELSE '' END || '.' || lang AS uri
           FROM n""",
    ),
    "copy_manifest": (
        copy_manifest_query,
        """WITH n AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS nth FROM part)
           SELECT p_partkey, p_brand AS copy_from,
                  'bin/' || p_name || CASE WHEN nth > 1 THEN '_' || (nth - 1) ELSE '' END || '.dat' AS copy_to,
                  false AS move
           FROM n""",
    ),
}
