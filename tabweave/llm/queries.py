"""Registered queries: thin digests of the operators over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm import (
    decontaminate,
    fm_dedup,
    licenses,
    mixing,
    phrases,
    quality,
    secrets,
    sharding,
    simhash,
    suffix_dedup,
    topk,
    urls,
    vector_codes,
)
from tabweave.sources.tables import table

SHARDS = 16
# Weights 3, 1, 2 by integral: early, even and late sources.
CURRICULUM = [[(0.0, 4.5), (1.0, 1.5)], [(0.0, 1.0), (1.0, 1.0)], [(0.0, 1.0), (1.0, 3.0)]]
URL_RULES = [
    urls.Rule("org", "/", True),
    urls.Rule("example.org", "/es/", False),
    urls.Rule("example.org", "/en/1", False),
    urls.Rule("com", "/fr/", True),
    urls.Rule("com", "/de/", False),
]


def op1_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard by the key law, and its shard with one shard more."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    tree = sharding.balanced_tree(SHARDS)
    docs = sharding.shard_of(docs, "doc_id", sharding.grown_tree(tree), "grown_shard")
    placed = sharding.shard_documents(docs, tree)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _removed() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, r: n + r["high"] - r["low"])


def op2_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without windows of 20 words that also start earlier."""
    found = fm_dedup.remove_repeated_windows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.col("size").alias("n_words"), _removed().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 400 bytes that also start elsewhere."""
    found = suffix_dedup.remove_repeated_strings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("size").alias("n_bytes"),
        _removed().alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item that it holds."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(docs, items)


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
its AS (
  SELECT DISTINCT item_id, m, s FROM (
    SELECT item_id, least(len(w), 5) AS m,
           unnest([array_to_string(w[x:x+least(len(w), 5)-1], ' ') FOR x IN range(1, greatest(len(w) - 4, 1) + 1)]) AS s
    FROM i WHERE len(w) > 0)),
ds AS (
  SELECT DISTINCT doc_id, m, s FROM (
    SELECT doc_id, m, unnest([array_to_string(w[x:x+m-1], ' ') FOR x IN range(1, len(w) - m + 2)]) AS s
    FROM d CROSS JOIN (SELECT DISTINCT m FROM its) WHERE len(w) >= m)),
n AS (SELECT item_id, count(*) AS n FROM its GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, count(*)::DOUBLE / any_value(n) AS containment
FROM its JOIN ds USING (m, s) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= ceil(any_value(n) * 0.8 - 1e-9)
"""


def op4_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op6_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and license labels of every document."""
    scan = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("base", lambda b: b["first"].cast("bigint"))

    def labels(*fields: str) -> Column:
        every = F.concat(*[F.transform(f, lambda d: d["label"]) for f in fields])
        return F.array_join(F.array_sort(F.array_distinct(every)), ",")

    best = F.array_max(F.transform(F.concat("base", "detections"), lambda d: d["score"]))
    return scan.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"),
        labels("base", "detections").alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
    )


# Documents with at least this score count as good.
GOOD = 0.3


def held_out() -> Column:
    """Whether a document is kept from learning; a null key counts as the empty text."""
    digest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return F.pmod(digest, F.lit(5)) == 0


def op7_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, learnt from labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels.filter(~held_out()))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op8_tiled_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best vectors for every 50th vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op9_segment_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the component that links at 2 or fewer bits reach."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op10_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document, in the order of their first use."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs, CURRICULUM)
    mixed = mixed.withColumn("position", F.round(F.get("positions", F.lit(0)), 9))
    mixed = mixed.select("doc_id", "size", "source_size", "target", "taken", "position")
    # Documents that are never taken have no position; their ids spread them over the ranges behind.
    order = [F.col("position").asc_nulls_last(), F.col("doc_id")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws('|', doc_id, text)) AS h
  FROM documents),
totals AS (SELECT k, sum(size)::BIGINT AS source_size FROM sized GROUP BY k),
ranked AS (SELECT *, (row_number() OVER (ORDER BY k) - 1) % 3 AS turn FROM totals),
capped AS (
  SELECT *, [3.0, 1.0, 2.0][turn + 1]::DOUBLE AS w, source_size * 2.0::DOUBLE AS cap,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS whole FROM ranked),
levels AS (
  SELECT *, (whole - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM capped),
targets AS (SELECT k, turn, source_size, greatest(least(cap, max(level) OVER () * w), 0) AS target FROM levels),
laid AS (
  SELECT sized.*, source_size, target, turn, floor(target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY k ORDER BY h, doc_id NULLS LAST, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN targets USING (k)),
counted AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS passes FROM laid),
took AS (
  SELECT *, greatest(least(budget - passes * source_size - start, size), 0) AS partly,
         start::DOUBLE / budget::DOUBLE AS share FROM counted),
timed AS (
  SELECT *, passes * size + partly AS taken,
         CASE turn WHEN 0 THEN 2 * (share * 3) / (4.5 + sqrt(greatest(20.25 - 6 * (share * 3), 0)))
                   WHEN 1 THEN 2 * share / (1 + 1)
                   ELSE 2 * (share * 2) / (1 + sqrt(1 + 4 * (share * 2))) END AS moment
  FROM took)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
       CASE WHEN taken > 0 THEN round(least(moment, 1), 9) END AS position
FROM timed
"""


def op11_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(spans: Column | str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] != "token")
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def op12_setm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language."""
    return phrases.top_collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, unnest([array_to_string(w[x:x+m-1], ' ') FOR x IN range(1, len(w) - m + 2)]) AS phrase
  FROM words CROSS JOIN range(1, 6) AS r(m) WHERE len(w) >= m),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*)::BIGINT AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, n, k, ((1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k+1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, array_to_string(w[x:x+s-1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, len(w) - s + 2)) AS x
        FROM (SELECT lang, a, string_split(phrase, ' ') AS w, unnest(range(2, m)) AS s FROM f WHERE m > 2))
  GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
  FROM kept)
SELECT * FROM ranked WHERE rank <= 2000
"""


def op13_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and error, and the digest of the codebooks."""
    found, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digits = ",".join(str(x) for book in books for entry in book.tolist() for x in entry)
    return found.select("vec_id", "code", "error", "label_error", F.sha2(F.lit(digits.encode()), 256).alias("codebooks_sha256"))


def _op13_sql() -> str:
    rounds = ""
    for i in range(vector_codes.ROUNDS + 1):
        rounds += f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, row, p, v, min(struct_pack(d := list_sum([(x - y) * (x - y) FOR x, y IN list_zip(v, c)])::BIGINT, e := e)) AS s
  FROM parts JOIN b{i} USING (p) GROUP BY ALL),""".replace(
            "list_sum([(x - y) * (x - y) FOR x, y IN list_zip(v, c)])", "list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v, c)])"
        )
        if i < vector_codes.ROUNDS:
            rounds += f"""
m{i} AS (
  SELECT p, e, list(floor(t / n)::BIGINT ORDER BY j) AS c
  FROM (SELECT p, s.e AS e, j, sum(v[j])::DOUBLE AS t, count(*)::DOUBLE AS n FROM a{i} CROSS JOIN (SELECT unnest(range(1, 65)) AS j)
        WHERE j <= len(v) GROUP BY ALL) GROUP BY ALL),
b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN m{i} USING (p, e)),"""
    last = vector_codes.ROUNDS
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER () AS row, [floor(4096 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, row, p, v[len(v) // 8 * p + 1 : len(v) // 8 * (p + 1)] AS v FROM kept CROSS JOIN range(8) AS r(p)),
b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v AS c FROM parts
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 16),{rounds}
codes AS (
  SELECT vec_id, row, string_agg(printf('%02x', s.e), '' ORDER BY p) AS code, sum(s.d)::BIGINT AS error FROM a{last} GROUP BY ALL),
book AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{last})
SELECT codes.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept USING (row) CROSS JOIN book
"""


OP13_SQL = _op13_sql()


def registered() -> dict[str, tuple]:
    """Name to (query, SQL or None)."""
    import corpus_pipeline

    return {
        "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
        "op1_hash_tree": (op1_hash_tree, None),
        "op2_fm_index": (op2_fm_index, None),
        "op3_containment": (op3_containment, OP3_SQL),
        "op4_url_ratio": (op4_url_ratio, None),
        "op5_suffix_array": (op5_suffix_array, None),
        "op6_signature_rules": (op6_signature_rules, None),
        "op7_neighbour_vote": (op7_neighbour_vote, None),
        "op8_tiled_topk": (op8_tiled_topk, OP8_SQL),
        "op9_segment_grid": (op9_segment_grid, None),
        "op10_curriculum": (op10_curriculum, OP10_SQL),
        "op11_token_efficiency": (op11_token_efficiency, None),
        "op12_setm": (op12_setm, OP12_SQL),
        "op13_cover_tree": (op13_cover_tree, OP13_SQL),
    }
