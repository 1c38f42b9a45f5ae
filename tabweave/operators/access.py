"""File access rules as a table: the longest directory that a path starts with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.functions.text import source_col
from tabweave.session import BROADCAST_ROWS, bounded_broadcast


def longest_rule(df: DataFrame, path: str, rules: DataFrame, out: str, strict: bool = False, rule: str = "rule") -> DataFrame:
    """``df`` with ``out``, the longest of the ``rules`` that allows the path, or NULL.

    A rule allows what starts with it; with ``strict``, itself and what lies below it as a directory, whether it
    ends in a slash or not. A path with a ``..`` segment is allowed by none. Rules are rows: the prefixes of a path
    that may be rules, one for each length that some rule has, are looked up by equality, so the plan does not
    grow with the rules and no path is compared with all of them. Each distinct path is looked up once.
    """
    name = F.rtrim(source_col(rule), F.lit("/")) if strict else source_col(rule)
    known = rules.select(name.alias("_rule"), source_col(rule).alias("_named")).filter("_rule IS NOT NULL")
    known = known.groupBy("_rule").agg(F.min("_named").alias("_named"))
    # As many numbers as there are lengths, however many rules.
    lengths = sorted(r.n for r in known.select(F.char_length("_rule").alias("n")).distinct().collect())
    paths = df.select(source_col(path).alias("_path")).distinct().filter(~F.col("_path").rlike(r"(^|/)\.\.(/|$)"))
    size = F.char_length("_path")
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= size)
    if strict:
        # A directory ends where the path does or a slash follows.
        cuts = F.filter(cuts, lambda n: (n == size) | (F.substring("_path", n + 1, F.lit(1)) == "/"))
    prefixes = paths.select("_path", F.explode(cuts).alias("_n"))
    prefixes = prefixes.select("_path", "_n", F.substring("_path", F.lit(1), F.col("_n")).alias("_rule"))
    rows = known.limit(BROADCAST_ROWS + 1).count()
    hits = prefixes.join(bounded_broadcast(known, rows), "_rule").groupBy("_path")
    best = hits.agg(F.max(F.struct("_n", "_named")).alias("_best")).select("_path", F.col("_best._named").alias(out))
    columns = [source_col(c) for c in df.columns if c != out]
    return df.join(best, source_col(path) == F.col("_path"), "left").select(*columns, best[out])
