"""URL filter by character language models.

Two variable-order Markov models, one of accepted and one of rejected URLs, give each character its
probability after the characters before it. A URL's score is the mean over its characters of the
difference of log-probabilities; a threshold between the two classes' scores parts them. The threshold is
calibrated on examples that the models have not seen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.llm.text import free_name, lower_ascii
from tabweave.session import materialize

# Longest run of characters of the models: a character and the four before it.
ORDER = 5
# Weight of the next shorter context, in observations.
PRIOR = 4.0
# One of so many examples, by the hash of its text, is kept from the models for the threshold.
FOLDS = 5
# A run with more than one of so many parts of all places is dealt over several tasks.
SHARES = 1000
# Values are added up as whole numbers of this unit, so that sums do not depend on their order.
UNIT = 1e-9
# Stands before the first character.
_START = "\x02"


@dataclass(frozen=True)
class Rule:
    """A verdict on a host with its subdomains, for paths that start with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


def url_parts(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """Add host, A-Z in lower case, and path. Both are empty for null and where ``://`` is missing."""
    rest = free_name("_rest", [*df.columns, host, path])
    after = f"CASE WHEN instr(`{url}`, '://') > 0 THEN substring(`{url}`, instr(`{url}`, '://') + 3) ELSE '' END"
    parts = df.withColumn(rest, F.expr(after))
    found = {
        host: lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)),
        path: F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
    }
    return parts.withColumns(found).drop(rest)


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls. Of equal lengths, the last given."""
    name, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        name, allow = F.when(fits, F.lit(rule.name)).otherwise(name), F.when(fits, F.lit(rule.allow)).otherwise(allow)
    return name, allow


def _padded(text: Column) -> Column:
    """The characters of ``text`` behind start marks."""
    marks = F.array_repeat(F.lit(_START), ORDER - 1)
    return F.concat(marks, F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))


def _run(chars: Column, i: Column, n: int) -> Column:
    """The ``n`` characters that end at 0-based place ``i``."""
    return F.concat(*[F.get(chars, i - (n - 1 - k)) for k in range(n)])


def _places(chars: Column) -> Column:
    """Places of the characters behind the start marks."""
    some = F.sequence(F.lit(ORDER - 1), F.size(chars) - 1)
    return F.when(F.size(chars) >= ORDER, some).otherwise(F.array().cast("array<int>"))


def run_values(labelled: DataFrame, chars: str, allow: str, times: str | None = None) -> DataFrame:
    """The models as one table: ``run``, ``seen`` and ``value``, the difference of its log-probabilities.

    All labelled URLs count, each as often as ``times`` tells. The probability of a run's last character is its count after the run's context,
    smoothed towards that of the next shorter run, and at last to 1 / 256.
    """
    n = F.lit(1) if times is None else F.col(times)
    places = labelled.select(chars, allow, n.alias("n"), F.explode(_places(F.col(chars))).alias("i"))
    every = F.array(*[_run(F.col(chars), F.col("i"), n) for n in range(1, ORDER + 1)])
    good = F.sum(F.when(F.col(allow), F.col("n")).otherwise(0)).cast("double")
    bad = F.sum(F.when(F.col(allow), 0).otherwise(F.col("n"))).cast("double")
    counts = places.select(allow, "n", F.explode(every).alias("run")).groupBy("run").agg(good.alias("a"), bad.alias("b"))
    counts = counts.withColumn("n", F.char_length("run")).withColumn("c", F.expr("substring(run, 1, n - 1)"))
    contexts = counts.groupBy("c").agg(F.sum("a").alias("ca"), F.sum("b").alias("cb"))
    known = counts.join(contexts, "c").select("run", "n", "a", "b", "ca", "cb")
    # A run's endings, shortest first, are the steps of its smoothing; each is itself a run.
    ends = known.select("run", (F.col("a") + F.col("b")).alias("seen"), "n", F.explode(F.expr("sequence(1, n)")).alias("k"))
    ends = ends.withColumn("end", F.expr("substring(run, n - k + 1, k)"))
    steps = F.array_sort(F.collect_list(F.struct("k", "a", "b", "ca", "cb"))).alias("steps")
    runs = ends.join(known.select(F.col("run").alias("end"), "a", "b", "ca", "cb"), "end")
    runs = runs.groupBy("run").agg(F.max("seen").alias("seen"), steps)

    def chance(count: str, context: str) -> Column:
        prior = F.lit(PRIOR)
        return F.aggregate("steps", F.lit(1 / 256), lambda p, s: (s[count] + prior * p) / (s[context] + prior))

    return runs.select("run", "seen", (F.log(chance("a", "ca")) - F.log(chance("b", "cb"))).alias("value"))


def _longest(runs: DataFrame, values: DataFrame) -> DataFrame:
    """``runs`` with ``units``, the value of the longest end of ``run`` that ``values`` has, or null."""
    ends = runs.select("run", F.explode(F.expr(f"sequence(1, {ORDER})")).alias("k"))
    ends = ends.withColumn("end", F.expr(f"substring(run, {ORDER} + 1 - k, k)"))
    known = values.select(F.col("run").alias("end"), F.round(F.col("value") / UNIT).cast("bigint").alias("units"))
    best = ends.join(known, "end").groupBy("run").agg(F.max(F.struct("k", "units")).alias("best"))
    return runs.join(best.select("run", "best.units"), "run", "left")


def score_texts(texts: DataFrame, values: DataFrame) -> DataFrame:
    """``texts``, told apart by ``id``, with ``score``: the mean value over the characters of ``text``, 0 without any.

    Each place has the value of the longest run of ``values`` that ends there. All runs count: they are joined
    to the places, in which a frequent run goes to as many tasks as its share asks for.
    """
    chars = texts.select("id", _padded(F.col("text")).alias("chars"))
    found = F.transform(_places(F.col("chars")), lambda i: _run(F.col("chars"), i, ORDER))
    places = chars.select("id", F.posexplode(found).alias("i", "run"))
    runs = materialize(places.groupBy("run").agg(F.count(F.lit(1)).alias("n")), "runs")
    whole = runs.agg(F.sum("n")).first()[0] or 1
    runs = runs.select("run", F.ceil(F.col("n") * SHARES / whole).cast("int").alias("parts"))
    runs = materialize(_longest(runs, values), "values")
    # Fewer than SHARES rows, however many runs there are.
    hot = runs.filter("parts > 1").select("run", "parts")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", "i"), F.col("parts"))).cast("int")
    dealt = places.join(F.broadcast(hot), "run", "left").select("id", "run", part.alias("part"))
    known = runs.filter("units IS NOT NULL").select("run", "units", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    sums = dealt.join(known, ["run", "part"]).groupBy("id").agg(F.sum("units").alias("units"))
    size = F.size(_padded(F.col("text"))) - (ORDER - 1)
    mean = F.coalesce(F.col("units") * UNIT / F.greatest(size, F.lit(1)), F.lit(0.0))
    return texts.join(sums, "id", "left").withColumn("score", mean).drop("units")


def _threshold(scores: DataFrame) -> float:
    """Between the mean scores of the classes, nearer to the one that scatters less; ``good`` and ``bad`` are weights."""
    s = F.col("score")
    mean = scores.agg(*[(F.sum(F.col(c) * s) / F.sum(c)).alias(c) for c in ("good", "bad")]).first()
    spread = scores.agg(*[F.sqrt(F.sum(F.col(c) * (s - mean[c]) ** 2) / F.sum(c)).alias(c) for c in ("good", "bad")]).first()
    near, far = spread["bad"] + 1e-9, spread["good"] + 1e-9
    return (mean["bad"] * far + mean["good"] * near) / (near + far)


def filter_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score``; columns of these names are replaced.

    The models read host and path. URLs with a rule are examples and keep the rule's verdict; all others are
    allowed if their score reaches the threshold. The models learn from four fifths of the examples, every run of
    which counts, and the threshold is set by the other fifth, told apart by the hash of host and path; if either
    part lacks a class, all examples serve for both. With examples of one class only there is nothing to
    compare: all URLs get that class. Without any, all are allowed. A null URL, or one without ``://``, has no
    characters and scores 0. Repeated URLs count as often as they occur; a table without rows gives none.

    Every distinct URL is scored once, and the scores are joined to the pages; nothing is gathered.
    """
    base = pages.drop(*[c for c in ("host", "path", "rule", "verdict", "score") if c != url])
    allow, text = (free_name(x, base.columns) for x in ("_allow", "_text"))
    judged = url_parts(base, url, "host", "path")
    name, fits = rule_of(rules, F.col("host"), F.col("path"))
    judged = judged.withColumn("rule", name).withColumn(allow, fits)
    # Host and path follow from the text, and so do rule and verdict.
    texts = judged.select(F.concat("host", "path").alias("text"), F.col(allow).alias("allow")).groupBy("text")
    texts = texts.agg(F.count_if("allow").alias("good"), F.count_if(~F.col("allow")).alias("bad"))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == 0
    texts = materialize(texts.withColumns({"kept": kept, "id": F.monotonically_increasing_id()}), "texts")
    # The distinct texts are few rows in one file, of which many rows are made: as many tasks as a shuffle has get some.
    texts = texts.repartition(parts, "id")
    sums = [F.sum(F.when(F.col("kept") == k, F.col(c))).alias(f"{c}_{k}") for c in ("good", "bad") for k in (True, False)]
    count = {k: n or 0 for k, n in texts.agg(*sums).first().asDict().items()}
    good, bad = (count[f"{c}_True"] + count[f"{c}_False"] for c in ("good", "bad"))
    if not good or not bad:
        scored, passed = judged.withColumn("score", F.lit(0.0)), F.lit(bool(good) or not bad)
    else:
        learnt, told = (~F.col("kept"), F.col("kept")) if all(count.values()) else (F.lit(True), F.lit(True))
        marked = texts.filter(learnt & (F.col("good") + F.col("bad") > 0)).select(_padded(F.col("text")).alias("chars"), "good", "bad")
        examples = marked.select("chars", F.explode(F.expr("array(true, false)")).alias("allow"), "good", "bad")
        examples = examples.withColumn("n", F.when(F.col("allow"), F.col("good")).otherwise(F.col("bad")))
        values = run_values(examples.filter("n > 0"), "chars", "allow", "n")
        scores = materialize(score_texts(texts, values), "scores")
        # No text has a question mark; those that are empty, which may be many, look nothing up.
        spread = F.concat(F.lit("?"), F.pmod(F.monotonically_increasing_id(), F.lit(1000)).cast("string"))
        whole = F.concat("host", "path")
        keyed = judged.withColumn(text, F.when(whole == "", spread).otherwise(whole))
        of = scores.filter("text <> ''").select(F.col("text").alias(text), F.col("score"))
        scored = keyed.join(of, text, "left").withColumn("score", F.coalesce("score", F.lit(0.0))).drop(text)
        passed = F.col("score") >= F.lit(_threshold(scores.filter(told)))
    verdict = F.when(F.coalesce(F.col(allow), passed), F.lit("allow")).otherwise(F.lit("block"))
    columns = [*base.columns, "host", "path", "rule", "score"]
    return scored.withColumn("verdict", verdict).select(*[F.col(f"`{c}`") for c in columns], "verdict")
