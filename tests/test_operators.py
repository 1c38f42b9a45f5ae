import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabweave.functions.steps import Context
from tabweave.functions.text import path_allowed, row_hash
from tabweave.operators import lookups as L
from tabweave.operators import state as S
from tabweave.operators.access import longest_rule
from tabweave.operators.ledger import file_usage, usage_events
from tabweave.operators.manifest import copy_manifest, free_numbers, number_clashes
from tabweave.operators.multivalue import explode_values
from tabweave.operators.numbering import running_number
from tabweave.plans.compiler import STUBS, accepted, compile_mapping


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, and rows without a group."""
    group = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 != 0, (F.col("id") % 50).cast("string"))
    return spark.range(3000).select("id", group.alias("g"))


@pytest.mark.parametrize("hot_rows", [5, 500, 10**6])
def test_hot_groups_are_numbered_alike(spark, skewed, hot_rows):
    got = running_number(skewed, ["g"], ["id"], "n", hot_rows)
    want = skewed.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("id")).cast("bigint"))
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_global_numbers(spark, skewed):
    got = running_number(skewed.repartition(7), [], ["id"], "n")
    assert got.filter("id + 1 <> n").isEmpty() and got.count() == 3000


def test_clashes_with_a_hot_name(spark):
    df = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, "d/a.tar").when(F.col("id") != 1, "plain").alias("p"))
    rows = {r.id: r.to for r in number_clashes(df, "p", ["id"], "to", hot_rows=20).collect()}
    assert rows[0] == "d/a.tar" and rows[2] == "d/a_1.tar" and rows[398] == "d/a_199.tar"
    assert rows[3] == "plain" and rows[5] == "plain_1" and rows[1] is None
    assert len(set(rows.values())) == 400


def test_copy_manifest_rules(spark):
    df = spark.createDataFrame([(1, "s", ".profile"), (2, "s", ".profile")], "k int, s string, d string")
    assert {r.copy_to for r in copy_manifest(df, "s", "d", ["k"]).collect()} == {".profile", ".profile_1"}
    assert {r.copy_to for r in copy_manifest(df, "s", "d", ["k"], file_exists="replace", move=True).collect()} == {".profile"}
    with pytest.raises(ValueError):
        copy_manifest(df, "s", "d", ["k"], file_exists="other")


def test_entity_lookup(spark):
    entities = spark.createDataFrame([("Big", "b2"), ("big", "b1"), ("small", "s")], "value string, id string")
    df = spark.createDataFrame([("1", "BIG"), ("2", "small"), ("3", None), ("4", "no")], "k string, v string")
    hits = {r.k: r.o for r in L.entity_lookup(df, "v", entities, "o", ignore_case=True, row_key="k").collect()}
    assert hits == {"1": "b1", "2": "s", "3": None, "4": None}
    hits = {r.k: r.o for r in L.entity_lookup(df, "v", entities, "o").collect()}
    assert hits["1"] is None and hits["2"] == "s"


def test_lookup_with_numbers_and_many_missing_keys(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 != 0, F.col("id")).alias("v"))
    entities = spark.range(0, 1000, 2).select(F.col("id").alias("value"), F.col("id").alias("id"))
    got = L.entity_lookup(df, "v", entities, "o", row_key="id")
    want = F.when((F.col("id") % 3 != 0) & (F.col("id") % 2 == 0), F.col("id"))
    assert got.count() == 1000 and got.filter(~F.col("o").eqNullSafe(want)).isEmpty()


def test_lookups_over_lists_and_composite_keys(spark):
    df = spark.createDataFrame([("1", ["a", "no", "b"]), ("2", []), ("3", None)], "k string, v array<string>")
    entities = spark.createDataFrame([("a", 1), ("b", 2)], "value string, id int")
    hits = {r.k: r.o for r in L.entity_lookup(df, "v", entities, "o", row_key="k").collect()}
    assert hits == {"1": [1, 2], "2": None, "3": None}
    known = spark.createDataFrame([("m", "a\x1fb", "AB")], "migration string, src_key string, dest_id string")
    rows = spark.createDataFrame([("1", "a", "b"), ("2", "a", "c")], "src_key string, x string, y string")
    mapping = {"o": [{"plugin": "get", "source": ["x", "y"]}, {"plugin": "migration_lookup", "migration": "m"}]}
    out = compile_mapping(rows, mapping, Context(migration="n", id_map=known), ["src_key"])
    got = {r.src_key: r for r in out.collect()}
    assert got["1"].o == "AB" and got["2"].o is not None and got["2"][STUBS][0].src_key == "a\x1fc"


def test_each_map_asked_with_its_own_columns(spark):
    known = spark.createDataFrame([("m1", "1", "A"), ("m2", "2", "B"), ("m2", "1", "no")], "migration string, src_key string, dest_id string")
    rows = spark.createDataFrame([("r1", "1", "2"), ("r2", "9", "2"), ("r3", "9", "9")], "src_key string, x string, y string")
    step = {"plugin": "migration_lookup", "migration": ["m1", "m2"], "source_ids": {"m1": ["x"], "m2": ["y"]}, "no_stub": True}
    out = accepted(compile_mapping(rows, {"o": [step]}, Context(migration="n", id_map=known), ["src_key"]))
    assert {r.src_key: r.o for r in out.collect()} == {"r1": "A", "r2": "B", "r3": None}


def test_stubs(spark):
    rows = spark.createDataFrame([("1", "t")], "src_key string, title string")
    refs = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "src_key string")
    got = {(r.src_key, r.title, r.is_stub) for r in L.with_stubs(rows, refs).collect()}
    assert got == {("1", "t", False), ("2", None, True)}


def test_members_and_load_entity(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "a", "b")], "k int, x string, y string")
    got = {r.k: r.m for r in df.select("k", L.members(F.col("x"), F.col("y")).alias("m")).collect()}
    assert got == {1: ["a"], 2: None, 3: ["a", "b"]}
    targets = spark.createDataFrame([("a", 5)], "id string, n int")
    got = {r.k: r.e for r in L.load_entity(df, "x", targets, "e", row_key="k").collect()}
    assert got[1].n == 5 and got[2] is None


def test_change_detection(spark):
    cells = spark.createDataFrame([("1", "a", ""), ("2", "b", None), ("3", "c", "x"), ("5", "e", "z")], "src_key string, x string, y string")
    now = cells.withColumn("row_hash", row_hash([F.col("x"), F.col("y")]))
    assert now.select("row_hash").distinct().count() == 4
    known = now.withColumn("status", F.when(F.col("src_key") == "5", "needs_update").otherwise("imported"))
    assert {r.src_key: r.change for r in S.classify_rows(now, known).collect()} == {"1": "unchanged", "2": "unchanged", "3": "unchanged", "5": "changed"}
    edited = now.withColumn("row_hash", F.when(F.col("src_key") == "2", "other").otherwise(F.col("row_hash"))).filter("src_key <> '3'")
    more = edited.unionByName(edited.limit(1).withColumn("src_key", F.lit("4")))
    assert {r.src_key: r.change for r in S.classify_rows(more, known).collect()} == {"1": "unchanged", "2": "changed", "3": "gone", "4": "new", "5": "changed"}
    assert {r.src_key for r in S.rows_to_import(more, known).collect()} == {"2", "4", "5"}
    assert {r.src_key for r in S.rows_to_import(more, known, track_changes=False).collect()} == {"4", "5"}
    assert {r.src_key for r in S.rows_to_import(more, known, update=True, limit=2).collect()} == {"1", "2"}


def test_progress(spark):
    id_map = spark.createDataFrame([("m", "imported"), ("m", "failed"), ("n", "imported")], "migration string, status string")
    got = {(r.migration, r.status): r.n_rows for r in S.progress(id_map).collect()}
    assert got[(None, None)] == 3 and got[("m", None)] == 2 and got[("n", "imported")] == 1
    totals = spark.createDataFrame([("m", 4), ("e", 0)], "migration string, total long")
    got = {r.migration: (r.done, r.finished) for r in S.progress_ratio(id_map, totals).collect()}
    assert got == {"m": (2, 0.5), "e": (0, 1.0)}


def test_isolated_errors(spark):
    df = spark.createDataFrame([("1", "x"), (None, "2"), ("y", "z")], "a string, b string")
    rows = S.isolate_errors(df, {"n": ("a", "int"), "m": ("b", "int")}).collect()
    assert [r.error for r in rows] == ["Not of type int: x", None, "Not of type int: y"]
    assert [(r.n, r.m) for r in rows] == [(1, None), (None, 2), (None, None)]


def test_ledger(spark):
    changes = spark.createDataFrame(
        [("insert", "r", None, "f"), ("update", "r", "f", "g"), ("insert", "s", None, "g"), ("delete", "s", "g", None), ("insert", "t", None, None)],
        "op string, request string, old_file string, new_file string",
    )
    assert {(r.file, r.request): r.uses for r in file_usage(usage_events(changes)).collect()} == {("f", "r"): 0, ("g", "r"): 1, ("g", "s"): 0}


def test_explode_values(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "k int, v array<string>")
    rows = explode_values(df, "v", ["k"], position="at").collect()
    assert [(r.k, r["at"], r.value) for r in rows] == [(1, 0, "a"), (1, 1, None)]


def test_constants_are_looked_up_once(spark):
    entities = spark.createDataFrame(
        [("term", "vid", "use", "uri", "X#File", "u2"), ("term", "vid", "use", "uri", "x#file", "u1"), ("term", "vid", "no", "uri", "x#file", "u0")],
        "entity_type string, bundle_key string, bundle string, value_key string, value string, id string",
    )
    look = {"plugin": "entity_lookup", "entity_type": "term", "bundle": "use", "value_key": "uri", "ignore_case": True}
    mapping = {
        "use": [{"plugin": "default_value", "default_value": "x#FILE"}, look],
        "none": [{"plugin": "default_value", "default_value": "other"}, look, {"plugin": "default_value", "default_value": "z"}],
    }
    rows = spark.createDataFrame([("1",), ("2",)], "src_key string")
    out = accepted(compile_mapping(rows, mapping, Context(entities=entities), ["src_key"]))
    assert {(r.use, r.none) for r in out.collect()} == {("u1", "z")}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def named_by_hand(rows, given=()):
    """The names that rows (key, path) get one after the other: numbers skip those asked for, and go on behind given ones."""
    wanted, out, at = {p for _, p in rows if p}, {}, {}
    for key, path in sorted(rows):
        if path is None:
            out[key] = None
            continue
        stem, _, suffix = path.rpartition(".")
        name = lambda k: path if k == 0 else f"{stem}_{k}.{suffix}"  # noqa: B023, E731
        if path not in at:
            ks = [k for k in range(500) if name(k) in given]
            at[path] = max(ks) + 1 if ks else 0
        while at[path] > 0 and name(at[path]) in wanted:
            at[path] += 1
        out[key] = name(at[path])
        at[path] += 1
    return out


@pytest.mark.parametrize("hot_rows", [1_000_000, 25])
def test_clashes_step_over_names_that_are_asked_for(spark, hot_rows):
    rows = []
    for i in range(300):
        path = "d/hot.png" if i % 3 == 0 else f"d/hot_{i % 40}.png" if i % 7 == 0 else f"e/x{i % 5}.y.tif" if i % 2 else None
        rows.append((i, path))
    rows += [(300 + i, f"e/x1.y_{k}.tif") for i, k in enumerate((1, 2, 5, 9, 100))]
    df = spark.createDataFrame(rows, "id long, p string").repartition(3)
    got = number_clashes(df, "p", ["id"], "to", hot_rows=hot_rows)
    assert got.columns == ["id", "p", "to"]
    assert {r.id: r.to for r in got.collect()} == named_by_hand(rows)
    given = ["d/hot.png", "d/hot_7.png", "d/hot_12.png", "e/x3.y.tif"]
    got = number_clashes(df, "p", ["id"], "to", hot_rows=hot_rows, given=spark.createDataFrame([(g,) for g in given], "to string"))
    assert {r.id: r.to for r in got.collect()} == named_by_hand(rows, given)


def test_free_numbers_of_a_hot_base(spark):
    rng = random.Random(3)
    taken = {b: sorted(rng.sample(range(400), n)) for b, n in (("a", 200), ("b", 1), ("c", 0))}
    claims = [(b, n + 1) for b, size in (("a", 250), ("b", 3), ("c", 4)) for n in range(size)]
    got = free_numbers(
        spark.createDataFrame(claims, "base string, nth long"), spark.createDataFrame([(b, k) for b, ks in taken.items() for k in ks], "base string, k long"),
        "base", "nth", "free", hot_rows=30,
    )
    free = {b: [k for k in range(1000) if k not in set(ks)] for b, ks in taken.items()}
    assert {(r.base, r.nth): r.free for r in got.collect()} == {(b, n): free[b][n - 1] for b, n in claims}


def test_rules_as_a_table_say_what_the_expression_says(spark):
    rules = ["/a/b", "/a", "/a/b/", "s3://x/y", "/a/bc/d", "/\u00e9/"]
    paths = ["/a/b/c", "/a/bx", "/a", "/ab", "/a/b", "/a/b/../c", "..", "s3://x/y/z", "s3://x/yz", "/a/bc/d", "/\u00e9/1", "/z", "", None, "/a/b/c"]
    df = spark.createDataFrame([(i, p, "z") for i, p in enumerate(paths)], "id int, p string, found string")
    frame = spark.createDataFrame([(r,) for r in [*rules, None, rules[0]]], "rule string")
    for strict in (False, True):
        got = longest_rule(df, "p", frame, "found", strict=strict).withColumn("was", path_allowed(F.col("p"), rules, [], strict))
        rows = got.collect()
        assert len(rows) == len(paths) and all((r.found is not None) == r.was for r in rows)
        best = {r.p: (r.found or "").rstrip("/") for r in rows}
        assert best["/a/b/c"] == "/a/b" and best["/a/bx"] == ("/a" if strict else "/a/b") and best["/a/bc/d"] == "/a/bc/d"
    assert longest_rule(df, "p", frame.limit(0), "found").filter("found IS NOT NULL").isEmpty()


def test_many_rules_make_no_larger_plan(spark):
    paths = spark.range(2000).select(F.concat(F.lit("/r"), F.col("id"), F.lit("/f")).alias("p"))
    many = spark.range(100_000).filter("id % 2 = 0").select(F.concat(F.lit("/r"), F.col("id"), F.lit("/")).alias("rule"))
    got = longest_rule(paths, "p", many, "rule")
    assert got.filter("rule IS NOT NULL").count() == 1000
    few = longest_rule(paths, "p", many.filter("id < 100000"), "rule")
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert size(got) < size(few) + 2000


def test_lookups_by_collation(spark):
    words = ["Z\u00dcRICH", "zurich", "Zu\u0308rich", "\u0130zmir", "STRASSE", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    known = spark.createDataFrame([("Z\u00fcrich", 1), ("izmir", 2), ("z\u00fcrich", 3)], "value string, id int")
    hits = {r.w: r.hit for r in L.entity_lookup(df, "w", known, "hit", collation="UNICODE_CI_AI").collect()}
    assert list(hits.values()).count(1) == 3 and hits["\u0130zmir"] == 2 and hits["STRASSE"] is None and hits[None] is None
    assert {r.w: r.hit for r in L.entity_lookup(df, "w", known, "hit").collect()} == dict.fromkeys(words)
