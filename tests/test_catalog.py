import pytest
from pyspark.sql import functions as F

from tabweave.plans import catalog as C
from tabweave.plans.ordering import job_levels, levels_of


@pytest.fixture(scope="module")
def migrations(spark):
    rows = [("node", "isi", ["isi_template"]), ("file", "isi", []), ("media", "isi", []), ("other", "else", [])]
    return spark.createDataFrame(rows, "migration string, grp string, tags array<string>")


def test_templates_and_tags(spark):
    groups = spark.createDataFrame(
        [("a", ["isi_template"]), ("b", ["isi_template", "isi_derived_migration"]), ("c", []), ("d", None), ("e", ["isi_manage_orphans"])],
        "grp string, tags array<string>",
    )
    assert [r.grp for r in C.templates(groups).collect()] == ["a"]
    assert [r.grp for r in C.manages_orphans(groups).collect()] == ["e"]


def test_weights_run_on_across_migrations(spark):
    fields = spark.createDataFrame([("g", "m1", 0, "x"), ("g", "m1", 1, "y"), ("g", "m2", 0, "x"), ("h", "m3", 0, "z")], "grp string, migration string, pos int, dest string")
    rows = {(r.migration, r.dest): r.weight for r in C.mapping_of(fields).collect()}
    assert rows == {("m1", "x"): 0, ("m1", "y"): 1, ("m2", "x"): 2, ("m3", "z"): 0}
    assert {r.weight for r in C.mapping_of(fields, "g", hot_rows=1).collect()} == {0, 1, 2}


def test_used_columns(spark):
    steps = spark.createDataFrame(
        [
            ("m", "get", ["A", "@b", "A"], None),
            ("m", "static_map", ["B"], {"x": ["C"]}),
            ("m", "migration_lookup", None, {"x": ["D", "@e"], "y": ["A"]}),
            ("m", "default_value", None, None),
        ],
        "migration string, plugin string, sources array<string>, source_ids map<string,array<string>>",
    )
    assert sorted(r.source_column for r in C.used_columns(steps).collect()) == ["A", "A", "A", "B", "D"]


def test_derived_names(spark, migrations):
    requests = spark.createDataFrame([("r1", True, "migration_group:isi", "7"), ("r2", False, "migration_group:isi", "7")], "id string, active boolean, original_mapping string, owner string")
    jobs = {r.original: r for r in C.derive_migrations(requests, migrations).collect()}
    assert set(jobs) == {"node", "file", "media"} and jobs["node"].migration == "isi__r1_node" and jobs["node"].grp == "isi__r1"
    assert jobs["node"].tags == ["isi_template", "isimd", "isi_derived_migration", "isimd:r1"]
    refs = spark.createDataFrame([("media", "file"), ("media", "other"), ("media", "gone")], "migration string, lookup string")
    named = {r.lookup: r.derived_lookup for r in C.derive_lookups(refs, migrations, F.lit("r1")).collect()}
    assert named == {"file": "isi__r1_file", "other": "other", "gone": "gone"}
    depends = spark.createDataFrame([("media", "file"), ("media", "other")], "migration string, requires string")
    rows = C.derive_dependencies(depends, migrations, F.lit("r1")).collect()
    assert [(r.derived_migration, r.derived_requires) for r in rows] == [("isi__r1_media", "isi__r1_file")]


def test_mapping_checks(spark):
    properties = spark.createDataFrame([("m", "title"), ("m", "body"), ("n", "title")], "migration string, dest string")
    mapped = spark.createDataFrame([("m", "title")], "migration string, dest string")
    unused = C.unused_destinations(properties, mapped, ["migration", "dest"])
    assert {(r.migration, r.dest) for r in unused.collect()} == {("m", "body"), ("n", "title")}
    sources = spark.createDataFrame([("title",), ("x",)], "dest string")
    assert [(r.migration, r.dest, r.plugin) for r in C.auto_map(unused, sources, ["dest"]).collect()] == [("n", "title", "get")]
    mappings = spark.createDataFrame([("a", "x"), ("b", "a"), ("c", "a"), ("d", "b")], "dest string, source string")
    removed = spark.createDataFrame([("a",), ("c",)], "dest string")
    assert [r.dest for r in C.dangling_refs(mappings, removed).collect()] == ["b"]


def test_available_sources(spark):
    header = spark.createDataFrame([("ID", "get"), ("Title", "get")], "name string, kind string")
    entries = spark.createDataFrame([("Title", "pipeline")], "name string, kind string")
    constant = spark.createDataFrame([("default_value", "constant")], "name string, kind string")
    got = {r.name: r.kind for r in C.available_sources([header, entries, constant], ["name"], ["kind"]).collect()}
    assert got == {"ID": "get", "Title": "pipeline", "default_value": "constant"}


def test_sync(spark):
    inbound = spark.createDataFrame([("keep.a", "new"), ("keep.b", "new"), ("free", "new")], "name string, body string")
    current = spark.createDataFrame([("keep.a", "mine"), ("keep.c", "mine"), ("free", "old")], "name string, body string")
    assert [r.name for r in C.sync_export(current, ["keep."]).collect()] == ["free"]
    got = {r.name: r.body for r in C.sync_import(inbound, current, ["keep."]).collect()}
    assert got == {"keep.a": "mine", "keep.c": "mine", "free": "new"}


RIGHTS = C.Permissions({"view": "see", "map": "bind"}, "make", "rule")


def test_access(spark):
    requests = spark.createDataFrame([("r1", "u1"), ("r2", "u2")], "id string, owner string")
    grants = spark.createDataFrame(
        [("u1", "see"), ("u2", "bind"), ("u2", "make"), ("root", "rule")], "user string, permission string"
    )
    checks = spark.createDataFrame(
        [(u, r, o) for u in ("u1", "u2", "root") for r in ("r1", "r2") for o in ("view", "map", "create", "other")], "user string, id string, operation string"
    )
    got = {tuple(r) for r in C.check_access(checks, requests, grants, RIGHTS).collect()}
    assert got == {("u1", "r1", "view"), ("u2", "r2", "map"), ("u2", "r1", "create"), ("u2", "r2", "create")} | {
        ("root", r, o) for r in ("r1", "r2") for o in ("view", "map", "create", "other")
    }
    assert [r.id for r in C.may(requests, "u1", "view", ["see"], RIGHTS).collect()] == ["r1"]
    assert C.may(requests, "u1", "map", ["see"], RIGHTS).isEmpty()
    assert C.may(requests, "root", "map", ["rule"], RIGHTS).count() == 2
    items = spark.createDataFrame([(1, ["isi_derived_migration"], "u"), (2, ["isi_derived_migration"], None), (3, [], "u")], "i int, tags array<string>, owner string")
    assert [r.i for r in C.derived_access(items, F.lit("u")).collect()] == [1]


def test_request_dependencies(spark, migrations):
    requests = spark.createDataFrame([("r", "migration_group:isi")], "id string, original_mapping string")
    mappings = spark.createDataFrame([("r", "node"), ("r", "node"), ("r", "gone")], "id string, original_migration string")
    got = {(r.type, r.name) for r in C.request_dependencies(requests, mappings, migrations).collect()}
    assert got == {("migration", "node"), ("migration_group", "isi")}
    odd = requests.withColumn("original_mapping", F.lit("odd:isi"))
    with pytest.raises(Exception, match="Unknown type of original mapping: odd"):
        C.request_dependencies(odd, mappings, migrations).collect()


def test_rederive(spark):
    catalog = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "grp string, v int")
    derived = spark.createDataFrame([("a", 2), ("a", 3), ("b", 2)], "grp string, v int")
    requests = spark.createDataFrame([("a", True), ("b", False)], "grp string, active boolean")
    assert {(r.grp, r.v) for r in C.rederive(catalog, derived, requests).collect()} == {("a", 2), ("a", 3), ("c", 1)}


def test_levels():
    assert levels_of({"media": ["file", "node", "elsewhere"], "node": [], "file": []}) == [["file", "node"], ["media"]]
    with pytest.raises(ValueError, match="require each other"):
        levels_of({"a": ["b"], "b": ["a"]})


def test_levels_of_a_catalog(spark):
    jobs = spark.createDataFrame([(j,) for j in "abcdef"], "job string")
    depends = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "a"), ("d", "c"), ("e", "outside"), ("d", "a")], "job string, requires string")
    got = {r.job: r.level for r in job_levels(jobs, depends).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 0, "f": 0}
    loop = depends.unionByName(spark.createDataFrame([("a", "d")], depends.schema))
    with pytest.raises(ValueError, match="require each other"):
        job_levels(jobs, loop)
