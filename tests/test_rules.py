"""Rules that hold for every size and shape of value, and for runs that were cut short."""

import datetime

import pytest
from pyspark.sql import functions as F

from tabweave.functions import text as X
from tabweave.functions.steps import Context
from tabweave.operators.lookups import entity_lookup
from tabweave.plans.compiler import MESSAGES, STATUS, compile_mapping
from tabweave.plans.ingest import Group, Job, Options, import_group, import_job, rollback_job
from tabweave.plans.store import ID_MAP, Store
from tabweave.sources.cells import select_worksheet
from tabweave.sources.delimited import peek_header, read_sheet

KEYS = {"ID": "integer"}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "state"))


def cells(spark, rows, names="ID, Ref, Title"):
    return spark.createDataFrame(rows, ", ".join(f"{n.strip()} string" for n in names.split(",")))


@pytest.mark.parametrize("size", [1, 64, 65, 3000])
def test_static_map_is_the_same_at_every_size(spark, size):
    entries = {f"k{i}": f"v{i}" for i in range(size)} | {1: "number", "1": "text"}
    df = spark.createDataFrame([("a", "k0", "1"), ("b", "zz", "k0"), ("c", None, "k0")], "src_key string, x string, y string")
    steps = [{"plugin": "static_map", "map": entries, "bypass": True}]
    strict = [{"plugin": "static_map", "map": entries}]
    nested = [{"plugin": "get", "source": "@_parts"}, {"plugin": "sub_process", "process": {"m": [{"plugin": "get", "source": "0"}, *steps]}}]
    mapping = {
        "one": [{"plugin": "get", "source": "x"}, *steps],
        "list": [{"plugin": "get", "source": ["x", "y"]}, *steps],
        "_parts": [{"plugin": "get", "source": "y"}, {"plugin": "subdelimited_explode", "delimiter": ";", "subdelimiter": "|"}],
        "nested": nested,
        "strict": [{"plugin": "get", "source": "x"}, *strict],
    }
    rows = {r.src_key: r for r in compile_mapping(df, mapping, Context(), ["src_key"]).collect()}
    assert len(rows) == 3
    assert (rows["a"].one, rows["a"].list, rows["a"].nested[0].m, rows["a"].strict) == ("v0", ["v0", "text"], "text", "v0")
    assert (rows["b"].one, rows["b"][STATUS], rows["b"][MESSAGES][0].text) == ("zz", "ignored", "No mapping for value: zz")
    assert rows["c"][STATUS] == "ignored"


def test_nested_lookups_messages_types_and_nesting(spark):
    id_map = spark.createDataFrame([("m", "1", "A"), ("m", "2", "B")], "migration string, src_key string, dest_id string")
    df = spark.createDataFrame([("x", "1|p;7|q", 3), ("y", "2|", 4), ("z", "", 5)], "src_key string, cell string, n int")
    explode = {"plugin": "subdelimited_explode", "delimiter": ";", "subdelimiter": "|", "keys": ["id", "tag"]}
    children = {
        "hit": [{"plugin": "get", "source": "id"}, {"plugin": "migration_lookup", "migration": "m", "stub_id": "m"}],
        "said": [{"plugin": "get", "source": "tag"}, {"plugin": "log", "template": "tag :value"}],
        "many": [{"plugin": "get", "source": ["id", "tag"]}, {"plugin": "skip_on_empty", "method": "process"}, {"plugin": "concat", "delimiter": "/"}],
    }
    mapping = {"_parts": [{"plugin": "get", "source": "cell"}, explode], "out": [{"plugin": "get", "source": "@_parts"}, {"plugin": "sub_process", "process": children}]}
    rows = {r.src_key: r for r in compile_mapping(df, mapping, Context(id_map=id_map), ["src_key"]).collect()}
    assert [(e.hit, e.said, e.many) for e in rows["y"].out] == [("B", "", "2/")]
    assert rows["x"].out[0].hit == "A" and rows["x"].out[1].hit is not None and rows["z"].out == []
    assert [m.text for m in rows["x"][MESSAGES]] == ["tag p", "tag q"]
    assert [s.src_key for s in rows["x"]["_stubs"]] == ["7"]
    ends = {"v": [{"plugin": "get", "source": "tag"}, {"plugin": "log"}, {"plugin": "skip_on_empty", "method": "row", "message": "no tag"}]}
    mapping["out"] = [{"plugin": "get", "source": "@_parts"}, {"plugin": "sub_process", "process": ends}]
    rows = {r.src_key: r for r in compile_mapping(df, mapping, Context(), ["src_key"]).collect()}
    assert (rows["x"][STATUS], rows["y"][STATUS], rows["y"][MESSAGES][-1].text) == ("imported", "ignored", "no tag")


def test_lists_in_frame_steps(spark):
    files = spark.createDataFrame([("f1", 10), ("f2", 20)], "path string, length long")
    df = spark.createDataFrame([("x", "f1", "f2"), ("y", "f2", "none")], "src_key string, a string, b string")
    mapping = {"size": [{"plugin": "get", "source": ["a", "b"]}, {"plugin": "callback", "callable": "filesize"}]}
    rows = {r.src_key: r["size"] for r in compile_mapping(df, mapping, Context(files=files), ["src_key"]).collect()}
    assert rows == {"x": [10, 20], "y": [20, None]}
    # Without the option a list is a composite key.
    id_map = spark.createDataFrame([("m", "f1", "A")], "migration string, src_key string, dest_id string")
    each = {"plugin": "migration_lookup", "migration": "m", "no_stub": True, "each": True}
    mapping = {"hits": [{"plugin": "get", "source": ["a", "b"]}, each]}
    rows = {r.src_key: r.hits for r in compile_mapping(df, mapping, Context(id_map=id_map), ["src_key"]).collect()}
    assert rows == {"x": ["A"], "y": None}


def test_stubs_are_filled_without_change_tracking(spark, store):
    lookup = {"ref": [{"plugin": "get", "source": "Ref"}, {"plugin": "migration_lookup", "migration": "base"}]}
    base = Job("base", {"title": "Title"}, "node", KEYS, track_changes=False)
    user = Job("user", lookup, "media", KEYS)
    import_job(store, Group([base, user], cells(spark, [("1", "7", "t")])), user)
    import_job(store, Group([base, user], cells(spark, [("7", "", "seven")])), base)
    rows = store.read("targets/node", "base").collect()
    assert [(r.title, r.is_stub) for r in rows] == [("seven", False)]
    assert store.read("targets/media", "user").first().ref == rows[0].id


def test_references_to_jobs_outside_the_group_stay_empty(spark, store):
    lookup = {"ref": [{"plugin": "get", "source": "Ref"}, {"plugin": "migration_lookup", "migration": "elsewhere"}]}
    import_group(store, Group([Job("user", lookup, "media", KEYS)], cells(spark, [("1", "7", "t")])))
    assert store.read("targets/media", "user").first().ref is None
    assert store.messages("user").first().text == "No row of elsewhere has the key 7"


def test_rows_that_end_later_are_no_parents(spark, store):
    parent = [{"plugin": "get", "source": "Ref"}, {"plugin": "migration_lookup", "migration": "own", "no_stub": True}]
    mapping = {"parent": parent, "_both": [{"plugin": "get", "source": ["@parent", "Title"]}, {"plugin": "get"}],
               "title": [{"plugin": "get", "source": "Title"}, {"plugin": "skip_on_empty", "method": "row"}],
               "must": [{"plugin": "get", "source": "@parent"}, {"plugin": "default_value", "default_value": "root"}]}
    mapping["parent"] = [*parent, {"plugin": "skip_on_empty", "method": "row"}]
    sheet = cells(spark, [("1", "1", ""), ("2", "1", "b"), ("3", "2", "c"), ("4", "4", "d"), ("5", "4", "e")])
    import_group(store, Group([Job("own", mapping, "node", KEYS)], sheet))
    ids = {r.src_key: r.dest_id for r in store.id_map("own").filter("status = 'imported'").collect()}
    assert set(ids) == {"4", "5"}
    assert {r.parent for r in store.read("targets/node", "own").collect()} == {ids["4"]}


def test_requirements_ask_for_all_rows(spark, store):
    base, user = Job("base", {"title": "Title"}, "node", KEYS), Job("user", {"title": "Title"}, "media", KEYS, requires=["base"], tags=["late"])
    group = Group([base, user], cells(spark, [("1", "", "a"), ("2", "", "b")]))
    import_job(store, group, base, Options(limit=1))
    with pytest.raises(ValueError, match="user requires base"):
        import_group(store, group, tag="late")
    import_job(store, group, base)
    assert import_group(store, group, tag="late") == ["user"]
    rollback_job(store, base)
    with pytest.raises(ValueError, match="user requires base"):
        import_group(store, group, tag="late")
    assert import_group(store, group, Options(force=True), tag="late") == ["user"]


def test_every_row_without_a_key_is_reported(spark, store, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("ID,Title\n,a\n5,b\n,c\n,a\n")
    sheet = read_sheet(spark, str(path), header_row=1, row_index_column="row")
    import_group(store, Group([Job("plain", {"title": "Title"}, "node", KEYS)], sheet, row_column="row"))
    states = {r.src_key: r.status for r in store.id_map("plain").collect()}
    assert states == {"5": "imported", "row 2": "failed", "row 4": "failed", "row 5": "failed"}
    assert sorted(r.text for r in store.messages("plain").collect())[0].startswith("Row 2: ")


def test_a_compaction_cut_short_changes_nothing(spark, store):
    job = Job("plain", {"title": "Title"}, "node", KEYS)
    import_group(store, Group([job], cells(spark, [("1", "", "a"), ("2", "", "b")])))
    before = sorted(store.all_rows("id_map", ID_MAP).collect())
    # The new base is there, the old one not yet deleted; and a version that was never put in its place.
    folder = store.folder("id_map", "plain")
    rows = store.read("id_map", "plain", ID_MAP)
    store._add(folder, rows, "base")
    rows.limit(1).write.parquet(store.staging("base"))
    assert len(store._names(folder)) == 2
    assert sorted(store.all_rows("id_map", ID_MAP).collect()) == before == sorted(store.id_map("plain").withColumn("migration", F.lit("plain")).collect())


def test_a_retry_reads_the_sheet_anew(spark, store):
    job = Job("plain", {"title": "Title", "n": [{"plugin": "get", "source": "Title"}, {"plugin": "default_value", "default_value": ""}]}, "node", KEYS)
    group = Group([job], cells(spark, [("1", "", "a")]))
    with pytest.raises(ValueError):
        import_group(store, group)
    assert not group._staged
    group.jobs, group.sheet = [Job("plain", {"title": "Title"}, "node", KEYS)], cells(spark, [("2", "", "b")])
    import_group(store, group)
    assert [r.title for r in store.read("targets/node", "plain").collect()] == ["b"]


def test_date_letters(spark):
    at = datetime.datetime(2024, 2, 3, 14, 5, 6, 7_000, tzinfo=datetime.timezone(datetime.timedelta(hours=2)))
    cases = {
        "Y-m-d H:i:s": "2024-02-03 14:05:06", "j n y": "3 2 24", "N w z t L o W": "6 6 33 29 1 2024 05", "D l S M F": "Sat Saturday rd Feb February",
        "g G h a A": "2 14 02 pm PM", "u v": "007000 007", "P O p Z": "+02:00 +0200 +02:00 7200", "c": "2024-02-03T14:05:06+02:00",
        "r": "Sat, 03 Feb 2024 14:05:06 +0200", "U": "1706961906", "\\Y\\\\Y \\": "Y\\2024 \\", "": "", "é/Y": "é/2024", "B I": "545 0",
    }
    df = spark.createDataFrame([(k,) for k in cases], "f string")
    assert {r.f: r.d for r in df.select("f", X.run_date(F.col("f"), at).alias("d")).collect()} == cases


def test_headers_of_any_width_and_of_several_files(spark, tmp_path):
    wide, names = tmp_path / "wide.csv", [f"h{i}" for i in range(17_000)]
    wide.write_text('a,"b\nb",\n\n' + ",".join(names) + "\n")
    assert peek_header(spark, str(wide), 2, multiline=True) == names
    assert peek_header(spark, str(wide), 1, multiline=True) == ["a", "b\nb", ""]
    with pytest.raises(ValueError, match="header row"):
        peek_header(spark, str(wide), 3, multiline=True)
    tail = tmp_path / "tail.csv"
    tail.write_text("ID,T,\n1,a,kept\n")
    for multiline in (False, True):
        assert read_sheet(spark, str(tail), header_row=1, multiline=multiline).first()["_c2"] == "kept"
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text("ID,T\n1,x\n")
    (folder / "b.csv").write_text("T,ID,U\ny,2,z\n")
    for row in (1,):
        with pytest.raises(ValueError, match="different headers"):
            read_sheet(spark, str(folder), header_row=row)
    (folder / "b.csv").write_text("ID,T\n2,y\n")
    assert read_sheet(spark, str(folder), header_row=1).count() == 2
    rows = [("f", "s", 1, 0, "ID"), ("f", "s", 2, 0, "1"), ("g", "s", 1, 0, "T"), ("g", "s", 2, 0, "2")]
    book = spark.createDataFrame(rows, "file string, sheet string, row_idx long, col_idx int, value string")
    with pytest.raises(ValueError, match="different headers"):
        select_worksheet(book, "s")


def test_file_names_stay_unique_over_imports(spark, store):
    mapping = {"uri": [{"plugin": "file_copy", "source": ["Ref", "Title"], "move": True}]}
    job = Job("file", mapping, "file", KEYS)

    def run(rows):
        import_group(store, Group([job], cells(spark, rows)))
        return {r.src_key: (r["from"], r.to, r.move) for r in store.copies("file").collect()}

    first = run([("1", "x", "d/a.png"), ("2", "y", "d/a.png"), ("3", "z", "d/a_1.png"), ("4", "w", "d/a.png")])
    assert {k: v[1] for k, v in first.items()} == {"1": "d/a.png", "2": "d/a_2.png", "3": "d/a_1.png", "4": "d/a_3.png"}
    second = run([("1", "x", "d/a.png"), ("2", "new", "d/a.png"), ("3", "z", "d/b.png"), ("5", "v", "d/a.png"), ("6", "u", "d/a_2.png")])
    assert second["1"] == first["1"] and second["2"] == ("new", "d/a_2.png", True) and second["4"] == first["4"]
    assert (second["3"][1], second["5"][1], second["6"][1]) == ("d/b.png", "d/a_4.png", "d/a_2_1.png")
    assert len({v[1] for v in second.values()}) == len(second)
    rows = store.read("targets/file", "file").join(store.id_map("file"), F.col("id") == F.col("dest_id")).collect()
    assert {r.src_key: r.uri for r in rows} == {k: v[1] for k, v in second.items()}
    rollback_job(store, job)
    assert store.copies("file").count() == 0


def plan_size(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_plans_grow_in_proportion(spark):
    df = spark.createDataFrame([("x", "a b|c")], "src_key string, cell string")
    explode = {"plugin": "subdelimited_explode", "delimiter": ";", "subdelimiter": "|", "keys": ["a", "b"]}

    def nested(n):
        steps = [{"plugin": "get", "source": "a"}] + [{"plugin": "default_value", "default_value": str(i + 1)} for i in range(n)]
        mapping = {"_p": [{"plugin": "get", "source": "cell"}, explode], "out": [{"plugin": "get", "source": "@_p"}, {"plugin": "sub_process", "process": {"v": steps}}]}
        return compile_mapping(df, mapping, Context(), ["src_key"])

    def encoded(n):
        return compile_mapping(df, {"v": [{"plugin": "get", "source": "cell"}] + [{"plugin": "urlencode"}] * n}, Context(), ["src_key"])

    for chain in (nested, encoded):
        sizes = [plan_size(chain(n)) for n in (4, 8, 16)]
        assert sizes[2] - sizes[1] < 3 * (sizes[1] - sizes[0])
        chain(16).collect()
    assert nested(16).first().out[0].v == "a b"


def test_small_vocabularies_do_not_shuffle_the_rows(spark):
    terms = spark.createDataFrame([(f"T{i}", i) for i in range(25)], "value string, id int")
    rows = spark.range(1000).select(F.col("id").cast("string").alias("src_key"), F.concat(F.lit("t"), F.col("id") % 26).alias("term"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = entity_lookup(rows, "term", terms, "hit", ignore_case=True, row_key="src_key")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert {r.hit for r in found.collect()} == {*range(25), None}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
