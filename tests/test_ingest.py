import os

import pytest
from pyspark.sql import functions as F

from tabweave.constants import ORPHANS_TAG
from tabweave.functions.text import target_id
from tabweave.operators import state
from tabweave.plans.ingest import Group, Job, Options, forget_group, import_group, import_job, rollback_group, rollback_job
from tabweave.plans.store import ID_MAP, Store
from tabweave.sources.delimited import read_sheet
from tests import sample

KEYS, NUMBERS = {"ID": "integer"}, {"No": "integer"}


def jobs(tags=()):
    return [
        Job("view", sample.VIEW, "view", NUMBERS, ("asset", "object"), tags=tags),
        Job("object", sample.OBJECT, "object", NUMBERS, default_bundle="thing", tags=tags),
        Job("asset", sample.ASSET, "asset", NUMBERS, tags=tags),
    ]


def group(spark, path, entities, tags=()):
    return Group(jobs(tags), read_sheet(spark, path, header_row=1), entities=entities)


def counts(store):
    rows = store.all_rows("id_map", ID_MAP).groupBy("migration", "status").count().collect()
    return {(r.migration, r.status): r["count"] for r in rows}


def test_sample_sheet_end_to_end(spark, tmp_path, sheet_path, entities, run_ts):
    store = Store(spark, str(tmp_path / "state"))
    assert import_group(store, group(spark, sheet_path, entities), Options(run_ts=run_ts)) == ["asset", "object", "view"]
    assert counts(store) == {
        ("object", "imported"): 8, ("object", "ignored"): 1, ("object", "needs_update"): 1,
        ("asset", "imported"): 7, ("asset", "ignored"): 2,
        ("view", "imported"): 5, ("view", "ignored"): 4,
    }

    ids = {r.src_key: r.dest_id for r in store.id_map("object").collect()}
    things = {r.id: r for r in store.read("targets/object", "object").collect()}
    by_key = {k: things[i] for k, i in ids.items() if i}
    assert [p.id for p in by_key["3"].parents] == [ids["1"], ids["2"]] and by_key["1"].parents == []
    # The first of two places is unknown.
    assert [p.id for p in by_key["7"].parents] == [None, ids["1"]]
    assert by_key["3"].twin == ids["2"] and by_key["9"].twin == ids["77"] and by_key["77"].is_stub
    assert by_key["3"].note == 'says "Turicum"' and by_key["2"].note == "(none)" and by_key["1"].label == "Maps, old"
    assert (by_key["1"].kind, by_key["4"].kind, by_key["2"].bundle) == ("t0", "t2", "thing")
    assert "8" not in by_key and store.messages("object").filter("src_key = '8'").first().text == "No mapping for value: Coin"

    assets = {r.src_key: r for r in store.id_map("asset").join(store.read("targets/asset", "asset"), F.col("dest_id") == F.col("id")).collect()}
    assert assets["3"].uri == "shelf://24/5/z%C3%BCrich.tif" and assets["2"].uri == "shelf://24/5/north%20sea.tif"
    assert (assets["4"].uri, assets["5"].uri) == ("shelf://24/5/a.jpg", "shelf://24/5/a_1.jpg")
    assert (assets["7"].media, assets["7"].name) == ("application/pdf", "l 7.pdf")
    said = store.messages("asset")
    assert said.filter("level = 'warning'").count() == 7 and said.filter("level = 'info' AND text LIKE 'Goes to shelf://%'").count() == 7
    assert {r.src_key for r in said.filter("text = 'There is no scan'").collect()} == {"1", "6"}

    views = {r.shown.title: r for r in store.read("targets/view", "view").collect()}
    assert set(views) == {"North Sea", "Zürich", "Harbour", "Harbour again", "Map in the cellar"}
    assert all(v.shown.id in {a.id for a in assets.values()} and v["of"].label == t for t, v in views.items())


def test_second_import_changes_nothing(spark, tmp_path, sheet_path, entities, run_ts):
    store = Store(spark, str(tmp_path / "state"))
    g, options = group(spark, sheet_path, entities), Options(run_ts=run_ts)
    asset = next(j for j in g.jobs if j.name == "asset")
    import_group(store, Group([asset], g.sheet), options)
    first = sorted(store.read("targets/asset", "asset").collect(), key=str)
    maps = sorted(store.id_map("asset").collect(), key=str)
    written = os.listdir(store.folder("targets/asset", "asset"))
    import_group(store, Group([asset], g.sheet), options)
    assert os.listdir(store.folder("targets/asset", "asset")) == written
    assert sorted(store.read("targets/asset", "asset").collect(), key=str) == first
    assert sorted(store.id_map("asset").collect(), key=str) == maps


def test_edited_sheet_and_orphans(spark, tmp_path, sheet_path, entities, run_ts):
    store, options = Store(spark, str(tmp_path / "state")), Options(run_ts=run_ts)
    g = group(spark, sheet_path, entities, (ORPHANS_TAG,))
    thing = next(j for j in g.jobs if j.name == "object")
    import_group(store, Group([thing], g.sheet, entities=entities), options)
    lines = sample.SHEET.splitlines()
    lines[4] = lines[4].replace("Harbour", "Old harbour")
    edited = tmp_path / "edited.csv"
    edited.write_text("\n".join([*lines[:8], "12,1,,Map,,Island,"]) + "\n")
    import_group(store, Group([thing], read_sheet(spark, str(edited), header_row=1), entities=entities), options)
    labels = {r.label for r in store.read("targets/object", "object").collect()}
    assert {"Old harbour", "Island"} <= labels and not {"Harbour", "Map in the cellar"} & labels
    # The stub that a former row asked for is no orphan.
    assert {r.src_key for r in store.id_map("object").collect()} == {*map(str, range(1, 8)), "12", "77"}


def test_rollback_undoes_import(spark, tmp_path, sheet_path, entities, run_ts):
    store, options = Store(spark, str(tmp_path / "state")), Options(run_ts=run_ts)
    g = group(spark, sheet_path, entities)
    import_group(store, g, options)
    assert rollback_group(store, g, "ignored") == ["view", "object", "asset"]
    assert counts(store) == {
        ("object", "imported"): 8, ("object", "needs_update"): 1, ("asset", "imported"): 7, ("view", "imported"): 5
    }
    rollback_group(store, g)
    assert counts(store) == {}
    for job in g.jobs:
        assert store.read(f"targets/{job.target}", job.name).count() == 0
        assert store.messages(job.name).count() == 0
    forget_group(store, g)
    assert not any(store.has(t, j.name) for t in ("id_map", "messages") for j in g.jobs)
    assert store.has("targets/view", "view")


def test_preserved_targets_stay(spark, tmp_path, sheet_path, entities, run_ts):
    store = Store(spark, str(tmp_path / "state"))
    g = group(spark, sheet_path, entities)
    job = Job("asset", sample.ASSET, "asset", NUMBERS, rollback_action="preserve")
    import_job(store, g, job, Options(run_ts=run_ts))
    rollback_job(store, job)
    assert store.id_map("asset").count() == 0 and store.read("targets/asset", "asset").count() == 7


def test_bad_keys_fail_alone(spark, tmp_path, entities, run_ts):
    path = tmp_path / "bad.csv"
    path.write_text("ID,Title\n1,a\nx,b\n3,c\n")
    store = Store(spark, str(tmp_path / "state"))
    job = Job("plain", {"title": "Title"}, "node", KEYS)
    import_job(store, Group([job], read_sheet(spark, str(path), header_row=1)), job)
    assert {r.src_key: r.status for r in store.id_map("plain").collect()} == {
        "1": "imported", "x": "failed", "3": "imported"
    }
    assert store.messages("plain").first().level == "error"


def test_stubs_are_filled_later(spark, tmp_path):
    store = Store(spark, str(tmp_path / "state"))
    lookup = {"ref": [{"plugin": "get", "source": "Ref"}, {"plugin": "migration_lookup", "migration": "base"}]}
    base = Job("base", {"title": "Title"}, "node", KEYS)
    user = Job("user", lookup, "media", KEYS)
    cells = spark.createDataFrame([("1", "7", "t1"), ("2", "8", "t2"), ("3", "7", "t3"), ("4", "", "t4")], "ID string, Ref string, Title string")
    import_job(store, Group([base, user], cells), user)
    known = {r.src_key: r for r in store.id_map("base").collect()}
    assert set(known) == {"7", "8"} and {r.status for r in known.values()} == {"needs_update"}
    assert store.read("targets/node", "base").filter("is_stub").count() == 2
    refs = {r.ref for r in store.read("targets/media", "user").collect()}
    assert refs == {known["7"].dest_id, known["8"].dest_id, None}
    more = spark.createDataFrame([("7", "", "seven")], "ID string, Ref string, Title string")
    import_job(store, Group([base, user], more), base)
    after = {r.id: r for r in store.read("targets/node", "base").collect()}
    assert after[known["7"].dest_id].title == "seven" and not after[known["7"].dest_id].is_stub
    assert after[known["8"].dest_id].is_stub


def test_requirements_and_limit(spark, tmp_path, sheet_path, entities, run_ts):
    store = Store(spark, str(tmp_path / "state"))
    g = group(spark, sheet_path, entities)
    g.jobs = [j for j in g.jobs if j.name == "view"]
    with pytest.raises(ValueError, match="requires asset, object"):
        import_group(store, g, Options(run_ts=run_ts))
    plain = Job("object", {"label": "Label"}, "object", NUMBERS)
    import_job(store, g, plain, Options(limit=3))
    assert {r.src_key for r in store.id_map("object").collect()} == {"1", "2", "3"}
    import_job(store, g, plain, Options(limit=3))
    assert store.id_map("object").count() == 6


def test_ids_do_not_depend_on_partitions(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    made = df.select(target_id(F.lit("m"), F.col("k")).alias("t"))
    again = df.repartition(13).select(target_id(F.lit("m"), F.col("k")).alias("t"))
    assert made.exceptAll(again).count() == 0 and made.distinct().count() == 100


def test_status_rollback_takes_shared_targets(spark):
    rows = [("m", "1", "A", "failed", None), ("m", "2", "A", "imported", None), ("m", "3", None, "ignored", None), ("m", "4", "B", "imported", None)]
    id_map = spark.createDataFrame(rows, "migration string, src_key string, dest_id string, status string, rollback_action string")
    target = spark.createDataFrame([("A",), ("B",)], "id string")
    left, kept = state.rollback(id_map, target, "failed,ignored")
    assert [r.id for r in left.collect()] == ["B"] and [r.src_key for r in kept.collect()] == ["4"]


def test_store_refuses_odd_names(spark, tmp_path):
    with pytest.raises(ValueError):
        Store(spark, str(tmp_path)).folder("id_map", "a/b")
    assert not os.listdir(tmp_path)


def test_later_rows_of_a_key_win(spark, tmp_path):
    path = tmp_path / "twice.csv"
    path.write_text("ID,Title\n1,a\n2,b\n1,c\n3,d\n1,b2\n")
    store = Store(spark, str(tmp_path / "state"))
    job = Job("plain", {"title": "Title"}, "node", KEYS)
    sheet = read_sheet(spark, str(path), header_row=1, row_index_column="row")
    import_job(store, Group([job], sheet, row_column="row"), job)
    assert sorted(r.title for r in store.read("targets/node", "plain").collect()) == ["b", "b2", "d"]
    assert store.id_map("plain").count() == 3
    loose = Job("loose", {"title": "Title"}, "node", KEYS)
    import_job(store, Group([loose], sheet.drop("row")), loose)
    assert store.id_map("loose").count() == 3 and store.read("targets/node", "loose").count() == 3


def test_stubs_in_the_own_sheet(spark, tmp_path):
    store = Store(spark, str(tmp_path / "state"))
    mapping = {"title": "Title", "parent": [{"plugin": "get", "source": "Ref"}, {"plugin": "migration_lookup", "migration": "own"}]}
    job = Job("own", mapping, "node", KEYS)
    cells = spark.createDataFrame([("1", "2", "a"), ("2", "9", "b"), ("3", "", "c")], "ID string, Ref string, Title string")
    import_job(store, Group([job], cells), job)
    known = {r.src_key: r for r in store.id_map("own").collect()}
    assert {k: r.status for k, r in known.items()} == {"1": "imported", "2": "imported", "3": "imported", "9": "needs_update"}
    rows = {r.id: r for r in store.read("targets/node", "own").collect()}
    assert len(rows) == 4 and rows[known["9"].dest_id].is_stub
    assert rows[known["1"].dest_id].parent == known["2"].dest_id and rows[known["2"].dest_id].parent == known["9"].dest_id
    assert rows[known["3"].dest_id].parent is None
