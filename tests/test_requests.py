import os

import pytest

from tabweave.plans.ingest import Job, Options, import_group
from tabweave.plans.requests import Request, Template, comma_list, derive_jobs, renamed_mapping, request_group, template_of
from tabweave.plans.store import ID_MAP, Store
from tests import sample

KEYS, NUMBERS = {"ID": "integer"}, {"No": "integer"}


def template():
    jobs = [
        Job("view", sample.VIEW, "view", NUMBERS, ("asset", "object", "elsewhere"), "sheet", tags=["extra"]),
        Job("object", sample.OBJECT, "object", NUMBERS, default_bundle="thing"),
        Job("asset", sample.ASSET, "asset", NUMBERS),
    ]
    return Template("isi", jobs, source={"keys": NUMBERS})


def test_names_tags_and_requirements():
    jobs = {j.name: j for j in derive_jobs(Request("r1", "s.csv"), template())}
    assert set(jobs) == {"isi__r1_view", "isi__r1_object", "isi__r1_asset"}
    view = jobs["isi__r1_view"]
    assert view.requires == ["isi__r1_asset", "isi__r1_object"]
    assert view.tags == ["extra", "isi_template", "isimd", "isi_derived_migration", "isimd:r1"]
    assert view.mapping["shown/id"][1]["migration"] == "isi__r1_asset"
    assert jobs["isi__r1_object"].mapping["twin"][1]["migration"] == "isi__r1_object"
    assert sample.OBJECT["twin"][1]["migration"] == "object"
    assert derive_jobs(Request("r1", "s.csv", active=False), template()) == []
    changed = {j.name: j for j in derive_jobs(Request("r1", "s.csv", mappings={"object": {"title": "No"}}), template())}
    assert {n: j.mapping for n, j in changed.items()} == {"isi__r1_object": {"title": "No"}}
    kept = Template("isi", [Job("own", {"t": "T"}, "x", {"T": "string"}, keep_source=True), Job("other", {"t": "T"}, "x", {"T": "string"})])
    assert [j.keys for j in derive_jobs(Request("r1", "s.csv"), kept)] == [{"T": "string"}, {"ID": "integer"}]
    with pytest.raises(ValueError, match="gone"):
        derive_jobs(Request("r1", "s.csv", mappings={"gone": {}}), template())


def test_renamed_lookups():
    names = {"a": "x_a", "b": "x_b"}
    mapping = {
        "one": [{"plugin": "migration_lookup", "migration": ["a", "z"], "source_ids": {"a": ["p"], "z": ["q"]}, "stub_id": "b"}],
        "two": {"plugin": "sub_process", "values": {"v": [{"plugin": "migration_lookup", "migration": "b"}], "w": "p"}},
        "three": "p",
    }
    got = renamed_mapping(mapping, names)
    assert got["one"][0] == {"plugin": "migration_lookup", "migration": ["x_a", "z"], "source_ids": {"x_a": ["p"], "z": ["q"]}, "stub_id": "x_b"}
    assert got["two"]["values"] == {"v": [{"plugin": "migration_lookup", "migration": "x_b"}], "w": "p"}
    assert got["three"] == "p"


def test_original_mapping():
    known = {"isi": template()}
    assert template_of(Request("r", "s.csv"), known).name == "isi"
    with pytest.raises(ValueError, match="Unknown type"):
        template_of(Request("r", "s.csv", original_mapping="odd:isi"), known)
    with pytest.raises(ValueError, match="No template"):
        template_of(Request("r", "s.csv", original_mapping="migration_group:nope"), known)
    assert comma_list("/a,,/b") == ["/a", "/b"] and comma_list(None) == []


def test_request_runs(spark, tmp_path, sheet_path, entities, run_ts):
    store = Store(spark, str(tmp_path / "state"))
    request = Request("r1", sheet_path)
    group = request_group(spark, request, {"isi": template()}, entities)
    order = import_group(store, group, Options(run_ts=run_ts, allowed_schemes=["vault"]), tag=request.tag)
    assert order == ["isi__r1_asset", "isi__r1_object", "isi__r1_view"]
    counts = {(r.migration, r.status): r["count"] for r in store.all_rows("id_map", ID_MAP).groupBy("migration", "status").count().collect()}
    assert counts == {
        ("isi__r1_asset", "imported"): 6, ("isi__r1_asset", "ignored"): 3, ("isi__r1_object", "imported"): 8,
        ("isi__r1_object", "ignored"): 1, ("isi__r1_object", "needs_update"): 1,
        ("isi__r1_view", "imported"): 5, ("isi__r1_view", "ignored"): 4,
    }
    assert store.messages("isi__r1_asset").filter("level = 'warning'").isEmpty()


def test_workbook_request(spark, tmp_path):
    rows = [("b.xlsx", "s", 1, 0, "ID"), ("b.xlsx", "s", 1, 1, "Title"), ("b.xlsx", "s", 2, 0, "4"), ("b.xlsx", "s", 2, 1, "four"), ("b.xlsx", "t", 1, 0, "ID"), ("c.xlsx", "s", 2, 0, "5")]
    cells = spark.createDataFrame(rows, "file string, sheet string, row_idx long, col_idx int, value string")
    plain = Template("isi", [Job("node", {"title": "Title"}, "node", KEYS)])
    store = Store(spark, str(tmp_path / "state"))
    with pytest.raises(ValueError, match="cells of workbook"):
        request_group(spark, Request("r", "b.xlsx", sheet="s"), {"isi": plain})
    import_group(store, request_group(spark, Request("r", "b.xlsx", sheet="s"), {"isi": plain}, cells=cells))
    assert [(r.title) for r in store.read("targets/node", "isi__r_node").collect()] == ["four"]


def test_a_replaced_table_is_there_whole_or_not_at_all(spark, tmp_path):
    store = Store(spark, str(tmp_path / "state"))
    rows = spark.createDataFrame([("1", "d", "imported", None, "h")], ID_MAP)
    store.replace("id_map", "m", rows)
    final = store.folder("id_map", "m")
    # A folder that no rename completed is no version.
    os.makedirs(f"{final}/_temporary")
    assert store.id_map("m").count() == 1
    store.replace("id_map", "m", rows.limit(0))
    assert store.id_map("m").count() == 0 and len(store._live(final)) == 1
    assert [n for n in os.listdir(final) if n.startswith("version=")] == store._live(final)
