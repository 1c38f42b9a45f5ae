"""Tables in versions: what a change writes, what a read merges, and compaction."""

import os

import pytest
from pyspark.sql import functions as F

from tabweave.plans import store as store_module
from tabweave.plans.ingest import Group, Job, Options, import_group, rollback_group
from tabweave.plans.store import ID_MAP, MESSAGES, Store

KEYS = {"ID": "integer"}
JOB = Job("base", {"title": "Title", "kind": [{"plugin": "static_map", "source": "Kind", "map": {"a": "A", "b": "B"}}]}, "node", KEYS)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "state"))


def size(path):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def sheet(spark, n, changed="false", kind="'a'"):
    """Rows of which some have another title; conditions are SQL over ``id``."""
    title = f"CASE WHEN {changed} THEN 'new' ELSE sha2(concat('t', id), 256) END AS Title"
    return spark.range(n).selectExpr("CAST(id AS STRING) AS ID", title, f"{kind} AS Kind")


def test_an_import_writes_what_it_changes(spark, store):
    import_group(store, Group([JOB], sheet(spark, 20_000)))
    bases = {t: store._live(store.folder(t, "base")) for t in ("id_map", "targets/node")}
    whole = {t: size(store.folder(t, "base")) for t in bases}
    import_group(store, Group([JOB], sheet(spark, 20_000, "id % 100 = 7")))
    for t, base in bases.items():
        live = store._live(store.folder(t, "base"))
        assert live[:1] == base and len(live) == 2
        # A hundredth of the rows, besides the footers of the files.
        assert size(f"{store.folder(t, 'base')}/{live[1]}") < 0.04 * whole[t]
    rows = store.read("targets/node", "base")
    assert rows.filter("title = 'new'").count() == 200 and rows.count() == 20_000 and rows.select("id").distinct().count() == 20_000
    assert store.id_map("base").count() == 20_000
    # The base is not shuffled to read the table.
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_rollback_marks_rows_as_gone(spark, store):
    ignored = "CASE WHEN id % 100 = 3 THEN 'x' ELSE 'a' END"
    import_group(store, Group([JOB], sheet(spark, 10_000, kind=ignored)))
    group = Group([JOB], sheet(spark, 10_000, kind=ignored))
    whole = size(store.folder("id_map", "base"))
    rollback_group(store, group, "ignored")
    folder = store.folder("id_map", "base")
    live = store._live(folder)
    assert len(live) == 2 and size(f"{folder}/{live[1]}") < 0.04 * whole
    change = spark.read.parquet(f"{folder}/{live[1]}")
    assert change.count() == 100 and change.filter("NOT _gone").count() == 0
    assert store.id_map("base").count() == 9_900 and store.messages("base").count() == 0
    rollback_group(store, group)
    assert store.id_map("base").count() == 0 and store.read("targets/node", "base").count() == 0
    import_group(store, group)
    assert store.id_map("base").count() == 10_000 and store.read("targets/node", "base").count() == 9_900


def entry(key, status="imported"):
    return (key, f"d{key}", status, None, "h")


def test_of_a_key_the_latest_rows_count(spark, store):
    def frame(*keys, status="imported"):
        return spark.createDataFrame([entry(k, status) for k in keys], ID_MAP)

    def gone(*keys):
        return spark.createDataFrame([(k,) for k in keys], "src_key string")

    many = [str(i) for i in range(3000)]
    store.replace("id_map", "m", frame(*many))
    store.replace("id_map", "other", frame("1"))
    state = {k: "imported" for k in many}
    for i in range(2 * store_module.MOST_CHANGES + 3):
        keys, left = [str(i), str(i + 1), f"n{i}"], [str(i + 40), f"n{i - 1}"]
        store.change("id_map", "m", frame(*keys, status=f"s{i}"), gone(*left, keys[0]))
        state |= dict.fromkeys(keys, f"s{i}")
        for k in left:
            state.pop(k, None)
        assert len(store._live(store.folder("id_map", "m"))) <= store_module.MOST_CHANGES + 1
        if i % 6 == 0:
            assert {r.src_key: r.status for r in store.id_map("m").collect()} == state
    both = store.all_rows("id_map", ID_MAP)
    assert {r.src_key: r.status for r in both.filter("migration = 'm'").collect()} == state
    assert both.filter("migration = 'other'").count() == 1 and both.columns == [*ID_MAP.names, "migration"]
    assert store.id_map("m").count() == len(state)
    store.compact("id_map", "m")
    assert len(store._live(store.folder("id_map", "m"))) == 1
    assert {r.src_key: r.status for r in store.id_map("m").collect()} == state


def test_a_share_of_changes_becomes_a_base(spark, store):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("src_key"), F.lit("info").alias("level"), F.uuid().alias("text"))
    rows = rows.unionByName(rows)
    store.replace("messages", "m", rows)
    store.change("messages", "m", rows.filter("src_key < '5'"), rows.filter("src_key >= '8'").select("src_key"))
    assert len(store._live(store.folder("messages", "m"))) == 1
    got = store.read("messages", "m", MESSAGES)
    assert got.filter("src_key >= '8'").count() == 0 and got.groupBy("src_key").count().filter("count <> 2").count() == 0


def test_targets_may_get_other_columns(spark, store):
    import_group(store, Group([JOB], sheet(spark, 5_000)))
    other = Job("base", {"name": "Title"}, "node", KEYS)
    import_group(store, Group([other], sheet(spark, 5_000, "id = 17")), Options())
    rows = store.read("targets/node", "base")
    assert rows.count() == 5_000 and rows.filter("title IS NULL AND name = 'new'").count() == 1 and rows.filter("name IS NULL").count() == 4_999


def test_changes_of_a_table_that_is_not_there(spark, store):
    store.change("id_map", "m", gone=spark.createDataFrame([("1",)], "src_key string"))
    assert not store.has("id_map", "m")
    store.change("id_map", "m", spark.createDataFrame([entry("1")], ID_MAP))
    assert store.id_map("m").count() == 1
    store.change("id_map", "m")
    assert len(store._live(store.folder("id_map", "m"))) == 1
