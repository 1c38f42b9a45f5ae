"""Change detection by ranges: the same classes as without, less read."""

import random

import pytest
from pyspark.sql import functions as F

from tabweave.constants import ORPHANS_TAG
from tabweave.operators import hashtree, state
from tabweave.plans.ingest import Group, Job, import_group
from tabweave.plans.store import ID_MAP, Store

KNOWN = "src_key string, row_hash string, status string"


def key(i):
    return f"k{i:05d}"


def frames(spark, rng, n=3000, odd=True):
    known = {key(i): f"h{i}" for i in range(n)}
    sheet = dict(known)
    for i in rng.sample(range(n), 20):
        sheet[key(i)] = "changed"
    for i in rng.sample(range(n), 15):
        sheet.pop(key(i), None)
    for i in range(12):
        sheet[rng.choice(["a", "k01500", "zz"]) + str(i)] = "new"
    stale = set(rng.sample(sorted(known), 5)) if odd else set()
    rows = [(k, None if k == key(7) else h, "needs_update" if k in stale else "imported") for k, h in known.items()]
    sheet = [(k, None if k == key(7) else h) for k, h in sheet.items()]
    return spark.createDataFrame(sheet, "src_key string, row_hash string"), spark.createDataFrame(rows, KNOWN)


@pytest.mark.parametrize("ranges, filters", [(1, 48), (7, 48), (200, 48), (200, 3), (1024, 5)])
def test_same_classes(spark, monkeypatch, ranges, filters):
    monkeypatch.setattr(hashtree, "MOST_FILTERS", filters)
    source, known = frames(spark, random.Random(ranges))
    lows = [key(3000 * i // ranges) for i in range(ranges)]
    tree = hashtree.build_tree(known, lows)
    want = sorted(map(tuple, state.classify_rows(source, known).collect()))
    assert sorted(map(tuple, hashtree.classify_by_ranges(source, known, tree).collect())) == want
    assert {c for _, c in want} == {"new", "changed", "unchanged", "gone"}


def test_ranges_of_keys(spark):
    lows = [key(10 * i) for i in range(100)]
    keys = ["", "a", key(0), key(9), key(10), key(335), key(990), key(999), "z"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").withColumn("r", hashtree.range_of(F.col("k"), lows)).collect()
    assert {r.k: r.r for r in rows} == {"": 0, "a": 0, key(0): 0, key(9): 0, key(10): 1, key(335): 33, key(990): 99, key(999): 99, "z": 99}
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    for leaves in ([], [0], [99], [0, 1, 33], list(range(100))):
        got = {r.k for r in frame.filter(hashtree.in_ranges(F.col("k"), lows, leaves)).collect()}
        assert got == {r.k for r in rows if r.r in leaves}
    assert hashtree.ranges_for(0) == 1 and hashtree.ranges_for(10**12) == hashtree.FAN**2


def scanned(spark, df):
    """Rows that the scan of ``df`` gave up to now; counted without adaptive execution."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rows_read_fall_with_the_share_that_changed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hashtree, "LEAF_ROWS", 100)
    store = Store(spark, str(tmp_path / "state"))
    rows = spark.range(10_000).select(
        F.format_string("k%05d", "id").alias("src_key"), F.lit("d").alias("dest_id"), F.lit("imported").alias("status"),
        F.lit(None).cast("string").alias("rollback_action"), F.sha2(F.col("id").cast("string"), 256).alias("row_hash"),
    )
    store.replace("id_map", "m", rows)
    store.keep_tree("m")
    tree = store.tree("m")
    assert len(tree.lows) == 100
    read = []
    for changed in ("false", "id < 100", "id < 1000", "id % 1000 = 5"):
        source = rows.withColumn("id", F.expr("cast(substring(src_key, 2) as int)")).withColumn("row_hash", F.expr(f"CASE WHEN {changed} THEN 'x' ELSE row_hash END"))
        leaves = hashtree.differing_ranges(source, tree)
        _, known = hashtree.parted(source, store.id_map("m"), tree, leaves)
        read.append((len(leaves), scanned(spark, known)))
    assert [n for n, _ in read] == [0, 2, 11, 10] or [n for n, _ in read] == [0, 1, 10, 10] or read[1][0] <= 3
    assert read[0][1] == 0 and read[1][1] <= 400 and read[2][1] <= 1_500 and read[3][1] <= 2_000


def test_the_tree_follows_the_id_map(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hashtree, "LEAF_ROWS", 50)
    store = Store(spark, str(tmp_path / "state"))
    job = Job("base", {"title": "Title", "ref": [{"plugin": "get", "source": "Ref"}, {"plugin": "migration_lookup", "migration": "base"}]}, "node", {"ID": "string"}, tags=[ORPHANS_TAG])

    def sheet(rows):
        return Group([job], spark.createDataFrame([(k, t, r) for k, (t, r) in rows.items()], "ID string, Title string, Ref string"))

    def check(rows, stubs=()):
        tree = store.tree("base")
        fresh = hashtree.build_tree(store.id_map("base"), tree.lows)
        assert tree == fresh
        found = {r.src_key: r.status for r in store.id_map("base").collect()}
        assert found == {k: "imported" for k in rows} | dict.fromkeys(stubs, "needs_update")
        titles = store.id_map("base").join(store.read("targets/node", "base"), F.col("dest_id") == F.col("id"))
        assert {r.src_key: r.title for r in titles.filter("NOT is_stub").collect()} == {k: t for k, (t, _) in rows.items()}

    rows = {key(i): (f"t{i}", "") for i in range(600)}
    import_group(store, sheet(rows))
    assert len(store.tree("base").lows) == 12
    check(rows)
    # A few rows change, come and go; one refers to a row that is not there.
    rows[key(3)], rows["a"], rows["zz"] = ("new", ""), ("first", ""), ("last", "k00900")
    del rows[key(599)], rows[key(300)]
    import_group(store, sheet(rows))
    check(rows, ["k00900"])
    rows["k00900"] = ("found", "")
    import_group(store, sheet(rows))
    check(rows)
    import_group(store, sheet(rows))
    check(rows)
    # The tree is no longer believed once someone else wrote the map.
    store.change("id_map", "base", gone=spark.createDataFrame([(key(5),)], "src_key string"))
    assert store.tree("base") is None
    import_group(store, sheet(rows))
    check(rows)
    assert store.id_map("base").columns == ID_MAP.names
