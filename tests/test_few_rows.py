"""Lookups of an import with few rows: the same hits, and no shuffle of the tables they look into."""

import re

import pytest
from pyspark.sql import functions as F

from tabweave.operators import lookups as L
from tabweave.plans import ingest
from tabweave.plans.ingest import Group, Job, Options, import_group
from tabweave.plans.store import Store
from tabweave.sources.delimited import read_sheet
from tests import sample
from tests.test_ingest import jobs


def above(df):
    """The operators above the scan that reads target ids, up to and with the first join."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "Scan parquet" in line and "dest_id" in line)
    depth, found = len(re.match(r"[\s:+\-|]*", lines[at])[0]), []
    for line in reversed(lines[:at]):
        here = len(re.match(r"[\s:+\-|]*", line)[0])
        if here < depth:
            depth = here
            found.append(line.strip(" :+-|"))
            if "Join" in line:
                break
    return found


def test_maps_are_cut_down_before_they_are_shuffled(spark, tmp_path):
    path = str(tmp_path / "large_map")
    spark.range(200_000).select(
        F.lit("m").alias("migration"), F.col("id").cast("string").alias("src_key"), F.concat(F.lit("d"), F.col("id")).alias("dest_id")
    ).write.parquet(path)
    known = spark.read.parquet(path)
    rows = spark.createDataFrame([("1", "5"), ("2", None), ("3", "x"), ("4", "199999"), ("5", "5")], "src_key string, ref string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {few: L.migration_lookup(rows, "ref", known, ["m", "m"], "hit", row_key="src_key", few=few) for few in (False, True)}
        operators = above(found[True])
        assert "BroadcastHashJoin" in operators[-1] and "LeftSemi" in operators[-1] and not any("Exchange" in o for o in operators)
        assert any("Exchange" in o for o in above(found[False]))
        want = [("1", "d5"), ("2", None), ("3", None), ("4", "d199999"), ("5", "d5")]
        assert all(sorted((r.src_key, r.hit) for r in f.collect()) == want for f in found.values())
        loaded = L.load_entity(rows, "ref", known.withColumnRenamed("src_key", "id"), "row", few=True)
        operators = above(loaded)
        assert "LeftSemi" in operators[-1] and not any("Exchange" in o for o in operators)
        assert sorted((r.src_key, r.row and r.row.dest_id) for r in loaded.collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("large", [0, 1 << 40])
def test_an_incremental_import_is_the_same(spark, tmp_path, monkeypatch, entities, run_ts, large):
    monkeypatch.setattr(ingest, "LARGE_MAPS", large)
    store = Store(spark, str(tmp_path / "state"))
    path = tmp_path / "sheet.csv"
    lines = sample.SHEET.splitlines()
    for text in ("\n".join(lines[:5]) + "\n", sample.SHEET):
        path.write_text(text)
        import_group(store, Group(jobs(), read_sheet(spark, str(path), header_row=1), entities=entities), Options(run_ts=run_ts))
    whole = Store(spark, str(tmp_path / "whole"))
    import_group(whole, Group(jobs(), read_sheet(spark, str(path), header_row=1), entities=entities), Options(run_ts=run_ts))

    def rows(of, job):
        return sorted(map(str, (r.asDict(True) for r in of.read(f"targets/{job.target}", job.name).drop("is_stub").collect())))

    for job in jobs():
        both = [{(r.src_key, r.dest_id, r.status) for r in of.id_map(job.name).collect()} for of in (store, whole)]
        assert both[0] == both[1]
    assert isinstance(jobs()[0], Job) and rows(store, jobs()[2]) == rows(whole, jobs()[2])
