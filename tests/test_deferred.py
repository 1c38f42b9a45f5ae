import datetime

import pytest
from pyspark.errors import StreamingQueryException

from tabweave.plans.ingest import Group, Job, import_group
from tabweave.plans.store import ID_MAP, Store
from tabweave.streaming.deferred import Claims, enqueue, import_requests, queue_stream, run_deferred


def test_queue_is_worked_off_once(spark, tmp_path):
    queue, checkpoint = str(tmp_path / "queue"), str(tmp_path / "checkpoint")
    requests = spark.createDataFrame([("r1", "u1"), ("r2", "u2")], "id string, owner string")
    ran = []
    for request in ("r1", "unknown", "r1", "r2"):
        enqueue(spark, queue, request)

    def work():
        items = queue_stream(spark, queue)
        run = import_requests(lambda request, owner, grp: ran.append((request, owner, grp)))
        run_deferred(items, lambda: requests, run, checkpoint).awaitTermination()

    work()
    assert ran == [("r1", "u1", "isi__r1"), ("r2", "u2", "isi__r2")]
    work()
    assert len(ran) == 2
    enqueue(spark, queue, "r2")
    work()
    assert ran[2:] == [("r2", "u2", "isi__r2")]


def test_deferred_import(spark, tmp_path):
    store = Store(spark, str(tmp_path / "state"))
    queue = str(tmp_path / "queue")
    requests = spark.createDataFrame([("r1", "u1")], "id string, owner string")
    sheet = spark.createDataFrame([("1", "a"), ("2", "b")], "ID string, T string")

    def run_group(request, owner, grp):
        job = Job(f"{grp}_node", {"title": "T"}, "node", {"ID": "integer"}, tags=[f"isimd:{request}"])
        import_group(store, Group([job], sheet), tag=f"isimd:{request}")

    enqueue(spark, queue, "r1")
    run_deferred(queue_stream(spark, queue), lambda: requests, import_requests(run_group), str(tmp_path / "cp")).awaitTermination()
    assert {(r.migration, r.src_key) for r in store.all_rows("id_map", ID_MAP).collect()} == {("isi__r1_node", "1"), ("isi__r1_node", "2")}


def test_items_are_claimed_once(spark, tmp_path):
    queue, claims = str(tmp_path / "queue"), Claims(str(tmp_path / "claims"))
    requests = spark.createDataFrame([("r1", "u1"), ("r2", "u2"), ("r3", "u3")], "id string, owner string")
    ran, failing = [], []

    def run(items, number):
        ran.extend((r.request, r.item) for r in items.collect())
        if failing:
            raise RuntimeError("cut short")

    def work(checkpoint="cp"):
        run_deferred(queue_stream(spark, queue), lambda: requests, run, str(tmp_path / checkpoint), claims).awaitTermination()

    # Twice in one batch, an unknown request, and one request by two items.
    for request, item in (("r1", "a"), ("r1", "a"), ("unknown", "x"), ("r2", "b"), ("r2", "c")):
        enqueue(spark, queue, request, item)
    work()
    assert sorted(ran) == [("r1", "a"), ("r2", "b"), ("r2", "c")]
    # Again in a later batch, late as it may be, besides a new one.
    for request, item in (("r1", "a"), ("r3", "d")):
        enqueue(spark, queue, request, item)
    work()
    assert sorted(ran)[3:] == [("r3", "d")] and claims.unfinished(spark).count() == 0
    # A batch that fails is given again after the restart; its item was taken up and is not taken up again.
    failing.append(True)
    enqueue(spark, queue, "r1", "e")
    with pytest.raises(StreamingQueryException):
        work()
    failing.clear()
    enqueue(spark, queue, "r2", "f")
    work()
    assert ran.count(("r1", "e")) == 1 and ran.count(("r2", "f")) == 1
    assert [r.item for r in claims.unfinished(spark).collect()] == ["e"]
    # So it is if all is given again, by a checkpoint that knows nothing.
    before = len(ran)
    work("other")
    assert len(ran) == before


def test_claims_are_given_up(spark, tmp_path):
    claims, at = Claims(str(tmp_path / "claims"), keep=datetime.timedelta(days=2)), datetime.datetime(2024, 5, 1, tzinfo=datetime.timezone.utc)
    items = spark.createDataFrame([("r", "a"), ("r", None), ("r", None)], "request string, item string")
    assert claims.take(items, at)[0].count() == 3
    assert claims.take(items, at + datetime.timedelta(days=1))[0].count() == 2
    assert sorted(r.item or "" for r in claims.take(items, at + datetime.timedelta(days=4))[0].collect()) == ["", "", "a"]
