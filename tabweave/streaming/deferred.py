"""Deferred ingest: work items arrive as a stream, each names a request to run."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabweave.plans.catalog import group_name


def enqueue(spark: SparkSession, queue: str, request: str, item: str | None = None) -> None:
    """Add a work item to the queue folder. An item that is added again under its name is the same one."""
    row = [(request, item or uuid.uuid4().hex)]
    spark.createDataFrame(row, "request string, item string").coalesce(1).write.mode("append").json(queue)


def queue_stream(spark: SparkSession, queue: str) -> DataFrame:
    return spark.readStream.schema("request string, item string").json(queue)


@dataclass(frozen=True)
class Claims:
    """Which items were taken up, kept in a folder that all executors reach, so that each is taken up once.

    A batch's items are written before the batch runs, by one rename; a batch that ran to its end is marked. So an
    item that is queued twice, in one batch or in two, however late, and one of a batch that is given again after a
    failure, is not taken up a second time. What a failure left undone is told by :meth:`unfinished`. Items without
    a name are each their own. Claims older than ``keep`` are given up.
    """

    path: str
    item: str = "item"
    keep: datetime.timedelta = datetime.timedelta(days=30)

    def _fs(self, spark: SparkSession, path: str):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at

    def _batches(self, spark: SparkSession) -> list[str]:
        fs, at = self._fs(spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(n for n in names if n.startswith("batch="))

    def _read(self, spark: SparkSession, names: list[str]) -> DataFrame:
        schema = f"`{self.item}` string"
        paths = [f"{self.path}/{n}" for n in names]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def take(self, taken: DataFrame, now: datetime.datetime | None = None) -> tuple[DataFrame, str]:
        """The rows of items that nobody took up before, one of each, and the name of their claim."""
        spark, now = taken.sparkSession, now or datetime.datetime.now(datetime.timezone.utc)
        oldest = f"batch={int((now - self.keep).timestamp()):012}"
        for name in self._batches(spark):
            if name < oldest:
                fs, at = self._fs(spark, f"{self.path}/{name}")
                fs.delete(at, True)
        known = self._read(spark, self._batches(spark))
        named = taken.filter(F.col(self.item).isNotNull()).dropDuplicates([self.item])
        fresh = named.join(known, self.item, "left_anti").unionByName(taken.filter(F.col(self.item).isNull()))
        name = f"batch={int(now.timestamp()):012}-{uuid.uuid4().hex}"
        # The claim holds whole rows, so that the same rows run that were claimed.
        staged = f"{self.path}/_staging/{name}"
        fresh.write.parquet(staged)
        fs, at = self._fs(spark, f"{self.path}/{name}")
        if not fs.rename(self._fs(spark, staged)[1], at):
            raise OSError(f"Could not put {staged} in place")
        return spark.read.schema(fresh.schema).parquet(f"{self.path}/{name}"), name

    def finish(self, spark: SparkSession, name: str) -> None:
        fs, at = self._fs(spark, f"{self.path}/_done/{name}")
        fs.mkdirs(at)

    def _is_done(self, spark: SparkSession, name: str) -> bool:
        fs, at = self._fs(spark, f"{self.path}/_done/{name}")
        return fs.exists(at)

    def unfinished(self, spark: SparkSession) -> DataFrame:
        """The items of batches that did not run to their end."""
        left = [n for n in self._batches(spark) if not self._is_done(spark, n)]
        return self._read(spark, left).distinct()


def claimed(items: DataFrame, requests: DataFrame) -> DataFrame:
    """Work items with their request; items of unknown requests are dropped.

    Each comes with the owner it runs as and the group it runs.
    """
    known = requests.select(F.col("id").alias("request"), "owner").distinct()
    return items.join(known, "request").withColumn("grp", group_name(F.col("request")))


def run_deferred(
    items: DataFrame,
    requests: Callable[[], DataFrame],
    run: Callable[[DataFrame, int], None],
    checkpoint: str,
    claims: Claims | None = None,
) -> StreamingQuery:
    """Work off all items that are there, then stop.

    ``requests`` is asked once per batch, so a request made after the start is known. The checkpoint
    keeps what was taken; a batch cut short by a failure is given to ``run`` again under its number,
    so ``run`` must be repeatable, as imports and overwrites of a batch's own folder are. With ``claims``,
    items are taken up once instead, whether or not their batch ran to its end.
    """

    def batch(taken: DataFrame, number: int) -> None:
        if claims is None:
            run(claimed(taken, requests()), number)
            return
        fresh, name = claims.take(taken)
        run(claimed(fresh, requests()), number)
        claims.finish(taken.sparkSession, name)

    return (
        items.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def import_requests(run_group: Callable[[str, str, str], None]) -> Callable[[DataFrame, int], None]:
    """Run whole requests from a batch: ``run_group(request, owner, grp)`` once per distinct request.

    Each row is one ingest to launch, a Spark job of its own; they are drawn one by one, not all at once.
    """

    def run(items: DataFrame, _: int) -> None:
        for row in items.select("request", "owner", "grp").distinct().orderBy("request").toLocalIterator():
            run_group(row.request, row.owner, row.grp)

    return run
