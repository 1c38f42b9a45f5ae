"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is hinted for broadcast only when it provably has at most this many rows.
BROADCAST_ROWS = 200_000


def local_session(cores: str | int = "*", app: str = "tabweave", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    width = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(width))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


# Folders of our own, by application, for sessions without a shared one.
_OWN_BASES: dict[str, str] = {}


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a local master, which has one disk, gets a folder of our own."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    named = named or context.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if context.applicationId not in _OWN_BASES:
        _OWN_BASES[context.applicationId] = tempfile.mkdtemp(prefix="tabweave-")
    return _OWN_BASES[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_base(spark).rstrip('/')}/tabweave/{name}-{uuid.uuid4().hex}"


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the driver delete ``path`` when the application ends; its readers may be lazy until then."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def materialize(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """Cut the lineage with a written table, so that lost executors never change an assigned value.

    ``options`` are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    delete_on_exit(df.sparkSession, path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Hint ``df`` for broadcast if the caller's proven row bound is small, else leave the choice to Spark."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
