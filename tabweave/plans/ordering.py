"""Jobs in dependency order."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.session import scratch_path


def levels_of(requires: Mapping[str, Iterable[str]]) -> list[list[str]]:
    """Jobs of one group, level by level; requirements outside the group do not count."""
    left = {job: set(needs) & set(requires) for job, needs in requires.items()}
    levels = []
    while left:
        ready = sorted(job for job, needs in left.items() if not needs)
        if not ready:
            raise ValueError(f"Jobs require each other: {', '.join(sorted(left))}")
        levels.append(ready)
        left = {job: needs - set(ready) for job, needs in left.items() if needs}
    return levels


def job_levels(jobs: DataFrame, depends: DataFrame) -> DataFrame:
    """The level of every job of a whole catalog, for ``jobs(job)`` and ``depends(job, requires)``.

    A requirement stays open while the required job has open requirements of its own. Each round
    writes the requirements still open; there are as many rounds as the longest chain, each smaller
    than the one before. The level of a job is the number of rounds it was waiting in.
    """
    spark = jobs.sparkSession
    known = jobs.select("job").distinct()
    edges = (
        depends.select("job", "requires")
        .join(known.select(F.col("job").alias("requires")), "requires", "left_semi")
        .join(known, "job", "left_semi")
        .select("job", "requires")
        .distinct()
    )
    root = scratch_path(spark, "levels")
    before = None
    for number in itertools.count():
        path = f"{root}/round={number}"
        edges.write.parquet(path)
        edges = spark.read.schema(edges.schema).parquet(path)
        left = edges.count()
        if left == 0:
            break
        if left == before:
            raise ValueError("Jobs require each other")
        before = left
        waiting = edges.select(F.col("job").alias("requires")).distinct()
        edges = edges.join(waiting, "requires", "left_semi").select("job", "requires")
    schema = T.StructType([edges.schema["job"], T.StructField("round", T.LongType())])
    waited = spark.read.schema(schema).parquet(root).select("job", (F.col("round") + 1).alias("level"))
    every = known.select("job", F.lit(0).cast("bigint").alias("level")).unionByName(waited)
    return every.groupBy("job").agg(F.max("level").alias("level"))
