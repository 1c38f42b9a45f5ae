"""Listings of stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def file_listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files as ``(path, length)``; only names and sizes are read, never the bytes."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")
