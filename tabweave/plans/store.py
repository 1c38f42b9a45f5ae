"""Where a run keeps its state: tables in versions, which are merged when they are read.

A job's table is a folder of versions, each written beside it and then put in its place by one rename. A base
holds whole rows. A change on top of it holds the rows of some keys as they are now, and the keys that have none
any more: an import or a rollback writes what it changes, not the table. Of a key that changes name, the rows of
the latest count; those of the base are the rest. Versions below the latest base are no longer read.

Many changes become one; once they are a share of the base, all becomes a new base.

The base of an id map lies in ranges of its keys, a file each, and beside it a hash tree over these ranges is kept,
see :mod:`tabweave.operators.hashtree`.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.operators.hashtree import Tree, build_tree, ranges_for, rebuilt
from tabweave.session import materialize
from tabweave.sources.delimited import text_schema

ID_MAP = text_schema(["src_key", "dest_id", "status", "rollback_action", "row_hash"])
MESSAGES = text_schema(["src_key", "level", "text"])
COPIES = text_schema(["src_key", "field", "from", "to", "wanted"]).add("move", T.BooleanType())

# Changes above this share of the base's bytes become a new base; more changes than this become one.
SHARE = 0.25
MOST_CHANGES = 8

_GONE, _VERSION = "_gone", "version"
_BASE, _CHANGE = "base", "change"


def table_key(table: str) -> str:
    """The column by which rows of a table replace each other; one key may have several rows."""
    return "id" if table.startswith("targets/") else "src_key"


def merged(base: DataFrame, changes: DataFrame, keys: Sequence[str], several: bool = True) -> DataFrame:
    """The rows of ``base`` whose key no change names, and of each other key the rows of its latest change.

    The base is not shuffled for its own sake: it meets the changed keys only, which are few. Without
    ``several``, the changes are of one version and no key needs a choice.
    """
    named, latest = changes.select(*keys), changes
    if several:
        last = changes.groupBy(*keys).agg(F.max(_VERSION).alias("_last"))
        latest = changes.join(last, list(keys)).filter(F.col(_VERSION) == F.col("_last")).drop("_last")
        named = last.select(*keys)
    latest = latest.filter(~F.col(_GONE)).drop(_GONE, _VERSION)
    rows = base.join(named, list(keys), "left_anti").unionByName(latest, allowMissingColumns=True)
    return rows.select(*base.columns, *[c for c in rows.columns if c not in base.columns])


class Store:
    """Tables ``id_map``, ``messages``, ``copies`` and ``targets`` below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _names(self, path: str) -> list[str]:
        fs, at = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def exists(self, path: str) -> bool:
        fs, at = self._fs(path)
        return fs.exists(at)

    def folder(self, table: str, migration: str) -> str:
        if not re.fullmatch(r"[\w.\-]+", migration):
            raise ValueError(f"Job name {migration!r} has characters a folder name may not have")
        return f"{self.root}/{table}/migration={migration}"

    def staging(self, name: str) -> str:
        return f"{self.root}/_staging/{name}-{uuid.uuid4().hex}"

    def _live(self, folder: str) -> list[str]:
        """The versions that count: the latest base, and the changes after it in order."""
        names = [n for n in self._names(folder) if n.startswith(f"{_VERSION}=")]
        bases = [i for i, n in enumerate(names) if n.endswith(_BASE)]
        return names[bases[-1] :] if bases else []

    def _add(self, folder: str, df: DataFrame, kind: str) -> str:
        """Write a version, then put it behind all others by a rename, so that it is there whole or not at all."""
        fresh = self.staging(kind)
        df.write.parquet(fresh)
        names = self._names(folder)
        number = int(re.search(r"=(\d+)-", names[-1])[1]) + 1 if names else 0
        name = f"{_VERSION}={number:09}-{kind}"
        fs, at = self._fs(f"{folder}/{name}")
        _, source = self._fs(fresh)
        fs.mkdirs(at.getParent())
        if fs.exists(at) or not fs.rename(source, at):
            raise OSError(f"Could not put {fresh} in place")
        return name

    def _drop(self, folder: str, below: str, kinds: Sequence[str] = (_BASE, _CHANGE)) -> None:
        for name in self._names(folder):
            if name < below and name.endswith(tuple(kinds)):
                self.discard(f"{folder}/{name}")

    def replace(self, table: str, migration: str, df: DataFrame) -> None:
        """Make ``df`` the content of a job's table, as its base. ``df`` may read the table."""
        folder = self.folder(table, migration)
        if table == "id_map":
            df = materialize(df, "id_map")
            df = df.repartitionByRange(ranges_for(df.count()), "src_key").sortWithinPartitions("src_key")
        self._drop(folder, self._add(folder, df, _BASE))

    def change(self, table: str, migration: str, rows: DataFrame | None = None, gone: DataFrame | None = None) -> None:
        """Give the keys of ``rows`` these rows, and take all rows from the keys in ``gone`` that are not among them.

        Only what is given is written. A table that is not there yet is made of ``rows``.
        """
        key = table_key(table)
        if not self.has(table, migration):
            if rows is not None:
                self.replace(table, migration, rows)
            return
        parts = [] if rows is None else [rows.withColumn(_GONE, F.lit(False))]
        if gone is not None:
            parts.append(gone.select(key).distinct().withColumn(_GONE, F.lit(True)))
        if not parts:
            return
        folder = self.folder(table, migration)
        self._add(folder, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), _CHANGE)
        self._tidy(table, migration)

    def _bytes(self, path: str) -> int:
        fs, at = self._fs(path)
        return fs.getContentSummary(at).getLength()

    def bytes_of(self, table: str) -> int:
        """Bytes of a table of all jobs, as the file system tells."""
        path = f"{self.root}/{table}"
        return self._bytes(path) if self.exists(path) else 0

    def _tidy(self, table: str, migration: str) -> None:
        """Compact a table whose changes are many or a share of it. Sizes are asked of the file system."""
        folder = self.folder(table, migration)
        base, *changes = self._live(folder)
        size = sum(self._bytes(f"{folder}/{c}") for c in changes)
        if size > SHARE * self._bytes(f"{folder}/{base}"):
            self.compact(table, migration)
        elif len(changes) > MOST_CHANGES:
            rows, last = self._changes(table, migration, changes), table_key(table)
            latest = rows.groupBy(last).agg(F.max(_VERSION).alias("_last"))
            rows = rows.join(latest, last).filter(F.col(_VERSION) == F.col("_last")).drop("_last", _VERSION)
            # With all of them still there, the new one says the same as they do together.
            self._drop(folder, self._add(folder, rows, _CHANGE), [_CHANGE])

    def compact(self, table: str, migration: str) -> None:
        """Write the table as it is now as a new base."""
        if len(self._live(self.folder(table, migration))) > 1:
            self.replace(table, migration, self.read(table, migration, _SCHEMAS.get(table)))

    def _changes(self, table: str, migration: str, names: Sequence[str]) -> DataFrame:
        """All rows of some changes, with their version. Without a known schema, each has columns of its own."""
        folder = self.folder(table, migration)
        if table in _SCHEMAS:
            whole = T.StructType([*_SCHEMAS[table].fields, *_CHANGED])
            return self.spark.read.schema(whole).option("basePath", folder).parquet(*[f"{folder}/{n}" for n in names])
        parts = [self.spark.read.parquet(f"{folder}/{n}").withColumn(_VERSION, F.lit(n.partition("=")[2])) for n in names]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def tree(self, migration: str) -> Tree | None:
        """The hash tree of a job's id map as it is now, if there is one: not after versions that it does not know."""
        kept, live = self._kept_tree(migration), self._live(self.folder("id_map", migration))
        return kept[1] if kept and kept[0] == live else None

    def _kept_tree(self, migration: str) -> tuple[list[str], Tree] | None:
        path = self.folder("ranges", migration)
        row = self.spark.read.text(path, wholetext=True).first() if self.exists(path) else None
        if row is None:
            return None
        of, lows, digests = json.loads(row.value)
        return of, Tree(tuple(lows), tuple(map(tuple, digests)))

    def keep_tree(self, migration: str, leaves: Sequence[int] | None = None) -> None:
        """Write the hash tree of a job's id map.

        If only the ranges ``leaves`` changed since the last one was written, only they are read, as long as the
        base is the same; without a change the tree stays as it is.
        """
        folder = self.folder("id_map", migration)
        live, kept = self._live(folder), self._kept_tree(migration)
        if not live or (kept and kept[0] == live):
            return
        known = self.id_map(migration)
        if leaves is not None and kept and kept[0][0] == live[0]:
            tree = rebuilt(kept[1], known, leaves)
        else:
            tree = build_tree(known, self._base_lows(folder, live[0]))
        row = self.spark.createDataFrame([(json.dumps([live, tree.lows, tree.digests]),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(self.folder("ranges", migration))

    def _base_lows(self, folder: str, base: str) -> tuple[str, ...]:
        """The lowest key of each file of an id map's base; files are few and lie in ranges."""
        rows = self.spark.read.schema(ID_MAP).parquet(f"{folder}/{base}")
        lows = rows.groupBy(F.col("_metadata.file_path")).agg(F.min("src_key").alias("low")).select("low").collect()
        return tuple(sorted(r.low for r in lows)) or ("",)

    def discard(self, path: str) -> None:
        fs, at = self._fs(path)
        if fs.exists(at):
            fs.delete(at, True)

    def remove(self, table: str, migration: str) -> None:
        self.discard(self.folder(table, migration))

    def read(self, table: str, migration: str, schema: T.StructType | None = None) -> DataFrame | None:
        """A job's table; without one, an empty frame if the schema is known, else None."""
        folder = self.folder(table, migration)
        live = self._live(folder)
        if not live:
            return None if schema is None else self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        base = reader.parquet(f"{folder}/{live[0]}")
        if len(live) == 1:
            return base
        return merged(base, self._changes(table, migration, live[1:]), [table_key(table)], len(live) > 2)

    def has(self, table: str, migration: str) -> bool:
        return bool(self._live(self.folder(table, migration)))

    def id_map(self, migration: str) -> DataFrame:
        return self.read("id_map", migration, ID_MAP)

    def messages(self, migration: str) -> DataFrame:
        return self.read("messages", migration, MESSAGES)

    def copies(self, migration: str) -> DataFrame:
        """The job's copy manifest: where from, where to, the name asked for, and whether the source goes away."""
        return self.read("copies", migration, COPIES)

    def all_rows(self, table: str, schema: T.StructType) -> DataFrame:
        """The table of all jobs, with the job as partition column ``migration``: one scan, and one merge if there are changes."""
        whole = T.StructType([*schema.fields, T.StructField("migration", T.StringType())])
        path, bases, changes, several = f"{self.root}/{table}", [], [], False
        for job in self._names(path):
            live = [f"{path}/{job}/{name}" for name in self._live(f"{path}/{job}")]
            bases += live[:1]
            changes += live[1:]
            several = several or len(live) > 2
        if not bases:
            return self.spark.createDataFrame([], whole)
        base = self.spark.read.schema(whole).option("basePath", path).parquet(*bases)
        base = base.select(*whole.names)
        if not changes:
            return base
        rows = self.spark.read.schema(T.StructType([*whole.fields, *_CHANGED])).option("basePath", path).parquet(*changes)
        return merged(base, rows, ["migration", table_key(table)], several)


_SCHEMAS = {"id_map": ID_MAP, "messages": MESSAGES, "copies": COPIES}
_CHANGED = [T.StructField(_GONE, T.BooleanType()), T.StructField(_VERSION, T.StringType())]
