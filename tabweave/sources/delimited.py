"""Delimited sheets: schema on read, every cell text, exact physical row numbers."""

from __future__ import annotations

import csv

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.constants import ACCEPTED_FORMATS
from tabweave.functions.text import key_text, source_col, split_limited
from tabweave.session import bounded_broadcast, materialize

ROW = "_row"
# Lines that are looked at first for a header whose cells may hold line breaks.
FIRST_LINES = 100
# Bytes of a block of a kept sheet: what a chunk reads beside its own rows at either end.
KEPT_BLOCK = 8 << 20

_FILE, _BLOCK, _POS = "_file", "_block", "_pos"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def column_names(header: Sequence[str | None]) -> list[str]:
    """Unique column names for header cells; an unnamed or overridden cell is named by its position.

    Of cells with the same text the last one owns the name.
    """
    last = {name: i for i, name in enumerate(header) if name}
    return [name if name and last[name] == i else f"_c{i}" for i, name in enumerate(header)]


def accepted_format(path: str) -> str:
    """The file's format by extension; others than the accepted ones are refused."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix not in ACCEPTED_FORMATS:
        raise ValueError(f"Format of {path} is not one of {', '.join(ACCEPTED_FORMATS)}")
    return suffix


def accepted_files(files: DataFrame, path: str = "path") -> DataFrame:
    """A listing with the ``format`` of each file, or the ``error`` why it is refused."""
    name = F.substring_index(F.rtrim(source_col(path), F.lit("/")), "/", -1)
    suffix = F.lower(F.substring_index(name, ".", -1))
    known = F.when(suffix.isin(*ACCEPTED_FORMATS), suffix)
    words = F.concat(F.lit("Format of "), source_col(path), F.lit(f" is not one of {', '.join(ACCEPTED_FORMATS)}"))
    return files.withColumns({"format": known, "error": F.when(known.isNull(), words)})


def _pin_file_cuts(spark: SparkSession) -> None:
    """Two scans of one folder must cut its files alike even if executors come or go between them."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def _number_rows(scan: DataFrame) -> DataFrame:
    """Number the records of every file from 1, without moving a row.

    A task reads each of its file blocks in one go, so a record's place in its block is its distance
    from the block's first record. Adding the record counts of the earlier blocks of the file, a
    table with one row per block, gives the number in the file.
    """
    spark = scan.sparkSession
    _pin_file_cuts(spark)
    placed = scan.withColumn(_POS, F.monotonically_increasing_id())
    blocks = placed.groupBy(_FILE, _BLOCK).agg(F.min(_POS).alias("_first"), F.count(F.lit(1)).alias("_count"))
    # One row per block of a file: at the default block size a file of 1 TB has 8,192 rows here.
    before = Window.partitionBy(_FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.sum("_count").over(before)
    offsets = blocks.select(_FILE, _BLOCK, (F.coalesce(earlier, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    # The blocks are counted by the tasks; the driver sees their number only.
    offsets = materialize(offsets, "blocks")
    numbered = placed.join(bounded_broadcast(offsets, offsets.count()), [_FILE, _BLOCK])
    return numbered.withColumn(ROW, F.col(_POS) + F.col("_shift"))


def read_lines(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Non-blank lines of text files as ``(_file, _row, value)``, rows numbered per file from 1."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    scan = reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK),
    )
    return _number_rows(scan.filter(F.trim("value") != "")).select(_FILE, ROW, "value")


def _listed(spark: SparkSession, path: str | Sequence[str], glob: str | None) -> tuple[int, str | None]:
    """Number of the files and the least of their names; names are compared by the tasks, and no file is opened."""
    reader = spark.read.format("binaryFile")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    found = reader.load([path] if isinstance(path, str) else list(path)).agg(F.count("path").alias("n"), F.min("path").alias("least"))
    row = found.first()
    return row.n, row.least


def peek_header(
    spark: SparkSession,
    path: str | Sequence[str],
    header_row: int = 1,
    delimiter: str = ",",
    glob: str | None = None,
    multiline: bool = False,
) -> list[str]:
    """Cells of the header row of the first file; reads that file's beginning only."""
    if header_row < 1:
        raise ValueError("Failed to find header row.")
    first = _listed(spark, path, glob)[1]
    if first is None:
        raise ValueError("Failed to find header row.")
    if multiline:
        return _record(spark, first, header_row, delimiter)
    lines = (
        spark.read.text(first)
        .filter((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
        .take(header_row)
    )
    if len(lines) < header_row:
        raise ValueError("Failed to find header row.")
    return header_cells(lines[-1].value, delimiter)


def _record(spark: SparkSession, file: str, number: int, delimiter: str) -> list[str]:
    """Cells of a file's non-blank record, counted from 1, however many lines and cells it has."""
    wanted = FIRST_LINES
    while True:
        lines = [r.value for r in spark.read.text(file).filter(F.col("_metadata.file_block_start") == 0).take(wanted)]
        reader, found = csv.reader([f"{line}\n" for line in lines], delimiter=delimiter), 0
        for cells in reader:
            found += any(c.strip() for c in cells) or len(cells) > 1
            # A record that ends with the lines at hand may go on behind them.
            if found == number and (reader.line_num < len(lines) or len(lines) < wanted):
                return cells
        if len(lines) < wanted:
            raise ValueError("Failed to find header row.")
        wanted *= 2


def check_headers(
    spark: SparkSession, path: str | Sequence[str], header_row: int, glob: str | None = None
) -> None:
    """Refuse files whose header rows differ, since one header binds the cells of all."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    if header_row == 1:
        # Only the first block of a file is looked at.
        lines = reader.text(path).filter((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
        lines = lines.select("value", F.col("_metadata.file_path").alias(_FILE), F.monotonically_increasing_id().alias(_POS))
        heads = lines.groupBy(_FILE).agg(F.min_by("value", _POS).alias("value"))
    else:
        heads = read_lines(spark, path, glob).filter(F.col(ROW) == header_row)
    if len(heads.select("value").distinct().take(2)) > 1:
        raise ValueError("The files have different headers; read them one by one")


def header_cells(line: str, delimiter: str = ",") -> list[str]:
    """Cells of one header line on the driver."""
    return next(csv.reader([line], delimiter=delimiter))


def normalize_row(cells: Column, columns: Sequence[str]) -> list[Column]:
    """Cells of a list as named columns: extra cells cut, missing cells ''."""
    return [F.coalesce(F.get(cells, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)]


def lines_to_rows(lines: DataFrame, columns: Sequence[str], delimiter: str, line: str = "value") -> DataFrame:
    """Plain delimited text (no quoting) to columns; the other columns of ``lines`` stay."""
    cells = split_limited(F.col(line), delimiter)
    kept = [c for c in lines.columns if c != line]
    split = lines.select(*kept, cells.alias("_cells"))
    return split.select(*kept, *normalize_row(F.col("_cells"), columns))


def bind_columns(
    header: Sequence[str], columns: Sequence[str] | None = None, mode: str = "name"
) -> list[tuple[int, str]]:
    """Which cell feeds which column, as (position, name).

    ``name`` picks cells by header text; ``position`` gives the names to the first cells in turn.
    Without ``columns`` every header cell is taken.
    """
    if not columns:
        return list(enumerate(column_names(header)))
    if mode == "position":
        return list(enumerate(columns))
    if mode != "name":
        raise ValueError(f"Unknown binding mode {mode!r}")
    at = {name: i for i, name in enumerate(header)}
    absent = [c for c in columns if c not in at]
    if absent:
        raise ValueError(f"Columns not in the header: {', '.join(absent)}")
    return [(at[c], c) for c in columns]


def bind_rows(
    rows: DataFrame, header: Sequence[str], columns: Sequence[str], mode: str = "name", keep: Sequence[str] = ()
) -> DataFrame:
    """Bind the cell columns of ``rows`` (in header order) to ``columns``; ``keep`` passes through."""
    cells = [c for c in rows.columns if c not in keep]
    bound = bind_columns(header, columns, mode)
    return rows.select(*keep, *[source_col(cells[i]).alias(name) for i, name in bound])


def read_sheet(
    spark: SparkSession,
    path: str | Sequence[str],
    header_row: int = 0,
    columns: Sequence[str] | None = None,
    mode: str = "name",
    row_index_column: str | None = None,
    delimiter: str = ",",
    multiline: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """Rows of delimited sheets below the header row, all cells text, missing cells ''.

    Rows are numbered over the non-blank records of each file, the first being 1; that takes a second
    pass over the text, so it is done only for a row index column or a header below row 1. ``multiline``
    admits line breaks inside cells; each file is then read by one task, so use it for small files.
    """
    if isinstance(header_row, bool) or not isinstance(header_row, int):
        raise ValueError("header_row must be an int")
    if header_row < 1 and not columns:
        raise ValueError("Without a header row the columns must be given")
    if header_row >= 1 and not (columns and mode == "position"):
        header = peek_header(spark, path, header_row, delimiter, glob, multiline)
        if _listed(spark, path, glob)[0] > 1:
            check_headers(spark, path, header_row, glob)
    else:
        header = list(columns)
    bound = bind_columns(header, columns, mode)
    width = max(i for i, _ in bound) + 1
    cells = [f"_c{i}" for i in range(max(width, len(header)))]
    numbered = row_index_column is not None or header_row > 1
    if multiline or not numbered:
        # Spark itself leaves out a header on the first record, and reads the picked columns only.
        reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
        rows = reader.csv(
            path,
            schema=text_schema(cells),
            sep=delimiter,
            escape='"',
            header=header_row == 1 and not numbered,
            multiLine=multiline,
        )
        if not numbered:
            return rows.select(*[F.coalesce(F.col(cells[i]), F.lit("")).alias(name) for i, name in bound])
        file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
        rows = _number_rows(rows.select(*cells, file.alias(_FILE), block.alias(_BLOCK)))
    else:
        ddl = ", ".join(f"{c} string" for c in cells)
        parsed = F.from_csv("value", ddl, {"sep": delimiter, "escape": '"'})
        rows = read_lines(spark, path, glob).select(ROW, parsed.alias("_cells")).select(ROW, "_cells.*")
    # Tying the cells to the row number keeps a caller's strict casts away from the header row,
    # which Spark could otherwise evaluate before the row filter.
    below = F.col(ROW) > header_row
    picked = [F.when(below, F.coalesce(F.col(cells[i]), F.lit(""))).alias(name) for i, name in bound]
    if row_index_column:
        picked.append(F.col(ROW).alias(row_index_column))
    return rows.filter(below).select(*picked)


def keep_numbered(sheet: DataFrame, path: str, row: str = ROW, block_bytes: int = KEPT_BLOCK) -> DataFrame:
    """Write a numbered sheet once, so that a chunk of it reads only the blocks that hold its rows.

    Rows lie in the order of their numbers within a file, and each block's footer entry has its least and greatest
    number: an index from rows to blocks that Spark consults by itself. Nothing is shuffled. Rows of several files
    with the same number lie together, a sheet without rows gives a table without rows, and rows without a number
    are kept. ``path`` must not exist.
    """
    blocks = sheet.sortWithinPartitions(source_col(row))
    # A block's size is looked at every so many rows; the usual distance would let small blocks grow.
    blocks.write.options(**{"parquet.block.size": block_bytes, "parquet.page.size.row.check.min": 100}).parquet(path)
    return sheet.sparkSession.read.schema(sheet.schema).parquet(path)


def row_chunk(df: DataFrame, start: int, size: int, row: str = ROW) -> DataFrame:
    """Row 1 and the rows of [start, start + size); of a sheet from :func:`keep_numbered`, only their blocks are read."""
    at = source_col(row)
    return df.filter((at == 1) | ((at >= start) & (at < start + size)))


def resolve_keys(keys: Mapping[str, str] | None, row_index_column: str | None) -> dict[str, str]:
    """Declared key columns, else the row index as an integer key, else an error."""
    if keys:
        return dict(keys)
    if not row_index_column:
        raise ValueError("No keys are declared and no row index column is named to act as the key")
    return {row_index_column: "integer"}


# Declared key types and the Spark type of each.
KEY_TYPES = {"integer": "bigint", "string": "string"}


def with_keys(
    df: DataFrame,
    keys: Mapping[str, str] | None,
    row_index_column: str | None = None,
    name: str = "src_key",
    error: str | None = None,
) -> DataFrame:
    """Add the row key as one text; with ``error``, add a message for cells that are not of the declared type."""
    resolved = resolve_keys(keys, row_index_column)
    absent = [k for k in resolved if k not in df.columns]
    if absent:
        raise ValueError(f"Key columns not in the sheet: {', '.join(absent)}")
    parts, problems = [], []
    for column, declared in resolved.items():
        raw = source_col(column)
        cast = raw.try_cast(KEY_TYPES[declared])
        parts.append(F.coalesce(cast.cast("string"), raw.cast("string")))
        problems.append(
            F.when(cast.isNull(), F.concat(F.lit(f"Key {column} is not of type {declared}: "), F.coalesce(raw.cast("string"), F.lit("NULL"))))
        )
    keyed = df.withColumn(name, key_text(parts))
    return keyed.withColumn(error, F.coalesce(*problems)) if error else keyed
