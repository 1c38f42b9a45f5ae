"""Workbooks as a long cell table ``(file, sheet, row_idx, col_idx, value)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.sources.delimited import column_names

SINGLE_SHEET_LABEL = "Single-sheet format"


def header(cells: DataFrame, sheet: str | None, row: int = 1) -> DataFrame:
    """Header cells of each file in column order, empty cells included, as ``(file, header)``.

    A row has at most as many cells as a sheet has columns, so the list per file is small.
    """
    picked = cells.filter((F.col("row_idx") == row) & (F.lit(True) if sheet is None else F.col("sheet") == sheet))
    listed = picked.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("col_idx", "value"))).alias("_cells"))
    return listed.select("file", F.transform("_cells", lambda c: F.coalesce(c["value"], F.lit(""))).alias("header"))


def pick_sheet(cells: DataFrame, sheet: str, indexes: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Rows of one worksheet with the given columns, missing cells ''; one shuffle on (file, row)."""
    picked = cells.filter(F.col("sheet") == sheet)
    columns = [
        F.coalesce(F.max(F.when(F.col("col_idx") == i, F.col("value"))), F.lit("")).alias(n)
        for i, n in zip(indexes, names, strict=True)
    ]
    return picked.groupBy("file", "row_idx").agg(*columns)


def select_worksheet(cells: DataFrame, sheet: str, header_row: int = 1) -> DataFrame:
    """The data rows of a worksheet under its header's names; an absent worksheet is an error.

    A file's header may end earlier than another's, but headers that differ are refused. Only the longest
    reaches the driver.
    """
    picked = cells.filter(F.col("sheet") == sheet)
    heads = header(picked, None, header_row).select("header").distinct()
    longest = heads.orderBy(F.size("header").desc(), "header").first()
    if longest is None:
        if picked.isEmpty():
            raise ValueError(f"Failed to find worksheet {sheet!r}.")
        raise ValueError("Failed to find header row.")
    head = longest.header
    same = F.slice(F.array(*map(F.lit, head)), F.lit(1), F.size("header")) == F.col("header")
    if not heads.filter(~same).isEmpty():
        raise ValueError("The files have different headers; select them one by one")
    rows = pick_sheet(cells, sheet, range(len(head)), column_names(head))
    return rows.filter(F.col("row_idx") > header_row)


def list_worksheets(cells: DataFrame, name: str = "sheets") -> DataFrame:
    """Sheet names of each file, NULL for single-sheet formats.

    Cells are reduced to distinct names before any list is made.
    """
    sheets = F.array_sort(F.collect_set("sheet"))
    return cells.select("file", "sheet").distinct().groupBy("file").agg(F.when(F.size(sheets) > 0, sheets).alias(name))


def worksheet_label(sheets: Column) -> Column:
    """What a user sees for a file's sheets."""
    return F.coalesce(sheets, F.array(F.lit(SINGLE_SHEET_LABEL)))


def validate_worksheet(requests: DataFrame, cells: DataFrame) -> DataFrame:
    """Requests ``(…, file, sheet)`` whose sheet is not in a file that has sheets."""
    known = cells.select("file", "sheet").distinct()
    named = known.filter(F.col("sheet").isNotNull()).select("file").distinct()
    return requests.join(named, "file", "left_semi").join(known, ["file", "sheet"], "left_anti")
