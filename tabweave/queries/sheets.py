"""Registered queries over sheets: scans, binding, row numbers, keys, worksheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.operators.numbering import running_number
from tabweave.session import scratch_path
from tabweave.sources import cells as W
from tabweave.sources import delimited as D
from tabweave.sources.tables import table

MONEY = "decimal(15,2)"


def _customer_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Delimited lines, ragged on purpose: one segment lacks its last cell, another has one too many."""
    full = F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    short = F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name")
    ragged = F.when(F.col("c_mktsegment") == "FURNITURE", short).when(
        F.col("c_mktsegment") == "MACHINERY", F.concat(full, F.lit("|extra|cells"))
    )
    return table(spark, sf, "customer").select(F.coalesce(ragged, full).alias("value"))


def sheet_from_lines(spark, sf):
    return D.lines_to_rows(_customer_lines(spark, sf), ["id", "name", "segment"], "|")


def _supplier_rows(spark, sf):
    lines = table(spark, sf, "supplier").select(
        F.concat_ws("|", F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string")).alias("value")
    )
    header = ["s_suppkey", "s_name", "s_nationkey"]
    return D.lines_to_rows(lines, ["c0", "c1", "c2"], "|"), header


def sheet_bind_position(spark, sf):
    rows, header = _supplier_rows(spark, sf)
    return D.bind_rows(rows, header, ["s_suppkey", "s_nationkey"], mode="position")


def sheet_bind_name(spark, sf):
    rows, header = _supplier_rows(spark, sf)
    return D.bind_rows(rows, header, ["s_suppkey", "s_nationkey"], mode="name")


def sheet_read(spark, sf):
    """All orders written as delimited files with header rows, then read as one sheet."""
    path = scratch_path(spark, "sheet_read")
    sheet = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast(MONEY).alias("o_totalprice"), "o_orderpriority"
    )
    sheet.write.option("header", True).csv(path)
    return D.read_sheet(spark, path, header_row=1, columns=["o_orderkey", "o_totalprice", "o_orderpriority"], glob="*.csv")


def sheet_read_multiline(spark, sf):
    """Whole conversation texts, line breaks and quotes included, through delimited files and back."""
    path = scratch_path(spark, "sheet_multiline")
    options = {
        "header": True,
        "quoteAll": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    table(spark, sf, "conversations").write.options(**options).csv(path)
    rows = D.read_sheet(spark, path, header_row=1, multiline=True, glob="*.csv")
    return rows.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


def sheet_row_index(spark, sf):
    """Physical row numbers below a header on row 1, without a single-task window."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    numbered = running_number(parts, [], ["p_partkey"], "n")
    return numbered.select("p_partkey", "p_name", (F.col("n") + 1).alias("row_index"))


def sheet_chunk(spark, sf):
    return D.row_chunk(sheet_row_index(spark, sf), start=101, size=1000, row="row_index")


def sheet_chunk_kept(spark, sf):
    """All orders as a numbered sheet that is kept in blocks, and the tenth of its rows behind the middle."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    numbered = running_number(orders, [], ["o_orderkey"], "row_index")
    kept = D.keep_numbered(numbered, scratch_path(spark, "sheet_kept"), "row_index")
    rows = kept.count()
    return D.row_chunk(kept, start=rows // 2, size=rows // 10, row="row_index")


def sheet_keys(spark, sf):
    turns = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("string").alias("turn"), "role"
    )
    return D.with_keys(turns, {"conv_id": "integer", "turn": "integer"}).select("src_key", "role")


def sheet_keys_typed(spark, sf):
    """A key that is not always of its declared type: the last segment of the address."""
    pages = table(spark, sf, "pages").select("page_id", F.substring_index("url", "/", -1).alias("slug"))
    keyed = D.with_keys(pages, {"slug": "integer"}, error="problem")
    return keyed.select("page_id", "src_key", "problem")


def _book_cells(spark, sf):
    """Workbooks per nation with a sheet of customers and one of suppliers; some cells are empty."""
    parts = []
    for name, key, title, money, nation in (
        ("customer", "c_custkey", "c_name", "c_acctbal", "c_nationkey"),
        ("supplier", "s_suppkey", "s_name", "s_acctbal", "s_nationkey"),
    ):
        rows = table(spark, sf, name)
        book = F.concat(F.lit("book-"), F.col(nation).cast("string")).alias("file")
        cells = F.array(
            F.struct(F.lit(0).alias("col_idx"), F.col(key).cast("string").alias("value")),
            F.struct(F.lit(1).alias("col_idx"), F.col(title).alias("value")),
            F.struct(F.lit(2).alias("col_idx"), F.when(F.col(money) >= 1000, F.col(money).cast(MONEY).cast("string")).alias("value")),
        )
        body = rows.select(book, (F.col(key) + 2).alias("row_idx"), F.explode(cells).alias("c"))
        head = F.array(*[F.struct(F.lit(i).alias("col_idx"), F.lit(t).alias("value")) for i, t in enumerate(("id", "title", "balance"))])
        top = rows.select(book).distinct().select("file", F.lit(1).cast("bigint").alias("row_idx"), F.explode(head).alias("c"))
        both = body.unionByName(top).filter(F.col("c.value").isNotNull())
        parts.append(both.select("file", F.lit(name).alias("sheet"), "row_idx", "c.col_idx", "c.value"))
    return parts[0].unionByName(parts[1])


def sheet_pick(spark, sf):
    return W.select_worksheet(_book_cells(spark, sf), "supplier")


def sheet_list(spark, sf):
    """Sheets per workbook; a single-sheet format has no sheet names."""
    single = table(spark, sf, "part").select(F.concat(F.col("p_type"), F.lit(".csv")).alias("file"), F.lit(None).cast("string").alias("sheet"))
    cells = _book_cells(spark, sf).select("file", "sheet").unionByName(single)
    listed = W.list_worksheets(cells)
    return listed.select("file", F.array_join(W.worksheet_label(F.col("sheets")), ",").alias("sheets"))


def sheet_validate(spark, sf):
    """Customers whose workbook of orders has sheets, but none for pending orders."""
    cells = table(spark, sf, "orders").select(F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("file"), F.col("o_orderstatus").alias("sheet"))
    requests = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")).alias("file"), F.lit("P").alias("sheet")
    )
    return W.validate_worksheet(requests, cells).select("id", "file", "sheet")


def sheet_header(spark, sf):
    head = W.header(_book_cells(spark, sf), "supplier", 1)
    return head.select("file", F.array_join("header", "|").alias("header"))


_ROW_INDEX_SQL = "SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) + 1 AS row_index FROM part"

_SUPPLIER_TEXT = "CAST(s_suppkey AS VARCHAR) AS s_suppkey"

QUERIES = {
    "sheet_from_lines": (
        sheet_from_lines,
        """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
                  CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE c_mktsegment END AS segment
           FROM customer""",
    ),
    "sheet_bind_position": (sheet_bind_position, f"SELECT {_SUPPLIER_TEXT}, s_name AS s_nationkey FROM supplier"),
    "sheet_bind_name": (
        sheet_bind_name,
        f"SELECT {_SUPPLIER_TEXT}, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier",
    ),
    "sheet_read": (
        sheet_read,
        """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
                  CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice, o_orderpriority
           FROM orders""",
    ),
    "sheet_read_multiline": (
        sheet_read_multiline,
        """SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, md5(text) AS text_md5
           FROM conversations""",
    ),
    "sheet_row_index": (sheet_row_index, _ROW_INDEX_SQL),
    "sheet_chunk": (
        sheet_chunk,
        f"SELECT * FROM ({_ROW_INDEX_SQL}) WHERE row_index = 1 OR (row_index >= 101 AND row_index < 1101)",
    ),
    "sheet_chunk_kept": (
        sheet_chunk_kept,
        """SELECT o_orderkey, o_orderstatus, row_index
           FROM (SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) AS row_index, count(*) OVER () AS n FROM orders)
           WHERE row_index = 1 OR (row_index >= n // 2 AND row_index < n // 2 + n // 10)""",
    ),
    "sheet_keys": (
        sheet_keys,
        "SELECT CAST(conv_id AS VARCHAR) || chr(31) || CAST(turn AS VARCHAR) AS src_key, role FROM conversations",
    ),
    "sheet_keys_typed": (
        sheet_keys_typed,
        """WITH s AS (SELECT page_id, string_split(url, '/')[-1] AS slug FROM pages)
           SELECT page_id, slug AS src_key,
                  CASE WHEN NOT regexp_full_match(slug, '[0-9]+')
                       THEN 'Key slug is not of type integer: ' || slug END AS problem
           FROM s""",
    ),
    "sheet_pick": (
        sheet_pick,
        """SELECT 'book-' || s_nationkey AS file, s_suppkey + 2 AS row_idx, CAST(s_suppkey AS VARCHAR) AS id,
                  s_name AS title,
                  CASE WHEN s_acctbal >= 1000 THEN CAST(CAST(s_acctbal AS DECIMAL(15,2)) AS VARCHAR) ELSE '' END AS balance
           FROM supplier""",
    ),
    "sheet_list": (
        sheet_list,
        """WITH s AS (SELECT DISTINCT 'book-' || c_nationkey AS file, 'customer' AS sheet FROM customer
                      UNION SELECT DISTINCT 'book-' || s_nationkey, 'supplier' FROM supplier)
           SELECT file, string_agg(sheet, ',' ORDER BY sheet) AS sheets FROM s GROUP BY file
           UNION ALL SELECT DISTINCT p_type || '.csv', 'Single-sheet format' FROM part""",
    ),
    "sheet_validate": (
        sheet_validate,
        """SELECT c_custkey AS id, 'cust-' || c_custkey AS file, 'P' AS sheet FROM customer
           WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
             AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""",
    ),
    "sheet_header": (
        sheet_header,
        "SELECT DISTINCT 'book-' || s_nationkey AS file, 'id|title|balance' AS header FROM supplier",
    ),
}
