import random

import pytest
from pyspark.sql import functions as F

from tabweave.sources import cells as W
from tabweave.sources import delimited as D
from tabweave.sources.files import file_listing
from tests import sample

TWO_BOOKS = [
    ("a", "s1", 1, 0, "ID"), ("a", "s1", 1, 1, "T"), ("a", "s1", 1, 2, None), ("a", "s1", 2, 0, "1"), ("a", "s1", 3, 1, "x"),
    ("a", "s2", 1, 0, "ID"), ("b", "s1", 1, 0, "ID"), ("b", "s1", 2, 0, "9"), ("c", None, 1, 0, "ID"),
]


@pytest.fixture
def cells(spark):
    return spark.createDataFrame(TWO_BOOKS, "file string, sheet string, row_idx long, col_idx int, value string")


def test_sample_sheet(spark, sheet_path):
    sheet = D.read_sheet(spark, sheet_path, header_row=1, row_index_column="row")
    rows = sheet.orderBy("row").collect()
    assert len(rows) == sample.ROWS and sheet.columns == sample.SHEET.splitlines()[0].split(",") + ["row"]
    assert [r.row for r in rows] == list(range(2, sample.ROWS + 2))
    assert rows[0].Within == "" and rows[0].Label == "Maps, old" and rows[2].Note == 'says "Turicum"'


def test_columns_by_name_and_by_position(spark, sheet_path):
    named = D.read_sheet(spark, sheet_path, header_row=1, columns=["No", "Label"])
    assert {r.Label for r in named.collect()} >= {"Zürich", "Letter, torn"}
    placed = D.read_sheet(spark, sheet_path, header_row=1, columns=["No", "Label"], mode="position")
    assert {r.Label for r in placed.collect()} == {"", "1", "2", "3", "1;2", "99;1"}
    with pytest.raises(ValueError, match="not in the header"):
        D.read_sheet(spark, sheet_path, header_row=1, columns=["Nope"])


def test_no_header(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("1,a,extra\n2\n")
    with pytest.raises(ValueError, match="columns must be given"):
        D.read_sheet(spark, str(path))
    with pytest.raises(ValueError, match="int"):
        D.read_sheet(spark, str(path), header_row="1")
    rows = D.read_sheet(spark, str(path), columns=["A", "B"], mode="position").collect()
    assert {(r.A, r.B) for r in rows} == {("1", "a"), ("2", "")}
    with pytest.raises(ValueError, match="header row"):
        D.read_sheet(spark, str(path), header_row=5)


def test_row_numbers_over_many_blocks(spark, tmp_path):
    rng = random.Random(7)
    for name in ("one", "two"):
        with open(tmp_path / f"{name}.csv", "w") as out:
            out.write("ID,Text\n")
            for i in range(1, 4001):
                out.write(f'{i},"{"x" * rng.randrange(40)}"\n' + ("\n" if i % 5 == 0 else ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        sheet = D.read_sheet(spark, str(tmp_path), header_row=1, row_index_column="row")
        assert sheet.count() == 8000
        assert sheet.filter(F.col("ID").cast("int") + 1 != F.col("row")).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('ID,"Long ""title""",Note\n1,"a, ""b""",""\n2,"two\nlines",x\n')
    rows = D.read_sheet(spark, str(path), header_row=1, multiline=True, row_index_column="row").orderBy("row").collect()
    assert [tuple(r) for r in rows] == [("1", 'a, "b"', "", 2), ("2", "two\nlines", "x", 3)]


def test_header_names():
    assert D.column_names(["A", "", "B", "A"]) == ["_c0", "_c1", "B", "A"]
    assert D.accepted_format("/x/y.ODS") == "ods"
    with pytest.raises(ValueError):
        D.accepted_format("/x/y.txt")


def test_keys(spark):
    df = spark.createDataFrame([("01", "a"), ("x", "b")], "ID string, T string")
    rows = D.with_keys(df, {"ID": "integer"}, error="e").orderBy("T").collect()
    assert rows[0].src_key == "1" and rows[0].e is None
    assert rows[1].src_key == "x" and "integer" in rows[1].e
    assert D.resolve_keys({}, "row") == {"row": "integer"}
    with pytest.raises(ValueError, match="No keys"):
        D.resolve_keys(None, None)
    with pytest.raises(ValueError, match="not in the sheet"):
        D.with_keys(df, {"Nope": "integer"})


def test_chunk(spark):
    df = spark.range(1, 20).withColumnRenamed("id", D.ROW)
    assert sorted(r[0] for r in D.row_chunk(df, 5, 3).collect()) == [1, 5, 6, 7]


def _rows_scanned(df):
    """Rows that the scan below ``df`` gave out when ``df`` was collected."""
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_chunks_of_a_kept_sheet_read_their_blocks_only(spark, tmp_path):
    rows = 40_000
    text = F.sha2(F.col("id").cast("string"), 512)
    sheet = spark.range(1, rows + 1, 1, 4).select(F.col("id").alias("a row"), text.alias("Text"))
    kept = D.keep_numbered(sheet, str(tmp_path / "kept"), "a row", block_bytes=64 << 10)
    for start, size in ((20_001, 500), (1, 10), (rows - 5, 100), (rows + 1, 10)):
        chunk = D.row_chunk(kept, start, size, "a row")
        found = sorted(r[0] for r in chunk.collect())
        assert found == sorted({1} | set(range(start, min(start + size, rows + 1))))
        assert _rows_scanned(chunk) < rows / 5
    assert kept.count() == rows and kept.agg(F.sum(F.crc32("Text"))).first() == sheet.agg(F.sum(F.crc32("Text"))).first()
    odd = spark.createDataFrame([(1, "a"), (None, "b"), (2, ""), (2, None)], "row long, T string")
    again = D.keep_numbered(odd, str(tmp_path / "odd"), "row")
    assert again.count() == 4 and sorted(r.row for r in D.row_chunk(again, 2, 1, "row").collect()) == [1, 2, 2]
    none = D.keep_numbered(odd.limit(0), str(tmp_path / "none"), "row")
    assert none.schema == odd.schema and D.row_chunk(none, 1, 9, "row").count() == 0


def test_worksheets(spark, cells):
    rows = {(r.file, r.ID, r["T"], r["_c2"]) for r in W.select_worksheet(cells, "s1").collect()}
    assert rows == {("a", "1", "", ""), ("a", "", "x", ""), ("b", "9", "", "")}
    with pytest.raises(ValueError, match="Failed to find worksheet"):
        W.select_worksheet(cells, "S1")
    listed = {r.file: r.sheets for r in W.list_worksheets(cells).collect()}
    assert listed == {"a": ["s1", "s2"], "b": ["s1"], "c": None}
    requests = spark.createDataFrame([(1, "a", "s2"), (2, "b", "s2"), (3, "c", "any")], "id int, file string, sheet string")
    assert [r.id for r in W.validate_worksheet(requests, cells).collect()] == [2]
    assert {r.file: r.header for r in W.header(cells, "s1", 1).collect()} == {"a": ["ID", "T", ""], "b": ["ID"]}
    assert {r.file: r.header for r in W.header(cells, "s1", 2).collect()} == {"a": ["1"], "b": ["9"]}


def test_file_listing(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"12345")
    assert [r.length for r in file_listing(spark, str(tmp_path)).collect()] == [5]


def test_plain_and_numbered_scans_agree(spark, tmp_path):
    text = '\n\nID,"T ""x""",N\n1,"a, b",c,extra,cells\n\n2\n3,"",\n4, spaced ,"q""q"\nID,"T ""x""",N\n,,\n'
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text('ID,"T ""x""",N\n9,x,y\n')
    plain = D.read_sheet(spark, str(tmp_path / "*.csv"), header_row=1)
    numbered = D.read_sheet(spark, str(tmp_path / "*.csv"), header_row=1, row_index_column="row").drop("row")
    assert plain.columns == numbered.columns == ["ID", 'T "x"', "N"]
    rows = sorted(map(tuple, plain.collect()))
    assert rows == sorted(map(tuple, numbered.collect()))
    assert ("4", " spaced ", 'q"q') in rows and ("ID", 'T "x"', "N") in rows and ("", "", "") in rows and len(rows) == 7
    assert D.read_sheet(spark, str(tmp_path / "b.csv"), header_row=2, columns=["9", "x"]).count() == 0
