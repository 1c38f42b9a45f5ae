import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabweave.functions import text as X
from tabweave.functions.steps import Context, register_callback, register_step
from tabweave.operators.routing import route_targets, write_routed
from tabweave.plans.compiler import MESSAGES, STATUS, accepted, compile_mapping

SPLIT_CASES = [
    ("pairs", ",", "=", {}, "red=3,blue=5", [{"0": "red", "1": "3"}, {"0": "blue", "1": "5"}]),
    ("three deep", "/", "-", {}, "9-8-7/6", [{"0": "9", "1": "8", "2": "7"}, {"0": "6"}]),
    ("named untrimmed", ",", "=", {"keys": ["hue", "n"], "trim": False, "subtrim": False}, " red= 3", [{"hue": " red", "n": " 3"}]),
    ("named", ",", "=", {"keys": ["hue", "n"]}, " red = 3 ,blue=5", [{"hue": "red", "n": "3"}, {"hue": "blue", "n": "5"}]),
    ("more parts than names", ",", "=", {"keys": ["hue"]}, "red=3=x", [{"hue": "red", "1": "3", "2": "x"}]),
    ("trim inside only", ",", "=", {"trim": False, "subtrim": True}, " ü = 3 , = ", [{"0": "ü", "1": "3"}, {"0": "", "1": ""}]),
    ("trim outside only", ",", "=", {"trim": True, "subtrim": False}, " ü = 3 ", [{"0": "ü ", "1": " 3"}]),
    ("empty cell", ";", "|", {}, "", []),
    ("one part", ";", "|", {}, "A", [{"0": "A"}]),
    ("trailing", ";", "|", {}, "A|;", [{"0": "A", "1": ""}, {"0": ""}]),
    ("limits", ";", "|", {"limit": 2, "sublimit": 2}, "a|b|c;d;e", [{"0": "a", "1": "b|c"}, {"0": "d;e"}]),
    ("negative limits", ";", "|", {"limit": -1, "sublimit": -1}, "a|b|c;d;e", [{"0": "a", "1": "b"}, {}]),
    ("all dropped", ";", "|", {"limit": -5}, "a;b", []),
    ("zero limit", ";", "|", {"limit": 0}, "a;b", [{"0": "a;b"}]),
    ("long delimiters", "::", "\\E.", {}, "a\\E.b::c", [{"0": "a", "1": "b"}, {"0": "c"}]),
    ("equal names", ";", "|", {"keys": ["k", "k"]}, "a|b;c", [{"k": "b"}, {"k": "c"}]),
    ("name of a later index", ";", "|", {"keys": ["1"]}, "a|b;c", [{"1": "b"}, {"1": "c"}]),
    ("control characters", ";", "|", {}, "\tA\x0b|\x00b\r\n", [{"0": "A", "1": "b"}]),
]


@pytest.mark.parametrize("case", SPLIT_CASES, ids=[c[0] for c in SPLIT_CASES])
def test_two_level_split(spark, case):
    _, delimiter, subdelimiter, options, cell, expected = case
    df = spark.createDataFrame([(cell,)], "cell string")
    assert df.select(X.two_level_split(F.col("cell"), delimiter, subdelimiter, **options)).first()[0] == expected


def test_split_refuses_bad_options():
    for bad in (dict(delimiter="", subdelimiter="|"), dict(delimiter=";", subdelimiter="")):
        with pytest.raises(ValueError):
            X.two_level_split(None, **bad)
    with pytest.raises(ValueError, match="list"):
        X.two_level_split(None, ";", "|", keys="ab")


words = st.text(alphabet="ab ;|\tx", max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(words, min_size=1, max_size=40))
def test_split_then_join_gives_the_cell_back(spark, cells):
    df = spark.createDataFrame([(c,) for c in cells], "cell string")
    parts = X.two_level_split(F.col("cell"), ";", "|", trim=False, subtrim=False)
    joined = F.array_join(F.transform(parts, lambda m: F.array_join(F.map_values(m), "|")), ";")
    assert df.select("cell", joined.alias("again")).filter("cell <> again").isEmpty()


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v"))).first()[0]


def test_text_functions(spark):
    assert one(spark, X.encode_path, "repo-bin://2024-01/a b~*+é.png") == "repo-bin://2024-01/a%20b~%2A%2B%C3%A9.png"
    assert one(spark, X.encode_path, "/x y/z:1") == "/x%20y/z%3A1"
    assert one(spark, X.basename, "/a/b/") == "b" and one(spark, X.basename, "plain") == "plain"
    assert one(spark, X.media_type, "x/Y.PNG") == "image/png" and one(spark, X.media_type, "none") == X.UNKNOWN_MEDIA_TYPE
    at = datetime.datetime(2024, 3, 5, 6, 7, 8)
    assert one(spark, lambda c: X.run_date(c, at), "Y-m-d H:i:s") == "2024-03-05 06:07:08"


def test_allowed_paths(spark):
    def allowed(value, paths=(), schemes=(), strict=False):
        return one(spark, lambda c: X.path_allowed(c, paths, schemes, strict), value)

    assert allowed("/data/x", ["/data"]) and allowed("/database/x", ["/data"])
    assert not allowed("/database/x", ["/data"], strict=True) and allowed("/data/x", ["/data/"], strict=True)
    assert not allowed("/data/../etc", ["/data"]) and not allowed(None, ["/data"])
    assert allowed("public://x", schemes=["public"]) and not allowed("Public://x", schemes=["public"])


def run(spark, rows, schema, mapping, **context):
    df = spark.createDataFrame(rows, schema)
    return compile_mapping(df, mapping, Context(**context), ["id"])


def test_first_end_in_destination_order_wins(spark):
    mapping = {
        "a": [{"plugin": "log", "source": "x", "template": "saw :value"}, {"plugin": "skip_on_empty", "message": "a is empty"}],
        "b": [{"plugin": "static_map", "source": "y", "map": {"1": "one"}}],
        "c": [{"plugin": "log", "source": "y", "template": "late :value"}],
    }
    rows = {r.id: r for r in run(spark, [(1, "x", "1"), (2, "", "2"), (3, "x", "2")], "id int, x string, y string", mapping).collect()}
    assert {i: r[STATUS] for i, r in rows.items()} == {1: "imported", 2: "ignored", 3: "ignored"}
    assert [m.text for m in rows[1][MESSAGES]] == ["saw x", "late 1"]
    assert [m.text for m in rows[2][MESSAGES]] == ["saw ", "a is empty"]
    assert [m.text for m in rows[3][MESSAGES]] == ["saw x", "No mapping for value: 2"]


def test_failed_rows_are_isolated(spark):
    mapping = {"p": [{"plugin": "subdelimited_explode", "source": "x", "delimiter": ";", "subdelimiter": "|"}]}
    rows = {r.id: r for r in run(spark, [(1, "a"), (2, None)], "id int, x string", mapping).collect()}
    assert rows[1][STATUS] == "imported" and rows[2][STATUS] == "failed" and rows[2][MESSAGES][0].level == "error"


def test_plan_time_errors(spark):
    def plan(mapping):
        return run(spark, [(1, "a")], "id int, x string", mapping)

    for mapping, words in (
        ({"a": [{"plugin": "nope", "source": "x"}]}, "Unknown step"),
        ({"a": [{"plugin": "callback", "callable": "nope", "source": "x"}]}, "Unknown callback"),
        ({"a": "@b", "b": "x"}, "does not come before"),
        ({"a": "@a"}, "does not come before"),
        ({"a": "@zz"}, "not a destination"),
        ({"a": "missing"}, "not in the sheet"),
        ({"a": [{"plugin": "default_value", "default_value": ""}]}, "Missing default"),
        ({"a": [{"plugin": "default_value", "default_value": "0"}]}, "Missing default"),
        ({"a": "x", "a/b": "x"}, "as a whole and in parts"),
        ({"a": [{"plugin": "get"}]}, "without a source"),
    ):
        with pytest.raises(ValueError, match=words):
            plan(mapping)


def test_own_steps_and_callbacks(spark):
    register_step("shout", lambda value, dtype, cfg, ctx: F.concat(F.upper(value), F.lit(cfg["mark"])))
    register_callback("reverse", lambda value, ctx: F.reverse(value))
    mapping = {"a": [{"plugin": "shout", "source": ["x", "x"], "mark": "!"}, {"plugin": "callback", "callable": "reverse"}]}
    assert accepted(run(spark, [(1, "ab")], "id int, x string", mapping)).first().a == ["!BA", "!BA"]


def test_escaped_and_dotted_sources(spark):
    mapping = {"a": "@@x", "b": "c.d"}
    row = accepted(run(spark, [(1, "at", "dot")], "id int, `@x` string, `c.d` string", mapping)).first()
    assert (row.a, row.b) == ("at", "dot")


def test_checks_on_lists(spark):
    mapping = {"a": [{"plugin": "get", "source": ["x", "y"]}, {"plugin": "static_map", "map": {"1": "one", "2": "two"}}]}
    rows = {r.id: r for r in run(spark, [(1, "1", "2"), (2, "1", "9")], "id int, x string, y string", mapping).collect()}
    assert rows[1].a == ["one", "two"] and rows[2][STATUS] == "ignored" and rows[2][MESSAGES][0].text.endswith("9")


def test_nested_pipeline_ends_rows(spark):
    mapping = {
        "parts": [
            {"plugin": "subdelimited_explode", "source": "x", "delimiter": ";", "subdelimiter": "|", "keys": ["k"]},
            {"plugin": "sub_process", "values": {"_raw": "k", "v": [{"plugin": "static_map", "source": "@_raw", "map": {"1": "one"}}]}},
        ]
    }
    rows = {r.id: r for r in run(spark, [(1, "1;1"), (2, "1;2"), (3, "")], "id int, x string", mapping).collect()}
    assert [p.v for p in rows[1].parts] == ["one", "one"] and rows[2][STATUS] == "ignored" and rows[3].parts == []


def test_file_size(spark):
    files = spark.createDataFrame([("a", 5)], "path string, length long")
    mapping = {"size": [{"plugin": "callback", "callable": "filesize", "source": "x"}]}
    rows = run(spark, [("1", "a"), ("2", "b")], "id string, x string", mapping, files=files, key="id").collect()
    rows = {r.id: r["size"] for r in rows}
    assert rows == {"1": 5, "2": None}


def test_write_routed(spark, tmp_path):
    df = spark.createDataFrame([(1, "p"), (2, "q"), (3, "z")], "id int, m string")
    write_routed(route_targets(df, "m", {"image": ["p"], "file": ["p", "q"]}), str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.id, r.target) for r in rows} == {(1, "image"), (1, "file"), (2, "file")}
