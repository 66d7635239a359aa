"""Records that cannot be read, endpoints, export wrappings, forms of an input, and the import summary, on odd rows."""

import pytest
from pyspark.sql import functions as F

from vigil.operators import imports as M
from vigil.plans import catalog

from .test_catalog import SF, duck, plain  # noqa: F401


@pytest.mark.parametrize("name", ["endpoint_tuple", "unwrap_text", "reject_malformed", "import_summary", "preferred_form", "lifetime_evidence", "apply_labels", "label_conflicts", "unique_commands"])
def test_as_duckdb(spark, duck, name):  # noqa: F811
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    names = ", ".join(f'"{c}"' for c in columns)
    want = duck.execute(f"SELECT {names} FROM ({catalog.SQL[name]})").fetchall()
    assert sorted((tuple(map(plain, r)) for r in got.select(*columns).collect()), key=str) == sorted((tuple(map(plain, r)) for r in want), key=str)


def test_every_line_is_a_record_or_a_reject(spark):
    lines = ['{"a": 1, "b": "x"}', "{}", '{"a": "no number"}', "[1]", "3", "null", '"text"', '{"a": 1', "", "  ", None, '{"a": 1} {"a": 2}']
    df = spark.createDataFrame(list(enumerate(lines)), "id int, raw string").withColumn("file", F.lit("f"))
    good, bad = M.json_records(df, "id", "raw", "a int, b string")
    assert sorted((r.id, r.a, r.b) for r in good.collect())[:2] == [(0, 1, "x"), (1, None, None)] and good.columns == ["id", "file", "a", "b"]
    reasons = {r.id: r.reason for r in bad.collect()}
    assert reasons == {3: "no-object", 4: "no-object", 5: "no-object", 6: "no-object", 7: "malformed-json", 8: "empty", 9: "empty", 10: "empty", 11: "malformed-json"}
    assert {r.reason: r.n for r in M.reject_counts(bad).collect()} == {"no-object": 4, "malformed-json": 2, "empty": 3}
    assert good.count() + bad.count() == len(lines)


def test_endpoints(spark):
    rows = [("a", "1", "b", "65535"), ("a", "0", "b", "2"), ("a", "1", "b", "65536"), ("", "1", "b", "2"), (None, "1", "b", "2"), ("a", "+1", "b", "2"), ("a", "1.0", "b", "2"), ("a", None, "b", "2"), ("a", "9" * 30, "b", "2"), ("a", "07", "b", "2")]
    df = spark.createDataFrame(rows, "s string, sp string, t string, tp string")
    got = [r.e and tuple(r.e) for r in df.select(M.endpoints(F.col("s"), F.col("sp"), F.col("t"), F.col("tp")).alias("e")).collect()]
    assert got == [("a", 1, "b", 65535)] + [None] * 8 + [("a", 7, "b", 2)]


def test_wrapped_texts(spark):
    cases = {"a\\nb\\u00e9\\\\": "a\nbé\\", 'broken \\x "': 'broken \\x "', "&lt;&amp;lt;&#233;&#x1F600;&#;&bad;": "<&lt;é\U0001f600&#;&bad;", "CMD:  x": "x", "CMD:": "", "x CMD:": "x CMD:", "": "", None: None}
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    got = {r.x: r.y for r in df.select("x", M.exported_text(F.col("x"), True, True, ("CMD:",)).alias("y")).collect()}
    assert got == cases


def test_forms_of_one_connection(spark):
    rows = [("a", "input", False, None), ("a", "input", True, "ambiguous-fragment"), ("a", "failed", True, "failed-with-literal-input"), ("b", "failed", True, "isolated-failed-fragment"), ("b", "failed", False, "handler-echo"), ("c", "input", True, None), ("c", "failed", True, None), ("c", "other", False, "no-input"), (None, "input", True, None), (None, None, None, "no-input")]
    df = spark.createDataFrame(rows, "k string, kind string, w boolean, want string")
    got = M.preferred_forms(df, ["k"], F.col("kind") == "input", F.col("kind") == "failed", F.col("w")).collect()
    assert len(got) == len(rows) and all(r.want == r.reason for r in got)


def test_summary_of_null_groups_and_ties(spark):
    rows = [("g", "x", "unknown", "s1"), ("g", "x", "unknown", "s1"), ("g", "y", "unknown", "s2"), ("g", "z", "benign", None), ("g", "z", "malicious", None), (None, None, "benign", "s1")]
    df = spark.createDataFrame(rows, "d string, text string, label string, session string")
    got = {r.d: r.asDict(True) for r in M.import_summary(df, ["d"], "text", "label", "session", top=1).collect()}
    g = got["g"]
    assert (g["n"], g["unknown"], g["texts"], g["unknown_texts"], g["sessions"], g["singletons"]) == (5, 3, 3, 2, 3, 1)
    assert g["frequent_unknown"] == [{"text": "x", "n": 2}] and g["unknown_rate"] == 0.6
    assert got[None]["frequent_unknown"] == [] and got[None]["singletons"] == 1
