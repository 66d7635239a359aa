"""Texts are read once a row, and by many tasks: what plans name, and rows whose reading depends on it."""

import uuid

import pytest
from pyspark.sql import functions as F

from vigil.functions import columns as C
from vigil.functions import shell as H
from vigil.operators import audit as A
from vigil.operators import joins as J
from vigil.operators import literals as L
from vigil.plans import catalog, checked, records  # noqa: F401
from vigil.sources import documents as D
from vigil.sources import sinks as K

from .test_catalog import SF


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def times_read(df) -> int:
    return optimized(df).count("regexp_extract_all(")


def test_audit_lines_are_read_once(spark):
    df = spark.createDataFrame([("f", 1, "type=EXECVE msg=audit(1:2): a0=\"x\"")], "file string, n int, s string")
    assert times_read(A.audit_commands(df, "file", "n", "s")) <= 6  # of lines, of open quotes twice, of words twice, and of boots


def test_audit_open_quotes(spark):
    # a quote that is open at a line's end goes on in the next line of the event; with `type=` inside it is no field
    rows = [(1, "type=SYSCALL msg=audit(1:1): syscall=execve success=yes exe=\"/bin/a"), (2, "type=EXECVE msg=audit(1:1): argc=1 a0=\"b\""), (3, "type=EXECVE msg=audit(1:3): a0=\"c\" a1=\"d"), (4, "type=EXECVE msg=audit(1:3): e\" a2=66"), (5, "type=PATH msg=audit(1:4): name=\"x\"")]
    got = {r.event: r for r in A.audit_commands(spark.createDataFrame([("f", *r) for r in rows], "file string, n int, s string"), "file", "n", "s").collect()}
    assert set(got) == {"1:1", "1:3"} and got["1:1"].argv == ["b"] and got["1:1"].fields["exe"] == "\"/bin/a\ntype=EXECVE msg=audit(1:1): argc=1 a0=\""
    assert got["1:3"].argv == ["c", "d\ntype=EXECVE msg=audit(1:3): e", "f"]


def test_narrative_and_shell_texts_are_read_once(spark):
    df = spark.createDataFrame([(1, "x")], "id int, t string")
    assert times_read(D.narrative_events(df, "id", "t")) <= 4  # lines and fields, two groups each
    assert times_read(df.select(H.invocations(F.col("t")).alias("w"))) <= 3  # commands, words and their pieces
    assert times_read(df.select(C.key_values(F.col("t")).alias("f"))) <= 2


@pytest.mark.parametrize("name", ["audit_commands", "flatten_envelope", "narrative_events", "shell_invocations"])
def test_rows_of_one_file_go_to_many_tasks(spark, name):
    assert "RepartitionByExpression [event_id" in optimized(catalog.QUERIES[name](spark, SF)) or name == "audit_commands" and "RepartitionByExpression [file" in optimized(catalog.QUERIES[name](spark, SF))


def test_last_entries(spark):
    rows = spark.createDataFrame([(["b", "a", "b", "a"], ["1", None, None, "2"]), ([], []), (None, None)], "k array<string>, v array<string>")
    assert [r[0] for r in rows.select(C.last_wins(F.col("k"), F.col("v"))).collect()] == [{"a": "2", "b": None}, {}, None]


def test_procedure_steps_deal_no_arguments(spark):
    launches = spark.createDataFrame([(1, "h", "LS", ["-L"]), (2, "h", "ls", [None]), (3, "h", "ls", []), (4, "g", "ls", ["-l"]), (5, "h", None, ["-l"])], "i int, host string, pgm_base string, args array<string>")
    steps = spark.createDataFrame([("h", "ls", ["-l"], "b"), (None, "ls", ["-l"], "a"), (None, "ls", [], "c"), (None, None, ["-l"], "d")], "host string, pgm_base string, args array<string>, step string")
    got = J.procedure_steps(launches, steps).select("i", "step")
    assert dict(map(tuple, got.collect())) == {1: "b", 2: None, 3: "c", 4: "a", 5: None}
    assert "args" not in optimized(got).split("xxhash64(")[0]


def test_datasets_are_those_written(spark, tmp_path):
    name = F.udf(lambda: uuid.uuid4().hex).asNondeterministic()  # another one each time that a row is made
    rows = spark.range(3).select(F.col("id").cast("string").alias("record_id"), name().alias("dataset"))
    K.write_observations(rows, rows.limit(0), str(tmp_path / "o"))
    assert K.read_observations(spark, str(tmp_path / "o"), "shell_inputs").count() == 3 and K.finished(spark, str(tmp_path / "o")).count() == 3


def test_literals_fold_texts_once(spark):
    df = spark.createDataFrame([(1, "One TWO"), (2, "one two"), (3, None), (4, "three")], "i int, t string")
    rules = spark.createDataFrame([("Two", 1, "x")], "literal string, place int, value string")
    out = L.first_literal(df, rules, "t", "place", "value")
    assert {r.i: r.rule for r in out.collect()} == {1: "x", 2: "x", 3: None, 4: None} and "translate(" not in optimized(out)
