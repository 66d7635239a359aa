"""Sessions with logins, contracts, indicators, ladders and names: queries as DuckDB gives them, and odd rows."""

import pytest
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions import columns as C
from vigil.operators import joins as J
from vigil.operators import literals as L
from vigil.operators import processes as P
from vigil.operators import selection as S
from vigil.plans import catalog, checked  # noqa: F401

from .test_catalog import SF, duck, plain  # noqa: F401

NAMES = ["connection_sessions", "sample_ids", "download_then_run", "row_contracts", "audit_decisions", "remove_stored", "ioc_upgrade", "procedure_steps", "evidence_ladder", "flatten_envelope", "names_and_paths", "request_chunks", "request_files", "stored_names", "literal_rules", "parse_times"]


@pytest.mark.parametrize("name", NAMES)
def test_as_duckdb(spark, duck, name):  # noqa: F811
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    names = ", ".join(f'"{c}"' for c in columns)
    want = duck.execute(f"SELECT {names} FROM ({catalog.SQL[name]})").fetchall()
    assert sorted((tuple(map(plain, r)) for r in got.select(*columns).collect()), key=str) == sorted((tuple(map(plain, r)) for r in want), key=str)


def test_connection_sessions_timeline(spark):
    e = [
        ("a", 1, 0, "login_ok", "telnet"), ("a", 2, 10, "input", "telnet"), ("a", 3, 20, "login_ok", "telnet"), ("a", 4, 99, "output", "telnet"), ("a", 5, 100, "close", "telnet"), ("a", 6, 101, "close", "telnet"),
        ("b", 1, 0, "login_ok", "ssh"), ("b", 2, 1, "connect", "ssh"), ("b", 3, 500, "login_ok", "ssh"), ("b", 4, 900, "input", "ssh"), ("b", 5, 901, "close", "ssh"), ("b", 6, 902, "input", "ssh"), ("b", 7, None, "input", "ssh"), (None, 1, 3, None, None),
    ]
    df = spark.createDataFrame(e, "h string, id int, t int, kind string, protocol string").repartition(3)
    got = {(r.h, r.id): r.session_id for r in P.connection_sessions(df, ["h"], ["t", "id"], "t", "kind", "protocol", "id", 60).collect()}
    assert [got["a", i] for i in range(1, 7)] == ["login:1", "login:1", "login:3", "idle:4", "idle:4", None]
    assert [got["b", i] for i in range(1, 8)] == [None, "connect:2", "connect:2", "connect:2", "connect:2", "idle:6", "record:7"] and got[None, 1] == "idle:1"
    assert P.connection_sessions(df.limit(0), ["h"], ["t", "id"], "t", "kind", "protocol", "id", 60).count() == 0


def test_downloads_of_odd_forms(spark):
    c = [("wget", ["http://h/d/run.sh?x=1"]), ("./run.sh", []), ("wget", ["http://h/"]), ("", []), ("curl", ["-o"]), ("sh", ["x"]), ("CURL", ["--output", "x", "http://h"]), ("bash", ["x", "y"]), (None, None), ("curl", ["-o", "z", "http://h"]), ("/bin/dash", ["./z"])]
    df = spark.createDataFrame([(1, i, p, a) for i, (p, a) in enumerate(c)], "input int, i int, pgm string, args array<string>")
    got = [r.downloaded_and_run for r in P.downloads_run(df, ["input"], "i", "pgm", "args").orderBy("i").collect()]
    assert got == [True, True] + [False] * 7 + [True, True]


def test_dense_ids_with_null_strata(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("b", 1), ("a", 1), ("a", 2)], "s string, place int")
    assert sorted((r.sample_id, r.s, r.place) for r in S.dense_ids(df, ["s"]).collect()) == [(1, None, 1), (2, None, 2), (3, "a", 1), (4, "a", 2), (5, "b", 1)]


def test_contracts_nulls_and_strict(spark):
    good = ("p", "d", "r", "malicious-group", "g", "s", "linux", None, None, "unknown")
    bad = [(*good[:2], None, *good[3:]), (*good[:3], None, *good[4:]), (*good[:4], None, *good[5:]), ("", *good[1:]), (*good[:9], "odd")]
    df = spark.createDataFrame([good, *bad], "pgm string, dataset string, record_id string, dataset_label string, group_id string, session_id string, os string, ai_label string, override_label string, label string")
    reason = schemas.breach("pgm")
    assert [r[0] for r in df.select(reason).collect()] == [None, "no record_id", "dataset_label not allowed", "no group_id", "no pgm", "label not allowed"]
    kept, audit = schemas.audited(df, reason)
    assert kept.count() == 1 and audit.where("action = 'skipped' and reason is not null").count() == 5
    with pytest.raises(Exception, match="no record_id|no pgm|not allowed|no group_id"):
        schemas.strict(df, reason).collect()
    assert schemas.strict(df.limit(1), reason).count() == 1


def test_indicators_follow_their_group(spark):
    df = spark.createDataFrame([(1, "run EVIL.exe", "unknown"), (1, "ls", "unknown"), (1, "cd", "benign"), (2, "ls", "unknown"), (None, "evil.exe", "unknown"), (None, None, "unknown")], "g int, text string, label string")
    ioc = spark.createDataFrame([("evil.exe",), ("",), (None,)], "indicator string")
    got = sorted((str(r.g), r.text or "", r.label) for r in L.indicator_upgrade(df, ioc, "text", "g").collect())
    assert got == sorted([("1", "run EVIL.exe", "malicious"), ("1", "ls", "malicious"), ("1", "cd", "benign"), ("2", "ls", "unknown"), ("None", "evil.exe", "malicious"), ("None", "", "unknown")])
    assert L.indicator_upgrade(df, ioc.limit(0), "text").where("label = 'malicious'").count() == 0


def test_spans_merge(spark):
    spans = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 5, 9), ("a", 20, 21), ("a", 9, 8), ("b", 0, 0)], "h string, start_t int, end_t int")
    assert sorted(map(tuple, J.merged_spans(spans, "h").collect())) == [("a", 1, 9), ("a", 20, 21), ("b", 0, 0)]


def test_names_of_odd_forms(spark):
    paths = {"": ".", "C:\\": "c:\\", "a/../..": "..", "\\\\Srv\\X\\..": "\\\\srv", "C:\\..\\a": "c:\\a", "x/./y//": "x\\y", None: None}
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r.p: r.n for r in df.select("p", C.normal_path(F.col("p")).alias("n")).collect()} == paths
    times = {"Mon, 5 Jan 2026 10:00:00 GMT": "2026-01-05 10:00:00", "05 Jan 2026 10:00:00 +0200": "2026-01-05 08:00:00", "2026-01-05T10:00:00+01:00": "2026-01-05 09:00:00", "2026-01-05 10:00:00": "2026-01-05 09:00:00", "1767607200": "2026-01-05 10:00:00", "nothing": None, None: None}
    df = spark.createDataFrame([(x,) for x in times], "x string")
    assert {r.x: r.t for r in df.select("x", C.parse_time(F.col("x"), "Europe/Berlin").cast("string").alias("t")).collect()} == times
    odd = spark.createDataFrame([('{"a": 1, "data": {"a": 2}, "event": "plain"}',), ("[1]",), ("no",), (None,)], "x string")
    assert [r.fields for r in C.flatten_envelope(odd, "x").collect()] == [{"a": "2", "data": '{"a":2}', "event": "plain"}, None, None, None]
