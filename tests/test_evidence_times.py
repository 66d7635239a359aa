"""Times as telemetry writes them, nested envelopes, lifetimes at their bounds, long lines of repeated names."""

import json
import random
import time

from pyspark.sql import functions as F

from vigil.functions import columns as C
from vigil.operators import evidence as E


def test_times_of_all_forms(spark):
    times = {
        "2024-01-02T03:04:05.123Z": "2024-01-02 03:04:05.123", "2024-01-02T03:04:05.1234567Z": "2024-01-02 03:04:05.123456", "2024-01-02T03:04:05.123456789+0100": "2024-01-02 02:04:05.123456",
        "2024-01-02T03:04:05+01:00": "2024-01-02 02:04:05", "2024-01-02 03:04:05.5": "2024-01-02 02:04:05.5", "2024-01-02 03:04:05,25 -0030": "2024-01-02 03:34:05.25", "02/01/2024 03:04:05.5": "2024-01-02 02:04:05.5",
        "1704164645": "2024-01-02 03:04:05", "1704164645.25": "2024-01-02 03:04:05.25", "1704164645250": "2024-01-02 03:04:05.25", "1704164645250.5": "2024-01-02 03:04:05.2505", "Tue, 2 Jan 2024 03:04:05 GMT": "2024-01-02 03:04:05",
        "20240102": None, "7": None, "17041646452": None, "2024-13-02T03:04:05": None, "2024-01-02": None, "": None, " ": None, None: None,
    }
    df = spark.createDataFrame([(x,) for x in times], "x string")
    got = {r.x: r.t for r in df.select("x", C.parse_time(F.col("x"), "Europe/Berlin").cast("string").alias("t")).collect()}
    assert got == times


def test_envelopes_inside_envelopes(spark):
    xml = "<EventData><Data Name='CommandLine'>a &amp;lt; b</Data><Data Name='Empty'/></EventData>"
    cases = [
        ({"EventData": {"ppid": "9"}, "process": {"parent": {"pid": 4}}}, {"ppid": "4"}),
        ({"data": {"process": {"command_line": "x", "parent": {"pid": 7}}}}, {"process.command_line": "x", "ppid": "7"}),
        ({"a": 1, "Event": {"a": 2, "event": {"b": 3}, "host": {"hostname": "h"}}}, {"a": "2", "b": "3", "host": "h"}),
        ({"EventData": json.dumps({"k": "v"}), "k": "old"}, {"k": "v"}),
        ({"EventData": xml.replace("<", "&lt;").replace(">", "&gt;")}, {"CommandLine": "a < b", "Empty": ""}),
        ({"SyslogMessage": "<Event><EventData><Data Name=\"Image\">c:\\x</Data><Data Name=\"Cut\">part"}, {"Image": "c:\\x"}),
        ({"_index": "i", "_id": "1", "_source": {"x": 1, "host": {"name": "n"}}}, {"_id": "i:1", "x": "1", "host": "n"}),
    ]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [(98, "[1]"), (99, None)], "i int, raw string").withColumn("_top", F.lit("old"))
    got = {r.i: r.fields for r in C.flatten_envelope(df.drop("_top"), "raw").collect()}
    for i, (_, want) in enumerate(cases):
        assert {k: got[i].get(k) for k in want} == want, i
    assert "Cut" not in got[5] and got[98] is None and got[99] is None


def test_the_last_of_many_names(spark):
    line = " ".join(f"k{i % 3000}={i}" for i in range(8000))
    df = spark.createDataFrame([(line,), ("",), (None,)], "x string")
    C.key_values(F.lit("a=1"))
    df.limit(1).select(C.key_values(F.col("x"))).collect()
    began = time.time()
    got = [r.m for r in df.select(C.key_values(F.col("x")).alias("m")).collect()]
    assert time.time() - began < 10 and len(got[0]) == 3000
    assert got[0]["k0"] == "6000" and got[0]["k1999"] == "7999" and got[0]["k2500"] == "5500" and got[1] == {} and got[2] is None


def test_hives_and_technique_ids(spark):
    keys = {"HKEY_LOCAL_MACHINE\\A": "hklm\\a", "HKLM:\\A\\b": "hklm\\a\\b", "HKEY_USERS:\\S-1": "hku\\s-1", "x\\HKEY_USERS": "x\\hkey_users", "": "", None: None}
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert {r.k: r.n for r in df.select("k", C.registry_key(F.col("k")).alias("n")).collect()} == keys
    ids = {"T1059.001, T1003. (T1105) xT1000 T12345 T1059.001 T1059.0011 _T1002 T1004.x": ["T1003", "T1059.001", "T1105"], "": [], None: None}
    df = spark.createDataFrame([(k,) for k in ids], "k string")
    assert {r.k: r.n for r in df.select("k", C.technique_ids(F.col("k")).alias("n")).collect()} == ids


def test_lives_at_their_bounds(spark):
    made = spark.createDataFrame([("h", "1", 10, "a"), ("h", "1", 20, "c"), ("h", "1", 20, "b"), ("h", None, 5, "n"), ("g", "1", 10, "z")], "host string, pid string, t bigint, who string")
    boots = spark.createDataFrame([("h", 10), ("h", 30), ("h", 30)], "host string, t bigint")
    seen = spark.createDataFrame([("h", "1", t) for t in (9, 10, 19, 20, 29, 30, 31)] + [("g", "1", 99), ("h", None, 7), ("x", "1", 10)], "host string, pid string, t bigint")
    got = {(r.host, r.pid, r.t): r.who for r in E.lifetime_owner(seen, made, boots, "host", "pid", "t", "who").collect()}
    assert got == {("h", "1", 9): None, ("h", "1", 10): "a", ("h", "1", 19): "a", ("h", "1", 20): "b", ("h", "1", 29): "b", ("h", "1", 30): None, ("h", "1", 31): None, ("g", "1", 99): "z", ("h", None, 7): "n", ("x", "1", 10): None}


def test_intervals_as_a_loop(spark):
    rnd = random.Random(3)
    made = [(rnd.choice("ab"), rnd.choice("12"), rnd.randint(0, 300)) for _ in range(60)]
    boots = [(rnd.choice("ab"), rnd.randint(0, 300)) for _ in range(8)]
    spans = [(i, rnd.choice("abc"), rnd.choice("12"), s := rnd.randint(0, 30) * 10, rnd.choice([None, s, s + 40, s - 1])) for i in range(50)]
    events = [(i, rnd.choice("abc"), rnd.choice("12"), rnd.randint(0, 320)) for i in range(200)]
    m, b = spark.createDataFrame(made, "host string, pid string, t bigint"), spark.createDataFrame(boots, "host string, t bigint")
    i = E.bounded_intervals(spark.createDataFrame(spans, "id int, host string, pid string, start bigint, until bigint"), m, b, "host", "pid", "start", "t", 10)
    got = {r.id: r.cutoff for r in i.collect()}
    for ident, h, p, s, _ in spans:
        later = sorted({t for x, y, t in made if (x, y) == (h, p) and t >= s})
        if later and later[0] < s + 10:
            later = later[1:]
        assert got[ident] == min(later + [t for x, t in boots if x == h and t > s], default=None)
    inside = {r.id: r.inside for r in E.in_intervals(spark.createDataFrame(events, "id int, host string, pid string, t bigint"), i, "host", "pid", "t", "start", "until").collect()}
    for ident, h, p, t in events:
        assert inside[ident] == any((x, y) == (h, p) and s <= t and (u is None or t <= u) and (got[k] is None or t < got[k]) for k, x, y, s, u in spans)
