"""Ordered rows of keys that lie over several ranges, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from vigil.operators import joins as J
from vigil.operators import processes as P
from vigil.operators.ordered import Ordered


@pytest.fixture(scope="module")
def hot():
    """(key, order, value): half of all rows have one key, and some have none."""
    rnd = random.Random(5)
    keys = ["hot"] * 300 + [None] * 60 + [f"k{i % 40}" for i in range(240)]
    return [(k, t, rnd.choice([None, None, None, rnd.randint(0, 9)])) for t, k in enumerate(rnd.sample(keys, len(keys)))]


def test_values_before_and_after(spark, hot):
    df = spark.createDataFrame(hot, "k string, t bigint, v bigint")
    rows = Ordered(df, ["k"], ["t"], parts=7)
    assert rows.split and rows.rows.groupBy("_range").count().count() > 3
    out = rows.rows
    for strict in (False, True):
        out = rows.last(out, F.col("v"), f"last{strict:d}", strict)
        out = rows.next(out, F.col("v"), f"next{strict:d}", strict)
        out = rows.total(out, F.col("v"), f"sum{strict:d}", strict)
    got = {r.t: r for r in rows.done(out).collect()}
    assert len(got) == len(hot) and set(rows.done(out).columns) == {"k", "t", "v", *(f"{n}{s}" for n in ("last", "next", "sum") for s in (0, 1))}
    for k, t, _ in hot:
        own = [(u, v) for x, u, v in hot if x == k]
        for strict in (0, 1):
            before = [v for u, v in own if (u < t or u == t and not strict) and v is not None]
            after = [v for u, v in own if (u > t or u == t and not strict) and v is not None]
            r = got[t]
            assert (r[f"last{strict}"], r[f"next{strict}"], r[f"sum{strict}"]) == (before[-1] if before else None, after[0] if after else None, sum(before)), (k, t, strict)


def test_one_key_in_all_ranges_and_none(spark):
    one = Ordered(spark.range(100).withColumn("k", F.lit(1)), ["k"], ["id"], parts=9)
    out = one.last(one.rows, F.when(F.col("id") == 3, F.col("id")), "three")
    out = one.total(out, F.lit(1), "n")
    assert {r.id: (r.three, r.n) for r in out.collect()} == {i: (3 if i >= 3 else None, i + 1) for i in range(100)}
    none = Ordered(spark.range(0).withColumn("k", F.lit(1)), ["k"], ["id"])
    assert none.last(none.rows, F.col("id"), "x").count() == 0


def test_asof_of_a_hot_key(spark, hot):
    df = spark.createDataFrame(hot, "k string, t bigint, v bigint")
    states = df.where("v is not null").select("k", "t", F.col("v").alias("state"))
    for strict in (True, False):
        got = {r.t: r.state for r in J.asof_last(df, states, "k", "t", ["state"], strict).collect()}
        for k, t, _ in hot:
            before = [v for x, u, v in hot if x == k and v is not None and (u < t or u == t and not strict)]
            assert got[t] == (before[-1] if before else None)


CALLS = [  # host, time, kind, protocol, session of the record
    ("a", 1, "output", "telnet", "idle:1"), ("a", 2, "input", "telnet", "idle:1"), ("a", 3, "login_ok", "telnet", "login:3"), ("a", 4, "login_ok", "telnet", "login:3"),
    ("a", 20, "input", "telnet", "idle:20"), ("a", 21, "connect", "telnet", "connect:21"), ("a", 99, "failed", "telnet", "connect:21"), ("a", 100, "login_ok", "telnet", "login:100"),
    ("a", 101, "close", "telnet", "login:100"), ("a", 102, "close", "telnet", None), ("a", None, "input", "telnet", "record:0"),
    ("b", 1, "login_ok", "ssh", None), ("b", 2, "connect", "ssh", "connect:2"), ("b", 3, "login_ok", "ssh", "connect:2"), ("b", 90, "input", "ssh", "connect:2"), ("b", 91, "close", "ssh", "connect:2"),
    ("b", 92, "login_bad", "ssh", None), ("b", 93, "input", "ssh", "idle:93"), ("b", 95, None, "ssh", "idle:93"), ("b", 96, "login_ok", None, "idle:93"), ("b", 200, "input", None, "idle:200"),
]


def test_connections(spark):
    for parts in ("1", "6"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            df = spark.createDataFrame([(h, t, k, p, t or 0, s) for h, t, k, p, s in CALLS], "host string, t bigint, kind string, protocol string, id bigint, want string")
            got = P.connection_sessions(df, ["host"], ["t"], "t", "kind", "protocol", "id", 10)
            assert [r for r in got.collect() if r.want != r.session_id] == [] and got.count() == len(CALLS)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert P.connection_sessions(df.limit(0), ["host"], ["t"], "t", "kind", "protocol", "id", 10).collect() == []
