"""Process sessions: what is settled at once is not joined, and what points to parents is."""

from pyspark.sql import functions as F

from vigil.operators import processes as P

KIND = "host string, at int, event string, pid string, parent string, login string, action string, child string, note string"


def test_rows_without_parents_ask_no_parent(spark, monkeypatch):
    def never(*args, **kwargs):
        raise AssertionError("all rows were put in order again for no question")

    monkeypatch.setattr(P, "asof_last", never)
    rows = [("h", 1, "1", "a", "", None, None, None, "x"), ("h", 2, "2", "a", None, "me", None, None, None), ("h", 3, "3", "a", None, None, "exit", None, "y"), ("h", 4, "4", "a", None, "", None, None, "z"), (None, 5, "5", "a", None, None, None, None, "w"), ("h", 6, "6", "", None, None, None, None, "v"), ("h", 7, "7", None, "a", "you", None, None, "u")]
    df = spark.createDataFrame(rows, KIND)
    got = P.lifetime_sessions(df.withColumn("session", F.lit(1)).select("session", *df.columns), ["host"], ["at"])
    assert got.columns == [*df.columns, "session"]
    want = ["process:a:1", "login:me", "login:me", "process:a:4", "process:a:5", "event:6", "login:you"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [(*r, s) for r, s in zip(rows, want)]


def test_lives_that_point_to_settled_and_open_ones(spark):
    # a: no parent, no login; b below a; c: login; d below c; e below d; f forked by d; g forked by a; d again behind its exit
    rows = [(1, "a", None, None, None, None), (2, "b", "a", None, None, None), (3, "c", None, "me", None, None), (4, "d", "c", None, None, None), (5, "e", "d", None, None, None), (6, "d", None, None, "fork", "f"), (7, "f", None, None, None, None), (8, "a", None, None, "fork", "g"), (9, "g", None, None, None, None), (10, "d", None, None, "exit", None), (11, "d", "c", None, None, None), (12, "x", "d", None, None, None), (13, "y", "nobody", None, None, None)]
    df = spark.createDataFrame([("h", i, str(i), *r, "n") for i, *r in rows], KIND).repartition(3)
    got = {r.at: r.session for r in P.lifetime_sessions(df, ["host"], ["at"]).collect()}
    me = "login:me"
    assert got == {1: "process:a:1", 2: "process:b:2", 3: me, 4: me, 5: me, 6: me, 7: me, 8: "process:a:1", 9: "process:g:8", 10: me, 11: me, 12: me, 13: "process:y:13"}
