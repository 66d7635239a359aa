"""Queries against DuckDB on the smallest tables, and hand-made timelines of the joins."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from vigil.operators import joins as J
from vigil.operators import selection as S
from vigil.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f).split('.')[0]} AS SELECT * FROM '{f}'")
    return c


def plain(x):
    return round(x, 9) if isinstance(x, float) else x


@pytest.mark.parametrize("name", ["launch_counts", "apply_labels", "window_range_join", "shortest_window_join", "nearest_time_join", "boot_epoch_asof", "latest_state_asof", "confusion_matrix", "disagreements", "idle_sessions", "stratified_sample", "table_diff"])
def test_as_duckdb(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    names = ", ".join(f'"{c}"' for c in columns)
    want = duck.execute(f"SELECT {names} FROM ({catalog.SQL[name]})").fetchall()
    assert sorted((tuple(map(plain, r)) for r in got.select(*columns).collect()), key=str) == sorted((tuple(map(plain, r)) for r in want), key=str)


def test_every_query_has_sql():
    assert set(catalog.SQL) == set(catalog.QUERIES)


def test_tree_root_ambiguous_and_cyclic(spark):
    edges = [("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("e", "x"), ("p", "q"), ("q", "p"), ("s", "s")]
    df = spark.createDataFrame(edges, "node string, parent string")
    got = dict(map(tuple, J.tree_root(df, spark.createDataFrame([("a",)], "node string")).collect()))
    assert got == {"b": "b", "c": "b", "d": "b", "p": None, "q": None}


def test_nearest_time_prefers_the_earlier(spark):
    events = spark.createDataFrame([(1, "h", 10), (2, "h", 15), (3, "g", 1), (4, "h", 99)], "id int, host string, t bigint")
    states = spark.createDataFrame([("h", 8, "a"), ("h", 12, "b"), ("h", 18, "c")], "host string, t bigint, v string")
    got = {r.id: r.v for r in J.nearest_time(events, states, "host", "t", "v").collect()}
    assert got == {1: "a", 2: "b", 3: None, 4: "c"}


def test_best_window_takes_direct_evidence_first(spark):
    hits = [(1, 0, 5, 10, False), (1, 0, 9, 11, True), (1, 0, 9, 12, True), (2, 0, 9, 13, False), (2, 3, 5, 14, None), (2, 4, 6, 12, False), (2, 4, 6, 12, False)]
    df = spark.createDataFrame(hits, "e int, a int, b int, w int, d boolean")
    assert {r.e: r.w for r in J.best_window(df, "e", "a", "b", "w", F.col("d")).collect()} == {1: 11, 2: 12}


def test_range_join_buckets_change_nothing(spark):
    e = spark.createDataFrame([(i, i % 3, i * 7 % 100) for i in range(60)], "id int, k int, t bigint")
    w = spark.createDataFrame([(n, n % 3, n * 5, n * 5 + n % 20) for n in range(20)], "w int, k int, a bigint, b bigint")
    one, two = (sorted(map(tuple, J.range_join(e, w, "k", e["t"] if b is None else e["t"], w["a"], w["b"], bucket=b).select("id", "w").collect())) for b in (None, 10))
    assert one == two and one


def test_continuations(spark):
    lines = spark.createDataFrame([("s", 0, "a \\"), ("s", 1, "b"), ("s", 2, "c \\\\"), ("s", 3, "d")], "s string, i int, line string")
    assert sorted(map(tuple, S.joined_continuations(lines, "s", "i", "line").collect())) == [("s", 0, "a \\\nb"), ("s", 2, "c \\\\"), ("s", 3, "d")]


def test_lifetime_evidence_keeps_all_times(spark, duck):
    got = catalog.QUERIES["lifetime_evidence"](spark, SF)
    want = duck.execute(f"SELECT host, pid, t, what FROM ({catalog.SQL['lifetime_evidence']})").fetchall()
    assert want and sorted(map(tuple, got.select("host", "pid", "t", "what").collect()), key=str) == sorted(want, key=str)
    assert "collect_" not in got._jdf.queryExecution().toString()


def test_descendants_of_long_chains_cycles_and_many_parents(spark):
    n = 5000
    chain = [(i, i - 1, i) for i in range(1, n)] + [(n + 1, n + 2, 5), (n + 2, n + 1, 5), (n + 3, 10, 3), (n + 4, n + 3, 50)]
    edges = spark.createDataFrame(chain, "node bigint, parent bigint, t bigint")
    got = {r.node for r in J.descendants(edges, spark.createDataFrame([(7, 7)], "node bigint, t bigint")).collect()}
    assert got == set(range(7, n))  # the last two came before their parent or from one that did not
    twice = spark.createDataFrame([("b", "a", 1), ("b", "x", 2), ("c", "b", 1), ("d", "c", 0), ("a", "c", 9)], "node string, parent string, t bigint")
    assert {r.node for r in J.descendants(twice, spark.createDataFrame([("a", 1)], "node string, t bigint")).collect()} == {"a", "b", "c"}


def test_descendants_of_a_chain_with_side_parents(spark, monkeypatch):
    n = 3000
    chain = [(i, i - 1, i) for i in range(1, n)] + [(i, 100_000 + i, i) for i in range(1, n)]
    edges = spark.createDataFrame(chain, "node bigint, parent bigint, t bigint")
    rounds, cut = [], J.cut
    monkeypatch.setattr(J, "cut", lambda df: rounds.append(1) or cut(df))
    seeds = spark.createDataFrame([(7, 7), (100_000 + 3, 9)], "node bigint, t bigint")
    monkeypatch.setattr(J, "BLOCK_EDGES", 2000)
    assert {r.node for r in J.descendants(edges, seeds).collect()} == {100_003, *range(7, n)}
    assert len(rounds) < 30  # a round for each block that the chain crosses
    rnd = random.Random(3)
    graph = [(rnd.randint(0, 60), rnd.randint(0, 60), rnd.randint(0, 20)) for _ in range(150)]
    monkeypatch.setattr(J, "BLOCK_EDGES", 40)
    got = {r.node for r in J.descendants(spark.createDataFrame(graph, "node bigint, parent bigint, t bigint"), spark.createDataFrame([(1, 2), (2, 5)], "node bigint, t bigint")).collect()}
    best, more = {1: 2, 2: 5}, True
    while more:
        more = False
        for node, parent, t in graph:
            if parent in best and t >= best[parent] and t < best.get(node, 99):
                best[node], more = t, True
    assert got == set(best)


def test_nearest_time_of_a_hot_host(spark):
    n = 20_000
    events = spark.range(n).selectExpr("id", "'h' as host", "id * 2 as t")
    states = spark.range(n // 10).selectExpr("'h' as host", "id * 20 as t", "id as v")
    got = J.nearest_time(events, states, "host", "t", "v")
    assert got.where("v <> least((t + 9) div 20, 1999)").count() == 0 and got.count() == n
    assert "unboundedfollowing" not in got._jdf.queryExecution().toString().lower()


def test_chunks_keep_both_bounds(spark):
    sizes = [570] + [1] * 199 + [60, 60, None, 101, 40]
    df = spark.createDataFrame([("d", i, s) for i, s in enumerate(sizes)], "k string, i int, size int")
    got = sorted(S.running_chunks(df, "k", ["i"], F.col("size"), 50, 100).collect(), key=lambda r: r.i)
    chunk, rows, used, want = 0, 0, 0, []
    for s in sizes:
        s = s or 0
        if s > 100:
            want.append(None)
            continue
        if rows and (rows == 50 or used + s > 100):
            chunk, rows, used = chunk + 1, 0, 0
        want.append((chunk, rows))
        rows, used = rows + 1, used + s
    assert [None if r.chunk is None else (r.chunk, r.position) for r in got] == want and want[0] is None


def test_rules_fit_whole_texts_of_any_letters(spark):
    texts = {"laß": "benign", "la": "benign", "la é": "benign", "la_": None, "Ab!!\r": None, "Ab\r!!": "malicious", "x |": "unknown", "x|\n": None, "a|\x85": "unknown", None: None}
    rows = spark.createDataFrame([(x,) for x in texts], "pgm string")
    assert {r.pgm: r.rule_label for r in J.first_rule(rows, catalog._RULES, "pgm").collect()} == texts
