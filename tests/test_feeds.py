"""Readers, sinks, streams and process evidence: odd lines, nulls, ties, empty tables, repeated runs."""

import pytest
from pyspark.sql import functions as F

from vigil.functions import columns as C
from vigil.operators import evidence as E
from vigil.operators import selection as S
from vigil.plans import catalog, checked, feeds  # noqa: F401
from vigil.sources import readers as R
from vigil.sources import sinks as K
from vigil.streaming import jobs as J

from .test_catalog import SF, duck, plain  # noqa: F401

NAMES = ["scan_tagged_union", "xml_named_fields", "scan_map_of_lists", "scan_nested_list", "csv_sections", "concatenated_json", "ingest_ledger", "rendered_records", "format_dispatch", "sourcetype_dispatch", "rotation_order", "copy_text_rows", "write_observations", "stream_dedup", "stream_sessions", "stream_daily_counts", "pid_lifetime_join", "bounded_lifetimes", "interval_labels", "object_relation_join", "event_assembly", "capped_extraction", "fill_templates", "score_samples"]


@pytest.mark.parametrize("name", NAMES)
def test_as_duckdb(spark, duck, name):  # noqa: F811
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    names = ", ".join(f'"{c}"' for c in columns)
    want = duck.execute(f"SELECT {names} FROM ({catalog.SQL[name]})").fetchall()
    assert sorted((tuple(map(plain, r)) for r in got.select(*columns).collect()), key=str) == sorted((tuple(map(plain, r)) for r in want), key=str)


def test_key_values_last_wins(spark):
    rows = spark.createDataFrame([("a=1 b=\"x y\" a=2",), ("",), (None,)], "line string").select(C.key_values(F.col("line")).alias("m")).collect()
    assert [r.m for r in rows] == [{"a": "2", "b": "x y"}, {}, None]


def test_csv_sections_quotes_headers_and_reasons(spark):
    lines = spark.createDataFrame([("f", 0, "1,2"), ("f", 1, "a,b"), ("f", 2, '"1,x","say ""hi"""'), ("f", 3, "1"), ("f", 4, '"b",a'), ("f", 5, "3,"), ("f", 6, '"3,4'), ("g", 0, None)], "f string, n int, s string")
    got = R.csv_sections(lines, "f", "n", "s", F.coalesce(F.col("s").rlike('^"?[a-z]"?,'), F.lit(False))).collect()
    want = [(0, None, "no header"), (2, {"a": "1,x", "b": 'say "hi"'}, None), (3, None, "other number of fields"), (5, {"b": "3", "a": ""}, None), (6, None, "open quotes")]
    assert sorted((r.n, r.fields, r.reason) for r in got) == want


def test_by_shape_of_lines_and_of_files(spark):
    lines = spark.createDataFrame([("f", 0, " "), ("f", 1, "a,b"), ("f", 2, "k=1"), ("g", 0, "k=2"), (None, 5, "k=3"), ("h", 0, None), ("i", 0, "?")], "file string, n int, s string")
    shapes = [("kv", "^k=", {"v": F.substring("s", 3, 9)}), ("csv", ",|=", {"v": F.col("s"), "w": F.lit(1)})]
    by_line, by_file = (sorted((r.shape, r.v, r.w) for r in R.by_shape(lines, "s", shapes, *of).select("shape", "v", F.coalesce("w", F.lit(0)).alias("w")).collect()) for of in ((), ("file", "n")))
    assert by_line == [("csv", "a,b", 1), ("kv", "1", 0), ("kv", "2", 0), ("kv", "3", 0)]
    assert by_file == [("csv", " ", 1), ("csv", "a,b", 1), ("csv", "k=1", 1), ("kv", "2", 0), ("kv", "3", 0)]
    assert R.by_shape(lines.limit(0), "s", shapes, "file", "n").collect() == []


def test_oldest_first(spark):
    rows = [("x", "a.log", 1), ("x", "a.log.10", 5), ("x", "a.log.2", 3), ("x", "a.log.2", 4), ("x", None, 2), (None, "a.log", 7), (None, "a.log.1", 8)]
    got = R.oldest_first(spark.createDataFrame(rows, "log string, file string, line int"), "log", "file", "line").collect()
    assert {r.line: r.place for r in got} == {5: 1, 3: 2, 4: 3, 1: 4, 2: 5, 8: 1, 7: 2}


def test_numbered_along_ranges(spark):
    df = spark.createDataFrame([(i * 7919 % 1009,) for i in range(1, 1009)] + [(None,)], "v int").repartition(7)
    got = sorted((r.i, -1 if r.v is None else r.v) for r in S.numbered(df, "v", "i").collect())
    assert got == [(0, -1)] + [(i, i) for i in range(1, 1009)]
    assert S.numbered(df.limit(0), "v", "i").collect() == []


def test_joined_objects_with_braces_in_strings(spark):
    raw = [r'{"cmd": "a} {b\"} {c"}{"cmd": "x"}' + "\n" + '{"cmd": ""}', '{"cmd": "open', "", None]
    df = spark.createDataFrame(list(enumerate(raw)), "id int, raw string")
    got = sorted((r.id, r.pos, r.cmd or "") for r in R.joined_objects(df, "raw", "cmd string").collect() if r.id == 0)
    assert got == [(0, 0, 'a} {b"} {c'), (0, 1, "x"), (0, 2, "")]


def test_framed_records_repeated_names(spark):
    lines = spark.createDataFrame([("f", 0, "lost"), ("f", 1, "=== 1"), ("f", 2, "A: x"), ("f", 3, "A: y"), ("f", 4, "=== 2")], "f string, n int, s string")
    got = {r.head: r.fields for r in R.framed_records(lines, "f", "n", "s", "^===").collect()}
    assert got == {"=== 1": {"A": "y"}, "=== 2": {}}


def test_copy_text_width_null_and_escapes(spark, tmp_path):
    path = str(tmp_path / "copy")
    spark.createDataFrame([("1\t\\N",), ("2\ta\\\\n\\tb",), ("3",)], "value string").write.text(path)
    got = sorted((tuple(r) for r in R.copy_text(spark, path, ["id", "v"]).collect()), key=str)
    assert got == [("1", None, True), ("2", "a\\n\tb", True), (None, None, False)]


def test_json_lines_prefilter_and_projection(spark, tmp_path):
    path = str(tmp_path / "json")
    spark.createDataFrame([('{"a": 1, "t": "x"}',), ('{"a": 2, "t": "y"}',), ("x no json",)], "value string").write.text(path)
    assert [r.a for r in R.json_lines(spark, path, "a int, t string", '"x"').collect()] == [1]
    got = R.projected(spark.createDataFrame([(1, "u")], "A int, b string"), "a bigint, c string")
    assert got.dtypes == [("a", "bigint"), ("c", "string")] and tuple(got.first()) == (1, None)


def test_ledger_runs_and_removal(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.createDataFrame([("d", "1"), ("e", "2"), ("a/b", "3")], "dataset string, record_id string")
    wanted = spark.createDataFrame([("d",), ("z",)], "dataset string")
    read = lambda name="shell_inputs": sorted((r.dataset, r.record_id) for r in K.read_observations(spark, root, name).collect())
    assert K.pending(wanted, spark, root).count() == 2  # before there is a ledger
    K.write_observations(rows, rows, root)
    d = rows.where("dataset = 'd'")
    K.write_observations(d.withColumn("record_id", F.lit("9")), d.limit(0), root)
    assert read() == [("a/b", "3"), ("d", "9"), ("e", "2")] and read("process_launches") == [("a/b", "3"), ("e", "2")]
    # a job that dies before the ledger is written changes nothing for readers
    d.withColumns({"run": F.lit("dead"), "part": F.lit("d:d")}).write.mode("append").partitionBy("run", "part").parquet(f"{root}/shell_inputs")
    assert read() == [("a/b", "3"), ("d", "9"), ("e", "2")]
    assert [r.dataset for r in K.pending(wanted, spark, root).collect()] == ["z"]
    K.remove_stored(spark, root, "d", "a/b", "unknown")
    assert read() == [("e", "2")] and K.pending(wanted, spark, root).count() == 2
    assert spark.read.parquet(f"{root}/shell_inputs").where("dataset in ('d', 'a/b')").count() == 0
    K.write_observations(d, d, root)
    assert read() == [("d", "1"), ("e", "2")]
    # a bounded run is read, and its dataset stays pending until a complete one
    K.write_observations(d.withColumn("record_id", F.lit("5")), d, root, complete=False)
    assert read() == [("d", "5"), ("e", "2")] and sorted(r.dataset for r in K.pending(wanted, spark, root).collect()) == ["d", "z"]
    K.write_observations(d, d, root)
    assert read() == [("d", "1"), ("e", "2")] and [r.dataset for r in K.pending(wanted, spark, root).collect()] == ["z"]
    left = K.remove_datasets({"a": rows, "b": wanted.withColumnRenamed("dataset", "x")}, "d")
    assert left["a"].count() == 2 and left["b"].count() == 2


def test_names_that_look_like_other_things(spark, tmp_path):
    root = str(tmp_path / "out")
    assert K.read_observations(spark, root, "shell_inputs").count() == 0 and "shell_input" in K.read_observations(spark, root, "shell_inputs").columns
    names = ["007", "7", "010", "1e5", "2024-01-02", "true", "", " ", "a/b", "x=y%2F", "__HIVE_DEFAULT_PARTITION__", "null", None]
    rows = spark.createDataFrame([(n, str(i)) for i, n in enumerate(names)], "dataset string, record_id string")
    K.write_observations(rows, rows.limit(0), root)
    read = lambda: sorted((str(r.dataset), r.dataset is None, r.record_id) for r in K.read_observations(spark, root, "shell_inputs").collect())
    assert read() == sorted((str(n), n is None, str(i)) for i, n in enumerate(names))
    assert K.pending(rows, spark, root).count() == 0
    K.remove_stored(spark, root, "007", None)
    assert read() == sorted((str(n), n is None, str(i)) for i, n in enumerate(names) if n not in ("007", None))
    assert sorted((r.dataset or "-") for r in K.pending(rows, spark, root).collect()) == ["-", "007"]


def test_collect_results(spark):
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id int")
    said = spark.createDataFrame([(1, "benign"), (2, "what"), (3, "benign"), (3, "benign"), (9, "benign")], "id int, v string")
    got = {r.id: (r.status, r.v) for r in K.collect_results(asked, said, "id", "v", ("benign",)).collect()}
    assert got == {1: ("ok", "benign"), 2: ("invalid", None), 3: ("repeated", None), 4: ("missing", None)}


def test_stream_continues_where_it_stopped(spark, tmp_path):
    src, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    rows.write.parquet(src)
    job = lambda: J.run_append(J.first_seen(J.file_stream(spark, src, rows.schema), ["k"]), out, log)
    assert job().count() == 2 and job().count() == 2
    spark.createDataFrame([(2, "b"), (3, "c")], rows.schema).write.mode("append").parquet(src)
    assert sorted(r.k for r in job().collect()) == [1, 2, 3]


def test_lifetimes_end_at_reboots(spark):
    made = spark.createDataFrame([("h", 1, 10, "a"), ("h", 1, 20, "b")], "host string, pid int, t bigint, who string")
    boots = spark.createDataFrame([("h", 30)], "host string, t bigint")
    seen = spark.createDataFrame([("h", 1, t) for t in (5, 15, 25, 35)] + [("g", 1, 15)], "host string, pid int, t bigint")
    got = sorted((r.host, r.t, r.who) for r in E.lifetime_owner(seen, made, boots, "host", "pid", "t", "who").collect())
    assert got == [("g", 15, None), ("h", 5, None), ("h", 15, "a"), ("h", 25, "b"), ("h", 35, None)]


def test_templates_without_pool(spark):
    rows = spark.createDataFrame([(1, "x <a> <b>"), (2, None), (3, "")], "id int, text string")
    pool = spark.createDataFrame([("a", "v"), ("a", "v"), ("a", None)], "name string, value string")
    got = {r.id: r.filled for r in E.fill_templates(rows, pool, "id", "text", "s").collect()}
    assert got == {1: "x v <b>", 2: None, 3: ""}


def test_registry(spark):
    r = R.Registry()
    r.register("one")(lambda s, folder: s.range(2))
    with pytest.raises(ValueError):
        r.register("one")(lambda s, folder: s.range(1))
    assert sorted((x.id, x.dataset) for x in r.read(spark, "").collect()) == [(0, "one"), (1, "one")]


def test_unions_and_attributes_of_odd_lines(spark, tmp_path):
    path = str(tmp_path / "union")
    spark.createDataFrame([('{"A": {"id": 1}}',), ('{"C": {"id": 2}}',), ("broken",), ('{"B": {"id": 3, "v": "x"}}',)], "value string").write.text(path)
    got = sorted(tuple(r) for r in R.tagged_union(spark, path, {"A": "id int", "B": "id int, v string"}).collect())
    assert got == [("A", 1, None), ("B", 3, "x")]
    pages = spark.createDataFrame([(1, '<a x="1" y=""><b z='), (2, None), (3, "")], "id int, html string")
    assert sorted(tuple(r) for r in R.named_attributes(pages, "html").collect()) == [(1, 0, "x", "1"), (1, 1, "y", "")]
