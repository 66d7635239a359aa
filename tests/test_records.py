"""Texts that hold commands, and work with a state: against DuckDB, and odd inputs."""

import random

import pytest
from pyspark.sql import functions as F

from vigil.functions import columns as C
from vigil.functions import shell as H
from vigil.operators import audit as A
from vigil.operators import processes as P
from vigil.plans import catalog, records  # noqa: F401
from vigil.sources import documents as D
from vigil.sources import readers as R
from vigil.streaming import jobs as J
from vigil.streaming import stateful as T

from .test_catalog import SF, duck, plain  # noqa: F401

NAMES = ["config_windows", "doc_example_blocks", "doc_submissions", "narrative_events", "prompt_commands", "sequence_snippets", "join_continuations", "near_duplicate_merge", "lifetime_sessions", "stream_lifetimes", "stream_event_assembly", "reviewed_merge", "xml_events", "audit_commands", "argv_split", "shell_invocations", "decode_base64", "program_rules", "tag_defaults"]


@pytest.mark.parametrize("name", NAMES)
def test_as_duckdb(spark, duck, name):  # noqa: F811
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    names = ", ".join(f'"{c}"' for c in columns)
    want = duck.execute(f"SELECT {names} FROM ({catalog.SQL[name]})").fetchall()
    assert sorted((tuple(map(plain, r)) for r in got.select(*columns).collect()), key=str) == sorted((tuple(map(plain, r)) for r in want), key=str)


@pytest.fixture
def texts(spark):
    return lambda *t: spark.createDataFrame(list(enumerate(t)), "id int, text string")


READERS = [lambda d: D.attack_windows(d, "text"), lambda d: D.example_blocks(d, "id", "text"), lambda d: D.submissions(d, ["id"], "text"), lambda d: D.narrative_events(d, "id", "text"), lambda d: D.prompt_commands(d, "id", "text"), lambda d: D.sequence_snippets(d, "id", "text")]


@pytest.mark.parametrize("read", READERS)
def test_nothing_gives_no_row(texts, spark, read):
    assert read(texts(None, "", "\n \n")).collect() == []
    assert read(spark.createDataFrame([], "id int, text string")).collect() == []


def test_windows_of_other_forms(texts):
    got = D.attack_windows(texts("[occurTime]\n01/02/2024 03:04:05\nsoon\n[PName]\n", "[occurTime]\n01/02/2024 03:04:05\n[PName]\na", "[PName][PName]"), "text").collect()
    assert [(r.id, str(r.begin), r.finish, r.programs) for r in got] == [(0, "2024-01-02 03:04:05", None, [])]


def test_fences_and_headings(texts):
    md = "```\nno\n```\n# Example one\n```\n# not a heading\n```\n## Part\n~~~sh\nb\n```\n~~~~\n# Other\n```\nno\n```\n## examples\n```\n```\n```\nnever ends\n# Example"
    got = D.example_blocks(texts(md), "id", "text").collect()
    assert sorted((r.number, r.language, r.code) for r in got) == [(2, "", "# not a heading"), (3, "sh", "b\n```"), (5, "", "")]


def test_long_blocks(texts):
    got = D.example_blocks(texts("# Examples\n```\n" + "x y\n" * 200_000 + "```"), "id", "text").first()
    assert len(got.code) == 800_000 - 1


def test_submissions_without_prompts_and_quoted_prompts(texts):
    got = D.submissions(texts("\n a\n>> b\n", "$x = @'\nPS> no\n'@", "PS> \nafter\nPS> dir"), ["id"], "text").collect()
    assert sorted((r.id, r.occurrence, r.input) for r in got) == [(0, 1, "a\nb"), (1, 1, "$x = @'\nPS> no\n'@"), (2, 1, "dir")]


def test_prompts_of_shells(texts):
    blocks = ["[srv]: PS C:\\x> a\nout\n[PS] C:\\> b\nC:\\Users> c ^\nd\nout", "me@box:~/x$ ls |\nwc\nout\nroot@box:/# id", "PC /> show\nPS>> nested (\n1)\nout", "no@prompt: $5\nPSX> no\n$ x"]
    got = {}
    for r in D.submissions(texts(*blocks), ["id"], "text").orderBy("id", "occurrence").collect():
        got.setdefault(r.id, []).append(r.input)
    assert got == {0: ["a", "b", "c ^\nd"], 1: ["ls |\nwc", "id"], 2: ["show", "nested (\n1)"], 3: [blocks[3]]}


def test_what_a_line_leaves_open(texts):
    lines = {"f (": (1, 0, False), "f '(' {": (0, 1, False), 'f "`"(" )': (-1, 0, False), "a # (": (0, 0, False), "a#(": (1, 0, False), "a | # x": (0, 0, True), "a `": (0, 0, True), "a `(": (0, 0, False), "a,  ": (0, 0, True), "": (0, 0, False), "'|'": (0, 0, False)}
    got = texts(*lines).select("text", D.scanned(F.col("text")).alias("s")).collect()
    assert {r.text: (r.s["round"], r.s.curly, r.s.more) for r in got} == lines


def test_typed_lines_of_transcripts(texts):
    rows = texts("PS C:\\a> Get-Item x\nC:\\> DIR /s\nme@h:~$ ./run\nroot@h:/# id\ntool -v a\nout put\nset x=1\n9x -v\na@b no\ncp /etc b")
    got = sorted((r.program, r.args) for r in D.prompt_commands(rows, "id", "text").collect())
    assert got == [("cp", ["/etc", "b"]), ("dir", ["/s"]), ("get-item", ["x"]), ("id", []), ("run", []), ("set", ["x=1"]), ("tool", ["-v", "a"])]


def test_narrative_fields(texts):
    got = D.narrative_events(texts("[t] -> Event 1 (x): Image: a | b | CommandLine: c: d | Image: e"), "id", "text").first()
    assert (got.at, got.image, got.command) == ("t", "e", "c: d")


def test_sightings_as_a_plain_loop(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice("pq"), rnd.choice([None, *range(0, 60, 2)]), rnd.choice("ab"), rnd.choice([None, "", "x", "y", "z"])) for i in range(300)]
    want, kept = [], {}
    for i, k, t, s, g in sorted(rows, key=lambda r: (r[1], -1 if r[2] is None else r[2], r[0])):
        old = kept.setdefault(k, [])
        if not any((g and g == og) or (t is not None and ot is not None and s != os and abs(t - ot) <= 3) for ot, os, og in old):
            old.append((t, s, g))
            want.append(i)
    df = spark.createDataFrame(rows, "i int, k string, t bigint, s string, g string")
    got = P.merged_sightings(df, ["k"], ["t", "i"], "t", "s", "g", 3)
    assert sorted(r.i for r in got.collect()) == sorted(want) and got.columns == df.columns


RECORDS = [("1", "10", None, "7", "fork", "11"), ("2", "11", "10", None, None, None), ("3", "12", "11", None, None, None), ("4", "11", None, None, "exit", None), ("5", "11", None, None, None, None), ("6", "20", "99", None, "fork", "21"), ("7", "21", "20", None, None, None), ("8", "22", "20", None, None, None), ("9", None, "10", None, None, None)]
SESSIONS = {"1": "login:7", "2": "login:7", "3": "login:7", "4": "login:7", "5": "process:11:5", "6": "process:20:6", "7": "process:21:6", "8": "process:22:8", "9": "event:9"}
SCHEMA = "event string, pid string, parent string, login string, action string, child string"


def test_sessions_of_forks_parents_and_used_pids(spark):
    df = spark.createDataFrame(RECORDS, SCHEMA).withColumn("host", F.lit(None).cast("string"))
    got = P.lifetime_sessions(df, ["host"], ["event"])
    assert {r.event: r.session for r in got.collect()} == SESSIONS
    assert P.lifetime_sessions(df.limit(0), ["host"], ["event"]).collect() == []


def test_sessions_of_rows_in_any_order(spark, tmp_path):
    """Rows come in three runs, later ones first, and null keys among them; a last row lets all of them out."""
    src, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    rows = spark.createDataFrame(RECORDS, SCHEMA).withColumns({"host": F.explode(F.array(F.lit("h"), F.lit("g"))), "at": F.timestamp_seconds(F.col("event").cast("long"))})
    end = rows.limit(1).withColumns({"host": F.lit("end"), "at": F.timestamp_seconds(F.lit(10_000_000))})
    for part in (rows.where("event > '6'"), rows.where("event <= '3'"), rows.where("event between '4' and '6'").unionByName(end)):
        part.coalesce(1).write.mode("append").parquet(src)
        got = J.run_append(T.lifetime_sessions(J.file_stream(spark, src, rows.schema), ["host"], "event", "at", "1 day"), out, log)
    for host in "gh":
        assert {r.event: r.session for r in got.where(F.col("host") == host).collect()} == SESSIONS
    assert got.count() == 2 * len(SESSIONS)


def test_open_events_come_out_late(spark, tmp_path):
    src, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    kind = "host string, e int, pos int, line string, done boolean, s bigint"
    batches = [[("h", 1, 1, "b", False, 10), ("h", 1, 0, "a", False, 10), ("h", 2, 0, "c", None, 12)], [("h", 2, 1, None, True, 13), ("g", 3, 0, "x", True, 500)], [("g", 4, 0, "y", True, 900)]]
    for b in batches:
        rows = spark.createDataFrame(b, kind).withColumn("at", F.timestamp_seconds("s"))
        rows.coalesce(1).write.mode("append").parquet(src)
        s = J.file_stream(spark, src, rows.schema)
        got = J.run_append(T.assembled_events(s, ["host"], "e", "pos", "line", "done", "at", 60_000, "10 seconds"), out, log)
    assert sorted((r.host, r.event, r.lines, r.complete) for r in got.collect()) == [("g", "3", ["x"], True), ("g", "4", ["y"], True), ("h", "1", ["a", "b"], False), ("h", "2", ["c", ""], True)]


def test_reviewed_keys(spark):
    rows = [("a", "benign"), ("a", "malicious"), ("b", "malicious"), ("b", None), ("c", "benign"), ("c", "invalid"), ("d", None)]
    got = P.reviewed_merge(spark.createDataFrame(rows, "k string, v string"), ["k"], "v")
    assert sorted(map(tuple, got.collect())) == [("a", "benign"), ("b", "malicious")]


def test_xml_events_whole_and_broken(spark, tmp_path):
    path = str(tmp_path / "xml")
    good = "<?xml version='1.0'?>\n<Events><Event xmlns='u'>\n<System><Provider Name='p'/><TimeCreated SystemTime='t'/><EventID>1</EventID></System><EventData><Data Name='a'>x\ny</Data><Data Name='a'>z</Data><Data Name='e'/><Data>none</Data></EventData></Event>"
    bad = "<Event><System><EventID>2</EventIDs></System><EventData><Data Name=\"a\">1 < 2 &amp; 3</Data></EventData></Event>"
    other = "<Event><System/></Event></Events>"
    spark.createDataFrame([(good + bad + other + "<Event>no end",)], "value string").write.text(path)
    got = [(r.recovered, r.fields) for r in R.xml_events(spark, path).collect()]
    assert got[0] == (False, {"a": "z", "e": "", "Provider": "p", "TimeCreated": "t", "EventID": "1"})
    assert got[1][0] and got[1][1]["a"] == "1 < 2 & 3" and got[2] == (False, {})
    assert len(R.xml_events(spark, path, "SystemTime").collect()) == 1


def test_audit_lines_out_of_order_repeated_and_odd(spark):
    m = "msg=audit(1:%d):"
    lines = [f"type=SYSCALL {m % 1} syscall=execve exe=\"/bin/a\"", f"type=EXECVE {m % 2} a1=FF a0=\"b c\"", None, "", "no event", f"type=EXECVE {m % 1} argc=1 a0=\"a\"", f"type=EXECVE {m % 1} argc=1 a0=\"a\"", f"type=EXECVE {m % 3} argc=2 a1=x", f"type=PATH {m % 4} name=\"n\" nametype=NORMAL", f"boot_id=B type=EXECVE {m % 1} argc=1 a0=d"]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, n int, s string")
    got = sorted((r.boot, r.event, r.first_line, r.argv, r.exe) for r in A.audit_commands(df, "file", "n", "s").collect())
    assert [x[:4] for x in got] == [("B", "1:1", 9, ["d"]), ("initial", "1:1", 0, ["a"]), ("initial", "1:2", 1, ["b c", "\ufffd"])]
    assert got[1][4] == "/bin/a"
    assert A.audit_commands(df.limit(0), "file", "n", "s").collect() == []


def test_words_of_odd_inputs(spark):
    long = "x" * 300_000
    rows = spark.createDataFrame([(None,), ("",), (" \n;;",), ("a 'b",), (long + " 'q" + long + "' z",), ("/bin/ls dir; ./go > out",)], "s string")
    got = rows.select(H.shell_tokens(F.col("s")).alias("t"), H.invocations(F.col("s")).alias("i"), C.argv(F.col("s")).alias("a")).collect()
    assert [r.t for r in got[:2]] == [None, []] and [r.i for r in got[:4]] == [None, [], [], [["a", "b"]]]
    assert got[4].i == [[long, "q" + long, "z"]] and got[4].a[0] == long
    assert got[5].t == ["/bin/ls", "dir", ";", "./go", ">", "out"] and got[5].i == [["/bin/ls", "dir"], ["./go"]]


def test_payloads_that_are_none(spark):
    rows = spark.createDataFrame([(None,), ("",), ("ANg=",), ("PNgI3Q==",), ("CN0=",), ("YQA=",)], "s string")
    assert [r[0] for r in rows.select(H.utf16_base64(F.col("s"))).collect()] == [None, "", None, "\U0001f108", None, "a"]


def test_long_quotes_in_examples(texts):
    long = "'" + "y" * 200_000 + "' |"
    got = D.submissions(texts(f"PS> {long}\n  next\nout"), ["id"], "text").collect()
    assert [r.input for r in got] == [long + "\n  next"]


def test_states_of_streams_by_buckets(spark, tmp_path):
    """Very many events and processes share few states, so a batch does not call for each of them."""
    ends = [("h", 10_000 + i, 0, "a", i % 2 == 0) for i in range(3000)]
    rows = spark.createDataFrame(ends, "host string, e int, pos int, line string, done boolean").withColumn("at", F.timestamp_seconds(F.lit(5)))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    lives = rows.select("host", F.col("e").cast("string").alias("event"), F.col("e").cast("string").alias("pid"), *[F.lit(None).cast("string").alias(c) for c in ("parent", "login", "action", "child")], "at", "e")
    lives.withColumn("host", F.col("event")).coalesce(1).write.parquet(str(tmp_path / "lives"))
    events = T.assembled_events(J.file_stream(spark, str(tmp_path / "in"), rows.schema), ["host"], "e", "pos", "line", "done", "at", 60_000, "10 seconds", buckets=4)
    sessions = T.lifetime_sessions(J.file_stream(spark, str(tmp_path / "lives"), lives.schema), ["host"], "e", "at", "1 day", buckets=4)
    for name, stream, most, out in (("events", events, 4 * 3, 1500), ("sessions", sessions, 4 * 4, 0)):
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / f"{name}-out")).option("checkpointLocation", str(tmp_path / f"{name}-log")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= most
        assert spark.read.schema(stream.schema).parquet(str(tmp_path / f"{name}-out")).count() == out
