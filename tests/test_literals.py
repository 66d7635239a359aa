"""Many literal patterns in many texts, and chunks by jump pointers, against plain loops."""

import json
import random

import pytest
from pyspark.sql import functions as F

from vigil.operators import literals as L
from vigil.operators import selection as S


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("lookup", [1_000_000, 0])
def test_first_literals_as_a_loop(spark, monkeypatch, lookup):
    monkeypatch.setattr(L, "LOOKUP_GRAMS", lookup)
    monkeypatch.setattr(L, "ROW_PATTERNS", 3)
    rnd = random.Random(4)
    letters = "abAB.é日 "
    texts = [None, "", "ab", "x" * 50_000 + "NEEDLE"] + ["".join(rnd.choices(letters, k=rnd.randint(0, 30))) for _ in range(300)]
    rules = [("needle", 5, "n"), ("NEEDLE", 2, "m"), (None, 0, "x"), ("", 0, "x"), ("absent", 0, "x"), ("é", 40, "e"), ("日", 40, "d")]
    rules += [("".join(rnd.choices(letters, k=rnd.randint(1, 6))), rnd.randint(3, 60), f"v{i}") for i in range(120)]
    df = spark.createDataFrame([*enumerate(texts), (1000, texts[9])], "i bigint, text string").withColumn("key", F.lit(0))
    table = spark.createDataFrame(rules, "literal string, place int, value string")
    for any_case in (True, False):
        fold = lower if any_case else (lambda t: t)
        got = {r.i: r.rule for r in L.first_literal(df, table, "text", "place", "value", any_case=any_case).collect()}
        for i, t in [*enumerate(texts), (1000, texts[9])]:
            held = [(place, v) for p, place, v in rules if p and t is not None and fold(p) in fold(t)]
            assert got[i] == (min(held)[1] if held else None), (i, t)
    assert [r.rule for r in L.first_literal(df.limit(3), table.limit(0), "text", "place", "value").collect()] == [None] * 3
    assert L.first_literal(df.limit(0), table, "text", "place", "value").count() == 0


def test_very_many_indicators(spark):
    """More indicators than any pattern or plan could hold."""
    many = spark.range(300_000).select(F.concat(F.lit("host"), F.col("id"), F.lit(".example")).alias("indicator"))
    df = spark.createDataFrame([(1, "ping HOST7.example", "unknown"), (2, "ping host300000.example", "unknown"), (3, "host299999.example", "benign"), (4, None, "unknown"), (5, "xhost1234.example!", "unknown")], "i int, text string, label string")
    got = {r.i: r.label for r in L.indicator_upgrade(df, many, "text").collect()}
    assert got == {1: "malicious", 2: "unknown", 3: "benign", 4: "unknown", 5: "malicious"}


def test_chunks_as_a_loop(spark):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None]), i, rnd.choice([0, 1, 3, 5, 9, None, 30])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i bigint, n bigint")
    for most_rows, most_bytes in ((4, 20), (100, 25), (3, 10**6), (1000, 10**6)):
        got = {r.i: (r.chunk, r.position) for r in S.running_chunks(df, "k", ["i"], F.col("n"), most_rows, most_bytes).collect()}
        open_, want = {}, {}
        for k, i, n in rows:
            n = n or 0
            if n > most_bytes:
                want[i] = (None, None)
                continue
            chunk, count, used = open_.get(k, (0, 0, 0))
            if count and (count == most_rows or used + n > most_bytes):
                chunk, count, used = chunk + 1, 0, 0
            want[i] = (chunk, count)
            open_[k] = (chunk, count + 1, used + n)
        assert got == want
    assert S.running_chunks(df.limit(0), "k", ["i"], F.col("n"), 3, 9).count() == 0


def test_requests_in_files(spark, tmp_path):
    rows = [("a", i, f'say "é{i}"\n') for i in range(9)] + [("b", 20, "x" * 700), ("b", 21, "y")]
    df = spark.createDataFrame(rows, "dataset string, i int, text string")
    body = F.struct(F.col("text").alias("input"))
    dealt = S.running_chunks(df, "dataset", ["i"], S.request_size(body, "/v1/r"), 4, 600)
    S.write_requests(S.request_lines(dealt, body, "/v1/r"), str(tmp_path / "out"))
    found = {}
    for f in (tmp_path / "out").glob("dataset=*/chunk=*/part-*.txt"):
        raw = f.read_bytes()
        assert len(raw) <= 600
        found[f.parent.parent.name, f.parent.name] = [json.loads(line) for line in raw.decode().splitlines()]
    ids = [r["custom_id"] for r in found["dataset=a", "chunk=0"]]
    assert ids == [f"a:0:{i}" for i in range(len(ids))] and found["dataset=a", "chunk=0"][0] == {"custom_id": "a:0:0", "method": "POST", "url": "/v1/r", "body": {"input": 'say "é0"\n'}}
    texts = {t for lines in found.values() for t in (r["body"]["input"] for r in lines)}
    assert texts == {t for _, _, t in rows if len(t) < 500 or t == "y"} and sum(map(len, found.values())) == 10


def test_request_files_of_odd_names(spark, tmp_path):
    """A file a chunk and nothing beside it, written by the tasks; names that folders cannot have come back."""
    names = ["a/b=c %", "é{}", None, "", "7x"]
    rows = [(n, c, p, f"{n} {c} {p} é") for n in names for c in range(3) for p in range(2)] + [("a", None, None, "none")]
    out = str(tmp_path / "out")
    S.write_requests(spark.createDataFrame(rows, "dataset string, chunk long, position long, line string"), out)
    got = S.read_requests(spark, out)
    assert sorted((r.dataset or "", r.chunk, r.value) for r in got.collect()) == sorted((n or "", c, t) for n, c, _, t in rows if c is not None)
    files = [f for f in (tmp_path / "out").rglob("*") if f.is_file()]
    assert sorted({f.name for f in files}) == ["_SUCCESS", "part-00000.txt"] and len(files) == 4 * 3 + 1
    with pytest.raises(FileExistsError):
        S.write_requests(spark.createDataFrame(rows, "dataset string, chunk long, position long, line string"), out)
