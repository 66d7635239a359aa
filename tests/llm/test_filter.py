"""Filters of ids, and what near-duplicates shuffle with them."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as p
from vigil.llm import _common


def test_filter_holds_all_its_ids(spark):
    ids = spark.range(20_000).select((F.col("id") * 7_919 - 50_000_000).alias("x"))
    rows = spark.range(200_000).select((F.col("id") * 7_919 - 50_000_000).alias("doc_id"), F.col("id").alias("_at"), F.col("id").alias("i.j"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1, 1)], "doc_id bigint, _at bigint, `i.j` bigint"))
    got = _common.with_filter(rows, "doc_id", ids, "maybe")
    assert got.columns == [*rows.columns, "maybe"]
    n = {(r.inside, r.maybe): r["count"] for r in got.groupBy((F.col("`i.j`") < 20_000).alias("inside"), "maybe").count().collect()}
    assert n[True, True] == 20_000 and n[True, False] == 1  # all ids; the null row
    assert 0 < n[False, True] < 180_000 * 0.1 and n[False, True] + n[False, False] == 180_000
    assert _common.with_filter(rows, "doc_id", ids.limit(0), "maybe").where("maybe").count() == 0
    assert _common.with_filter(rows.limit(0), "doc_id", ids, "maybe").count() == 0


def test_filter_of_too_few_bits(spark, monkeypatch):
    monkeypatch.setattr(_common, "MOST_BITS", 1 << 15)
    got = _common.with_filter(spark.range(100_000), "id", spark.range(0, 100_000, 2), "maybe")
    assert got.where("id % 2 = 0 and not maybe").count() == 0


def _shuffled(spark) -> int:
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    found = sc.statusStore().executorList(False)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def test_near_duplicates_shuffle_few_texts(spark):
    """120 texts of 20,000 random characters, ten of them with a near copy: texts outside groups are not shuffled, and neither are kept ones."""
    rng = random.Random(5)
    texts = [" ".join(f"{rng.getrandbits(64):016x}" for _ in range(1_200)) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1_000 + i, texts[i] + " more") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").alias("n_chars")).repartition(4)
    docs = _common.staged(docs, "docs")
    before = _shuffled(spark)
    kept = p.near_duplicates(spark, docs, "").select("doc_id", "text").collect()
    assert sorted((r.doc_id, r.text) for r in kept) == rows[:120]
    assert _shuffled(spark) - before < sum(len(t) for _, t in rows) / 2
