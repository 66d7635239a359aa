"""A corpus pipeline over `documents`: quality rules, near-duplicate removal, mixing to target weights, BPE encoding.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import bpe, mixing, neardup, quality
from vigil.llm._common import cut, staged, with_filter
from vigil.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"


#: Below this, 2**62 free numbers lie behind an id.
ROOM = 1 << 62
#: Rows of an Arrow batch.  Texts can be long, and a batch lies in the JVM and in Python at once.
ARROW_ROWS = 1000


@contextmanager
def _few_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs that are run inside take few rows at a time; afterwards the session is as before.  So stages write their rows inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(ARROW_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely good than bad by their posterior quality.

    Null and empty texts, and those of white space, have no words and go.  Repeated rows are judged alike and all stay or
    all go; null ids change nothing; extra columns are left out; an empty table gives an empty result.
    """
    with _few_rows(spark):
        return staged(quality.judge_quality(docs.select(*COLUMNS)).where("posterior >= 0.5 and n_words > 0").select(*COLUMNS), "good")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8 or more): that of the smallest id.

    Rows with a null doc_id all stay, as nothing can refer to them.  Rows that share a doc_id and a text become one, with
    the smallest of their other columns.  Different texts of one doc_id are documents of their own, judged each by itself:
    the smallest text goes by the doc_id, the others come after all ids of the table, or where there is no room behind
    these, at free places between them.  Null and empty texts are near no
    other and stay, one for each id.  Extra columns are left out; an empty table gives an empty result.
    """
    docs = docs.select(*COLUMNS)
    single = _one_row_ids(docs.where("doc_id is not null"))
    with _few_rows(spark):
        gone = cut(neardup.near_duplicates(single, id_col="row_id", threshold=(80, 100)).where("not kept").select(F.col("doc_id").alias("row_id")))
    # few rows go, so most texts are passed on where they are, and only the others are shuffled
    marked = with_filter(single, "row_id", gone, "_maybe")
    kept = marked.where("not _maybe").unionByName(marked.where("_maybe").join(gone, "row_id", "left_anti"))
    return kept.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def _one_row_ids(docs: DataFrame) -> DataFrame:
    """docs, without repeats of (doc_id, text), with row_id: doc_id, or for all texts of an id but the smallest a number above all ids."""
    repeated = cut(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    if not repeated.limit(1).count():
        return docs.withColumn("row_id", F.col("doc_id"))
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    texts = cut(docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("o")).select("doc_id", "text", *[f"o.{c}" for c in others]))
    first = texts.groupBy("doc_id").agg(F.min("text").alias("first"))
    ids = docs.agg(F.max("doc_id"), F.min("doc_id")).first()
    known = docs.select(F.col("doc_id").alias("row_id"))
    for salt in itertools.count():
        # a running number behind all ids; if they reach too high, a hash that is no id yet
        free = F.lit(ids[0] + 1) + F.monotonically_increasing_id() if ids[0] < ROOM else F.xxhash64(F.lit(salt), "doc_id", "text")
        named = texts.join(first, "doc_id").withColumn("_first", F.col("text").eqNullSafe(F.col("first"))).withColumn("row_id", F.when(F.col("_first"), F.col("doc_id")).otherwise(free))
        odd = cut(named)  # the numbers depend on how the rows are split
        new = odd.where("not _first").select("row_id")
        if ids[0] < ROOM or not new.join(known, "row_id", "left_semi").unionByName(new.groupBy("row_id").count().where("count > 1").select("row_id")).limit(1).count():
            break
    once = docs.join(repeated, "doc_id", "left_anti").withColumn("row_id", F.col("doc_id"))
    return once.select(*COLUMNS, "row_id").unionByName(odd.select(*COLUMNS, "row_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected token shares of source, language and topic are the targets.

    Null sources and languages are categories of their own.  Null and empty texts have no tokens, and are drawn with the
    probability of weight 1.  Rows that share an id are drawn alike, null ids together.  Extra columns are left out; an
    empty table gives an empty result.
    """
    with _few_rows(spark):
        return staged(mixing.mix(docs.select(*COLUMNS), tokenizer=tokenizer_path(TOKENIZER)).where("sampled").select(*COLUMNS), "mixed")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, packed token ids, and whether decoding gives the text back, for every row.

    A null text is encoded as the empty one.  Null ids and repeated rows pass; an empty table gives an empty result.
    """
    done = bpe.roundtrip(docs.select("doc_id", "source", "lang", "text"), tokenizer_path(TOKENIZER))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    with _few_rows(spark):
        return staged(done.select("doc_id", "source", "lang", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same.alias("round_trip")), "encoded")


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("mixing", mix_sources), ("bpe", encode)]

#: Expectation-maximisation, sketches, raking and BPE have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, name.replace(" ", "-"))
    return docs
