"""Observation tables built from the given tables, as the stand-ins for ingested data."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import basename, final_label, session_fallback


class Tables:
    """The tables of a folder by name, and the observation tables made from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def shell(self) -> DataFrame:
        """Shell inputs: documents with their labels."""
        return shell_inputs(self.documents, self.labels)

    @cached_property
    def launches(self) -> DataFrame:
        """Process launches: one row for each line with a word."""
        return process_launches(self.shell)

    @cached_property
    def telemetry(self) -> DataFrame:
        """Events as host telemetry: host, t (microseconds), kind, k."""
        t = F.unix_micros(F.col("ts").cast("timestamp"))
        return self.events.select("event_id", F.col("user_id").alias("host"), t.alias("t"), F.col("event_type").alias("kind"), "value", F.get_json_object("props", "$.k").cast("int").alias("k"))

    @cached_property
    def dealt_telemetry(self) -> DataFrame:
        """Telemetry dealt by event over the tasks, for much work on each row: a file of few row groups is read by as few tasks."""
        return self.telemetry.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "event_id")


def hashed_label(key) -> F.Column:
    """A label or NULL from the first hex digit of the md5 of a key."""
    first = F.substring(F.md5(key), 1, 1)
    return F.when(first.isin("0", "1"), "malicious").when(first.isin("2", "3", "4"), "benign").when(first == "5", "unknown")


def shell_inputs(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents in the columns of shell inputs: the label sheet gives the dataset's label, hashes give AI labels and overrides."""
    d = documents.join(labels, "doc_id", "left")
    known = F.col("quality").isNotNull()
    label = F.when(F.col("toxic") == 1, "malicious").when(F.col("quality") == 1, "benign").when(known, "malicious-group").otherwise("unknown")
    record = F.col("doc_id").cast("string")
    return d.select(
        "doc_id", F.col("text").alias("shell_input"), F.col("source").alias("dataset"), record.alias("record_id"), label.alias("dataset_label"),
        F.when(label == "malicious-group", F.col("source")).alias("group_id"),
        session_fallback(F.when(F.col("doc_id") % 7 != 0, F.concat_ws("-", "source", F.floor(F.col("doc_id") / 10))), F.col("source"), record).alias("session_id"),
        F.when(F.col("lang") == "en", "linux").otherwise("windows").alias("os"),
        hashed_label(F.concat(F.lit("ai"), record)).alias("ai_label"), F.when(F.col("doc_id") % 11 == 0, hashed_label(F.concat(F.lit("override"), record))).alias("override_label"),
    ).withColumn("label", final_label(F.col("dataset_label"), F.col("ai_label"), F.col("override_label")))


def process_launches(shell: DataFrame) -> DataFrame:
    """One launch for each line with a word: the first word is the program, the others its arguments."""
    lines = shell.select("*", F.posexplode(F.split("shell_input", "\n")).alias("pos", "line")).where(F.trim("line") != "")
    words = F.split(F.trim("line"), " +")
    pgm = F.element_at(words, 1)
    return lines.select(
        "doc_id", "pos", pgm.alias("pgm"), basename(pgm, F.col("os")).alias("pgm_base"), F.slice(words, 2, F.size(words)).alias("args"),
        "dataset", F.concat_ws(":", "record_id", "pos").alias("record_id"), "dataset_label", "group_id", "session_id", "os", "ai_label", "override_label", "label",
    )
