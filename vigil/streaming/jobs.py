"""Structured Streaming jobs over files.  Each runs on what has arrived (availableNow) and is safe to start again."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, which states of several parts need; afterwards the session is as before."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_append(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """The stream's rows appended to Parquet files in `out`, read back; exactly once, by the sink's own log."""
    stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """write(rows, batch) for each batch; a batch that runs again has the same number, so it must overwrite its own output."""
    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_updates(stream: DataFrame, keys: list[str], out: str, checkpoint: str) -> DataFrame:
    """The last version of each key of an aggregation in update mode."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch}")

    run_batches(stream, write, checkpoint, "update")
    values = [c for c in stream.columns if c not in keys]
    rows = stream.sparkSession.read.option("basePath", out).parquet(out)
    last = F.max_by(F.struct(*values), "batch_id").alias("v")
    return rows.groupBy(*keys).agg(last).select(*keys, "v.*")


def run_complete(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """The whole result of an aggregation after the last batch."""
    last = []

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/{batch}")
        last[:] = [batch]

    run_batches(stream, write, checkpoint, "complete")
    spark = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(f"{out}/{last[0]}") if last else spark.createDataFrame([], stream.schema)


def first_seen(stream: DataFrame, keys: list[str], at: str | None = None, delay: str = "1 day") -> DataFrame:
    """One row of each key: over all time, or, with an event-time column, within the watermark, which bounds the state."""
    if at is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def _bounded(stream: DataFrame, at: str, delay: str | None) -> DataFrame:
    return stream if delay is None else stream.withWatermark(at, delay)


def idle_sessions(stream: DataFrame, key: str, at: str, gap: str, delay: str | None = None) -> DataFrame:
    """(key, first_at, end_at, n) of sessions that end after `gap` without a row; with a delay, late rows go and state is bounded."""
    s = _bounded(stream, at, delay).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return s.select(key, F.col("w.start").alias("first_at"), F.col("w.end").alias("end_at"), "n")


def daily_counts(stream: DataFrame, key: str, at: str, delay: str | None = None) -> DataFrame:
    s = _bounded(stream, at, delay).groupBy(F.window(at, "1 day").alias("w"), key).agg(F.count("*").alias("n"))
    return s.select(key, F.col("w.start").alias("day"), "n")


def with_rules(stream: DataFrame, rules: DataFrame, keys: list[str], most_rows: int = 100_000) -> DataFrame:
    """stream with the columns of a static rule table, broadcast while its rows are at most `most_rows`."""
    small = rules.limit(most_rows + 1).count() <= most_rows
    return stream.join(F.broadcast(rules) if small else rules, keys, "left")


def late_evidence(commands: DataFrame, evidence: DataFrame, key: str, at: str, evidence_at: str, bound: str, delay: str) -> DataFrame:
    """commands (key, at) left-joined with evidence that comes up to `bound` after them; both sides' state is bounded by the watermarks."""
    c = commands.withWatermark(at, delay).alias("c")
    e = evidence.withWatermark(evidence_at, delay).alias("e")
    near = (F.col(f"c.{key}") == F.col(f"e.{key}")) & (F.col(f"e.{evidence_at}") >= F.col(f"c.{at}")) & (F.col(f"e.{evidence_at}") <= F.col(f"c.{at}") + F.expr(f"INTERVAL {bound}"))
    return c.join(e, near, "left").select("c.*", *[F.col(f"e.{x}").alias(x if x not in commands.columns else f"evidence_{x}") for x in evidence.columns if x != key])
