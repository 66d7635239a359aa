"""Sampling, sessions, representatives, evaluation analytics, set comparison."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..lineage import cut
from .ordered import Ordered


def stratified_sample(df: DataFrame, strata: list[str], identity: Column, n: int, seed: str) -> DataFrame:
    """n rows of each stratum by the md5 of seed and identity: the same rows in every run.  The limit is applied before the shuffle."""
    order = F.md5(F.concat(F.lit(seed), identity))
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*strata).orderBy(order, identity))).where(F.col("place") <= n)


def first_per(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("place = 1").drop("place")


def idle_sessions(events: DataFrame, key: str, at: str, idle: int, tie: str = "event_id") -> DataFrame:
    """events with session_no: a new session begins after more than `idle` units of `at` without an event.  Times must not be null."""
    rows = Ordered(events, [key], [at, tie])
    df = rows.last(rows.rows, F.col(at), "_prior", strict=True)
    gap = F.coalesce(F.col(at) - F.col("_prior") > idle, F.lit(True))
    return rows.total(df, gap.cast("long"), "session_no").select(*events.columns, "session_no")


def carried_forward(df: DataFrame, key: str, order: list[str], value: Column, name: str, default: str) -> DataFrame:
    """df with the last non-null value at or before each row, e.g. the boot that a line belongs to."""
    rows = Ordered(df, [key], order)
    return rows.last(rows.rows, value, "_last").select(*[c for c in df.columns if c != name], F.coalesce("_last", F.lit(default)).alias(name))


def joined_continuations(lines: DataFrame, key: str, pos: str, text: str) -> DataFrame:
    """(key, first position, input): lines that end in an odd number of backslashes are joined with the next."""
    w = Window.partitionBy(key).orderBy(pos)
    odd = F.length(F.regexp_extract(text, r"(\\*)$", 1)) % 2 == 1
    start = ~F.coalesce(F.lag(odd).over(w), F.lit(False))
    grouped = lines.withColumn("part", F.sum(start.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("t"))))
    joined = F.array_join(F.transform(pieces, lambda x: x.t), "\n")
    return grouped.groupBy(key, "part").agg(F.min(pos).alias("first_pos"), joined.alias("input")).drop("part")


def confusion(pairs: DataFrame, labels: list[str]) -> DataFrame:
    """(dataset, reference, prediction, n, share) on the full label grid; dataset NULL is the total."""
    counts = pairs.groupingSets([["dataset", "reference", "prediction"], ["reference", "prediction"]], "dataset", "reference", "prediction").agg(F.count("*").alias("n"))
    scopes = counts.select("dataset").distinct()
    names = F.array(*map(F.lit, labels))
    grid = scopes.withColumn("reference", F.explode(names)).withColumn("prediction", F.explode(names))
    same = grid["dataset"].eqNullSafe(counts["dataset"]) & (grid["reference"] == counts["reference"]) & (grid["prediction"] == counts["prediction"])
    full = grid.join(counts, same, "left").select(grid["dataset"], grid["reference"], grid["prediction"], F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("dataset"))
    return full.withColumn("share", F.col("n") / F.nullif(total, F.lit(0)))


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, repeats counted, with `side`."""
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionByName(b.exceptAll(a).withColumn("side", F.lit("second")))


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """df with a dense number from 0 in the order of a column whose values differ (null first).

    Rows are dealt by ranges of the column and counted in each; only the counts of the ranges are put in one order.
    """
    dealt = cut(df.repartitionByRange(F.col(order).asc_nulls_first()).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(order).asc_nulls_first())) - 1
    return dealt.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + place).drop("_range", "_start")


def dense_ids(sample: DataFrame, strata: list[str], place: str = "place", name: str = "sample_id") -> DataFrame:
    """sample with a dense number from 1 in the order of strata (null first) and place.

    place counts from 1 in each stratum, so only the sizes of the strata, one row each, go through one task.
    """
    sizes = sample.groupBy(*strata).agg(F.count("*").alias("_n"))
    before = Window.orderBy(*[F.col(c).asc_nulls_first() for c in strata]).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(c).alias(f"_{c}") for c in strata], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in strata]
    return sample.join(starts, same).withColumn(name, F.col("_start") + F.col(place)).drop("_start", *[f"_{c}" for c in strata])


def running_chunks(df: DataFrame, key: str, order: list[str], size: Column, most_rows: int, most_bytes: int) -> DataFrame:
    """df with chunk and position (both from 0 in each key): a chunk is closed before a row would pass either bound.

    A row that alone is larger than most_bytes has no chunk (null); a null size counts as 0.  `order` must be total.

    Sums along the key say where a chunk that begins at a row would end, for every row (its jump).  Inside a range of rows
    the jumps are followed to the first row behind it; these long jumps are then doubled from range to range until it is
    known where the chunks enter each range.  So no task needs the end of the chunks before its own.
    """
    sized = df.withColumn("_size", F.coalesce(size.cast("long"), F.lit(0)))
    rows = Ordered(sized.where(F.col("_size") <= most_bytes), [key], order)
    t = rows.total(rows.total(rows.rows, F.col("_size"), "_end"), F.lit(1), "_n").withColumns({"_key": F.struct(key), "_i": F.col("_n") - 1}).drop("_n")
    t = cut(t)
    narrow = t.select("_key", "_range", "_i", "_end", "_size")
    # the first row whose end lies more than most_bytes behind this row's begin; of places at one value, rows come before the question
    ends = narrow.select("_key", F.col("_end").alias("_v"), F.lit(0).alias("_asks"), "_i", F.lit(None).cast("int").alias("_part"))
    asks = narrow.select("_key", (F.col("_end") - F.col("_size") + most_bytes).alias("_v"), F.lit(1).alias("_asks"), "_i", F.col("_range").alias("_part"))
    by_bytes = Ordered(ends.unionByName(asks), ["_key"], ["_v", "_asks", "_i"])
    found = by_bytes.next(by_bytes.rows, F.when(F.col("_asks") == 0, F.col("_i")), "_past").where("_asks = 1")
    jumps = cut(found.select("_key", "_part", "_i", F.least(F.col("_i") + most_rows, F.coalesce("_past", F.col("_i") + most_rows)).alias("_to")))
    kind = jumps.select("_key", "_i", "_to").schema

    def far(part: pa.Table) -> pa.Table:
        """For each row of a range, the first place behind the range that its jumps reach."""
        part = part.sort_by("_i")
        first, to = part["_i"][0].as_py(), part["_to"].to_numpy().copy()
        while (inside := np.flatnonzero(to < first + len(to))).size:
            to[inside] = to[to[inside] - first]
        return pa.table({"_key": part["_key"], "_i": part["_i"], "_to": to})

    def begins(part: pa.Table) -> pa.Table:
        """The rows of a range that its entry and the jumps from there reach."""
        part = part.sort_by("_i")
        first, to, at = part["_i"][0].as_py(), part["_to"].to_numpy(), part["_entry"][0].as_py()
        out = []
        while at < first + len(to):
            out.append(at)
            at = int(to[at - first])
        return pa.table({"_key": part["_key"].combine_chunks().take(pa.array(np.array(out, np.int64) - first)), "_i": pa.array(out, pa.int64()), "_to": pa.array(out, pa.int64())})

    long = cut(jumps.groupBy("_key", "_part").applyInArrow(far, kind))
    # only where a range can be entered: at the first row of a key, and where a long jump ends
    doors = long.select("_key", F.col("_to").alias("_i")).distinct()
    jump = cut(long.join(doors.unionByName(long.where("_i = 0").select("_key", "_i")).distinct(), ["_key", "_i"]))
    entered = long.where("_i = 0").select("_key", "_i")
    while jump.limit(1).count():  # the number of jumps taken doubles, so rounds are the log of the number of ranges
        entered = cut(entered.unionByName(entered.join(jump, ["_key", "_i"]).select("_key", F.col("_to").alias("_i"))))
        then = jump.select("_key", F.col("_i").alias("_to"), F.col("_to").alias("_then"))
        jump = cut(jump.join(then, ["_key", "_to"]).select("_key", "_i", F.col("_then").alias("_to")))
    doors = entered.join(jumps, ["_key", "_i"]).select("_key", "_part", F.col("_i").alias("_entry"))  # a row for each range at most
    starts = jumps.join(doors, ["_key", "_part"]).groupBy("_key", "_part").applyInArrow(begins, kind).select("_key", "_i", F.lit(True).alias("_begins"))
    marked = t.join(starts, ["_key", "_i"], "left")
    begun = rows.last(rows.total(marked, F.col("_begins").cast("int"), "_chunks"), F.when(F.col("_begins"), F.col("_i")), "_from")
    placed = begun.withColumns({"chunk": F.col("_chunks") - 1, "position": F.col("_i") - F.col("_from")}).select(*df.columns, "chunk", "position")
    alone = sized.where(F.col("_size") > most_bytes).select(*df.columns).withColumns({c: F.lit(None).cast("long") for c in ("chunk", "position")})
    return placed.unionByName(alone)


def request_lines(df: DataFrame, body: Column, url: str, dataset: str = "dataset") -> DataFrame:
    """df (with chunk and position of running_chunks) with `line`: a JSON request with the id `dataset:chunk:position`."""
    request = F.struct(F.concat_ws(":", dataset, "chunk", "position").alias("custom_id"), F.lit("POST").alias("method"), F.lit(url).alias("url"), body.alias("body"))
    return df.withColumn("line", F.to_json(request))


def request_size(body: Column, url: str, dataset: str = "dataset", id_bytes: int = 24) -> Column:
    """The bytes of a request line and its line end; the numbers in its id are counted with id_bytes, more than they can have."""
    request = F.struct(F.concat_ws(":", F.col(dataset), F.lit("")).alias("custom_id"), F.lit("POST").alias("method"), F.lit(url).alias("url"), body.alias("body"))
    return F.octet_length(F.to_json(request)) + id_bytes + 1


#: Signs that Spark writes as %XX in the names of folders.
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def write_requests(lines: DataFrame, path: str, dataset: str = "dataset") -> None:
    """Writes `line` as JSON lines, a folder `dataset=../chunk=..` with one file for each chunk, in order of position.

    Rows without a chunk are left out: they fit no file.  In a folder that is mounted (no scheme, or file:) the tasks write
    the files themselves, each under another name first, as Spark's writer starts a program for the rights of each file there.
    """
    spark = lines.sparkSession
    named = lines.where("chunk is not null").withColumn(dataset, F.nullif(F.col(dataset).cast("string"), F.lit("")))  # one folder for both
    dealt = named.repartition(dataset, "chunk").sortWithinPartitions(dataset, "chunk", "position")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file":
        dealt.select(dataset, "chunk", "line").write.partitionBy(dataset, "chunk").text(path)
        return
    if fs.exists(target):
        raise FileExistsError(path)
    root = fs.makeQualified(target).toUri().getPath()

    def put(rows: list[tuple[str | None, int, str]]) -> int:
        name, chunk, _ = rows[0]
        named = _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", name) if name else "__HIVE_DEFAULT_PARTITION__"
        folder = f"{root}/{dataset}={named}/chunk={chunk}"
        os.makedirs(folder, exist_ok=True)
        draft = f"{folder}/_{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8", newline="") as f:
            f.writelines(f"{line}\n" for _, _, line in rows if line is not None)
        os.replace(draft, f"{folder}/part-00000.txt")
        return len(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for _, rows in groupby(of_rows, key=lambda r: r[:2]):
            yield pa.RecordBatch.from_pydict({"n": [put(list(rows))]})

    os.makedirs(root)
    dealt.select(dataset, "chunk", "line").mapInArrow(run, "n bigint").agg(F.sum("n")).collect()
    open(f"{root}/_SUCCESS", "w").close()


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """The lines of write_requests, with dataset and chunk.  The driver lists the folders: a task for each takes far longer."""
    key = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    before = spark.conf.get(key)
    spark.conf.set(key, str(2**31 - 1))
    try:
        return spark.read.text(path)
    finally:
        spark.conf.set(key, before)
