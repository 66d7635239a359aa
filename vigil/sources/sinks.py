"""Writing observation tables.  A run writes both tables to folders of its own, and the ledger, written last, says whose rows count."""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import small
from ..schemas import PROCESS_LAUNCHES, SHELL_INPUTS

TABLES = ("shell_inputs", "process_launches")
LEDGER = "dataset string, run string, at bigint, removed boolean, complete boolean"
#: The columns of a table that has never been written.
EMPTY = dict(zip(TABLES, (SHELL_INPUTS, PROCESS_LAUNCHES)))


def _folder(dataset: Column) -> Column:
    """The name of a dataset's folders.  The letter in front keeps names that look like numbers, empty ones and null apart."""
    return F.coalesce(F.concat(F.lit("d:"), dataset), F.lit("none"))


def write_observations(shell: DataFrame, launches: DataFrame, root: str, complete: bool = True) -> None:
    """Writes both tables under root as a new run and then enters its datasets in the ledger.

    Readers see the rows of a dataset's last run, in both tables together: until the ledger is written they see those
    from before, and a job that dies earlier leaves everything as it was.  A dataset that has rows in one table only has
    none in the other.  With complete=False, say for a run over a sample or up to a limit, readers see the rows, and the
    dataset stays pending.  Any text can name a dataset; null is a dataset of its own.
    """
    run = f"r{uuid.uuid4().hex}"
    for name, df in zip(TABLES, (shell, launches)):
        df.withColumns({"run": F.lit(run), "part": _folder(F.col("dataset"))}).write.mode("append").partitionBy("run", "part").parquet(f"{root}/{name}")
    # the datasets that were written: their one column is read back, so that the rows are not made again
    written = [shell.select("dataset").limit(0)]
    for name in TABLES:
        if _exists(shell.sparkSession, folder := f"{root}/{name}/run={run}"):  # without rows there is none
            written.append(shell.sparkSession.read.schema(T.StructType([shell.schema["dataset"]])).parquet(folder).select("dataset"))
    _note(reduce(DataFrame.union, written).distinct(), root, run, removed=False, complete=complete)


def _note(datasets: DataFrame, root: str, run: str, removed: bool, complete: bool = True) -> None:
    noted = datasets.select("dataset", F.lit(run).alias("run"), F.lit(time.time_ns()).alias("at"), F.lit(removed).alias("removed"), F.lit(complete).alias("complete"))
    noted.coalesce(1).write.mode("append").parquet(f"{root}/ingested")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, run, complete) that count: each dataset's last entry, unless it removed it.  Without a ledger there are none."""
    if not _exists(spark, f"{root}/ingested"):
        return spark.createDataFrame([], "dataset string, run string, complete boolean")
    last = F.row_number().over(Window.partitionBy("dataset").orderBy(F.col("at").desc(), F.col("run").desc())) == 1
    return spark.read.schema(LEDGER).parquet(f"{root}/ingested").withColumn("_last", last).where("_last and not removed").select("dataset", "run", "complete")


def finished(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, run) of the datasets whose last run was complete."""
    return ledger(spark, root).where("complete").select("dataset", "run")


def read_observations(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of a table (one of TABLES) that count; none before the first run.  Other runs are pruned by their folders."""
    if not _exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], EMPTY[name])
    found = spark.read.parquet(f"{root}/{name}").schema
    kept = T.StructType([f for f in found.fields if f.name not in ("run", "part")])
    rows = spark.read.schema(kept.add("run", "string").add("part", "string")).parquet(f"{root}/{name}")  # else folders named by digits become numbers
    runs = ledger(spark, root).select("run", _folder(F.col("dataset")).alias("part"))
    return rows.join(small(runs), ["run", "part"], "left_semi").drop("run", "part")


def pending(wanted: DataFrame, spark: SparkSession, root: str) -> DataFrame:
    """The rows of `wanted` whose dataset has no complete run."""
    done = finished(spark, root).select(F.col("dataset").alias("_done"))
    return wanted.join(done, wanted["dataset"].eqNullSafe(done["_done"]), "left_anti")


def remove_stored(spark: SparkSession, root: str, *datasets: str | None) -> None:
    """Removes datasets from both stored tables and the ledger: first for readers, then the files.  Unknown names change nothing."""
    _note(spark.createDataFrame([(d,) for d in datasets], "dataset string"), root, "", removed=True)
    fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in TABLES:
        for d in datasets:
            folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName("none" if d is None else f"d:{d}")
            for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/run=*")) or []:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), f"part={folder}"), True)


def remove_datasets(tables: dict[str, DataFrame], *datasets: str) -> dict[str, DataFrame]:
    """Each table that has a `dataset` column without these datasets; a null dataset stays, other tables are unchanged."""
    keep = F.col("dataset").isNull() | ~F.col("dataset").isin(*datasets)
    return {name: df.where(keep) if "dataset" in df.columns else df for name, df in tables.items()}


def collect_results(requests: DataFrame, results: DataFrame, key: str, value: str, valid: tuple[str, ...]) -> DataFrame:
    """requests with `value` and `status`: ok, invalid (no valid label), repeated (several answers) or missing."""
    n = results.groupBy(key).agg(F.count("*").alias("_n"), F.min(value).alias("_v"))
    status = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "repeated").when(F.coalesce(F.col("_v").isin(*valid), F.lit(False)), "ok").otherwise("invalid")
    return requests.join(n, key, "left").withColumn("status", status).withColumn(value, F.when(F.col("status") == "ok", F.col("_v"))).drop("_n", "_v")
