"""Schemas, label domains and row contracts of the observation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARED = "dataset string, record_id string, dataset_label string, group_id string, session_id string, os string, ai_label string, override_label string, label string"
PROCESS_LAUNCHES = "pgm string, pgm_base string, args array<string>, " + SHARED
SHELL_INPUTS = "shell_input string, pgms array<string>, tokens array<string>, " + SHARED
SESSION_LABELS = "dataset string, session_id string, ai_label string, override_label string, label string"
INGESTED = "dataset string, ingested boolean"

FINAL_LABELS = ("malicious", "benign", "unknown")
DATASET_LABELS = (*FINAL_LABELS, "malicious-group")
SYSTEMS = ("windows", "linux")


def breach(program: str | None = None) -> Column:
    """The first contract that a row breaks, or null: required texts, label domains, and a group id if and only if the label speaks for a group."""
    need = [c for c in (program, "dataset", "record_id", "session_id") if c]
    known = lambda c, names: F.col(c).isNull() | F.col(c).isin(*names)
    rules = [(F.coalesce(F.col(c), F.lit("")) == "", f"no {c}") for c in need]
    rules += [(F.col("dataset_label").isNull() | ~F.col("dataset_label").isin(*DATASET_LABELS), "dataset_label not allowed")]
    rules += [(~known(c, FINAL_LABELS), f"{c} not allowed") for c in ("ai_label", "override_label")]
    rules += [(F.col("label").isNull() | ~F.col("label").isin(*FINAL_LABELS), "label not allowed"), (~known("os", SYSTEMS), "os not allowed")]
    rules += [((F.col("dataset_label") == "malicious-group") & F.col("group_id").isNull(), "no group_id"), ((F.col("dataset_label") != "malicious-group") & F.col("group_id").isNotNull(), "group_id without a group")]
    return F.coalesce(*[F.when(broken, F.lit(reason)) for broken, reason in rules])


def audited(df: DataFrame, reason: Column, record: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, audit table of all rows: record, action, reason).  Nothing is dropped unseen."""
    decided = df.withColumn("_reason", reason)
    audit = decided.select(record, F.when(F.col("_reason").isNull(), "kept").otherwise("skipped").alias("action"), F.col("_reason").alias("reason"))
    return decided.where("_reason is null").drop("_reason"), audit


def strict(df: DataFrame, reason: Column) -> DataFrame:
    """df, or an error that names the first broken contract met."""
    return df.where(F.when(reason.isNull(), True).otherwise(F.raise_error(reason).cast("boolean")))
