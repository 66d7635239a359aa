"""Topics fitted on all texts: clusters of the words that they use, set against other texts of their language.

A text is a vector of how often its words fall into hashed buckets.  The mean vector of its language is taken off, so that
topics cut across languages, and Lloyd's rounds of k-means run over the staged vectors of all rows.  Vectors are whole
numbers, and so are their sums: the centres are the same however the rows are split, and a task that runs again changes
nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import cut, fresh

#: Topics, buckets of words, rounds, and what a share of 1 counts as in a vector.
TOPICS, BUCKETS, ROUNDS, UNIT = 6, 128, 6, 4096
#: Groups (languages) whose sums a task holds before it passes them on.
GROUPS_HELD = 1000
_ENDS = " .,;:!?()[]{}<>\"'|*#-_"


def bucket_of(word: str, buckets: int = BUCKETS) -> int:
    """The bucket of a word, without the punctuation around it and in lower case."""
    return zlib.crc32(word.strip(_ENDS).lower().encode()) % buckets


def word_vectors(counts: np.ndarray) -> list[bytes]:
    """A packed vector of 16-bit numbers for each row of counts: the roots of the buckets' shares."""
    share = counts / np.maximum(1, counts.sum(1, keepdims=True))
    return [v.tobytes() for v in np.rint(UNIT * np.sqrt(share)).astype("<i2")]


def _unpack(vectors, means) -> np.ndarray:
    """Vectors less their group's mean, rounded to whole numbers."""
    v = np.frombuffer(b"".join(vectors), "<i2").reshape(len(vectors), -1).astype(np.float64)
    return np.rint(v - np.frombuffer(b"".join(means), "<f4").reshape(v.shape))


def group_means(rows: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, mean): the mean vector of each group, null among them, packed as 32-bit floats.  Rows without a vector take no part."""

    def sums(batches):
        held: dict = {}

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(held), kind), pa.array([t.tolist() for _, t in held.values()], pa.list_(pa.int64())), pa.array([n for n, _ in held.values()], pa.int64())], names=["g", "s", "n"])

        for b in batches:
            kind, names = b.schema.types[0], b.column(0).dictionary_encode()
            codes, v = names.indices.fill_null(-1).to_numpy(), np.frombuffer(b"".join(b.column(1).to_pylist()), "<i2").reshape(len(b), -1)
            for c in np.unique(codes).tolist():
                g = None if c < 0 else names.dictionary[c].as_py()
                n, total = held.get(g, (0, 0))
                held[g] = n + int((codes == c).sum()), total + v[codes == c].sum(0, dtype=np.int64)
                if len(held) > GROUPS_HELD:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    @F.pandas_udf("binary")
    def mean(totals: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([(np.asarray(t, np.float64) / k).astype("<f4").tobytes() for t, k in zip(totals, n)], dtype=object)

    parts = rows.where(F.col(vector).isNotNull()).select(F.col(group).alias("g"), vector).mapInArrow(sums, f"g {rows.schema[group].dataType.simpleString()}, s array<bigint>, n bigint")
    spread = parts.select("g", "n", F.posexplode("s").alias("at", "x")).groupBy("g", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    whole = spread.groupBy("g", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda p: p["x"]).alias("s"))
    return cut(whole.select("g", mean("s", "n").alias("mean")))


def fit_topics(rows: DataFrame, vector: str, mean: str, topics: int = TOPICS, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """The centres, one row each, the largest topic first.  rows: packed vectors with the mean of their group.

    It begins with a random direction for each topic; a topic that no row is nearest to goes.  The driver gets one sum of
    vectors for each topic.
    """
    used = rows.where(F.col(vector).isNotNull()).select(vector, mean)
    width = BUCKETS
    centres, bias = np.random.default_rng(seed).standard_normal((topics, width)), np.zeros(topics)
    sizes = np.zeros(topics, np.int64)
    for _ in range(rounds):

        def sums(batches, centres=centres, bias=bias):
            n, total = np.zeros(topics, np.int64), np.zeros((topics, width), np.int64)
            for b in batches:
                v = _unpack(b.column(0).to_pylist(), b.column(1).to_pylist()) if len(b) else np.zeros((0, width))
                best = np.argmax(v @ centres.T - bias, 1)
                np.add.at(n, best, 1)
                np.add.at(total, best, v.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(range(topics), pa.int32()), pa.array(n), pa.array(total.tolist(), pa.list_(pa.int64()))], names=["t", "n", "s"])

        got = used.mapInArrow(sums, "t int, n bigint, s array<bigint>").where("n > 0").select("t", "n", F.posexplode("s").alias("at", "x"))
        sizes, centres = np.zeros(topics, np.int64), centres.copy()
        for r in got.groupBy("t", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect():  # topics x buckets numbers
            sizes[r.t] = r.n
            centres[r.t, r.at] = r.x / r.n
        bias = np.where(sizes > 0, (centres**2).sum(1) / 2, np.inf if sizes.any() else 0.0)
    return centres[np.argsort(-sizes, kind="stable")][: max(1, int((sizes > 0).sum()))]


def nearest_topic(vector: str, mean: str, centres: np.ndarray) -> Column:
    """`topic 1`, `topic 2` and so on: that of the nearest centre; `none` without a vector."""
    bias = (centres**2).sum(1) / 2

    @F.pandas_udf("string")
    def name(vectors: pd.Series, means: pd.Series) -> pd.Series:
        out = pd.Series(["none"] * len(vectors), dtype=object)
        at = np.flatnonzero(vectors.notna())
        if len(at):
            out.iloc[at] = [f"topic {1 + t}" for t in np.argmax(_unpack(list(vectors.iloc[at]), list(means.iloc[at])) @ centres.T - bias, 1)]
        return out

    return name(F.col(vector), F.col(mean))


def with_means(rows: DataFrame, group: str, vector: str, mean: str) -> DataFrame:
    """rows with the mean vector of their group."""
    key = fresh([*rows.columns, mean], "g")[0]
    means = group_means(rows, group, vector).withColumnsRenamed({"g": key, "mean": mean})
    few = means.limit(GROUPS_HELD + 1).count() <= GROUPS_HELD
    return rows.join(F.broadcast(means) if few else means, F.col(f"`{group}`").eqNullSafe(F.col(key)), "left").drop(key)
