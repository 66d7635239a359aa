"""Exact top-k search by inner product, in three phases with a uniform threshold.

Vectors are cut into m slices of dimensions, and each slice is scored apart, as if it lay on a node of its own.
  1. Every slice gives a local list of its highest scores for each query.  The ids on the lists are scored exactly, and
     the k-th best of them is a safe cutoff: the true k-th best is no lower.
  2. The cutoff goes to the slices.  A vector whose total reaches it has a slice score of at least cutoff / m, so each
     slice gives all its entries from there on.
  3. Entries are merged by id.  Totals that all slices have given are exact; the remaining ones whose upper bound still
     reaches the cutoff are scored exactly, and the k best stay.

Vectors that are equal are one class with its k + 1 smallest ids: a larger id could never be in a result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut

SLICES = 2
#: Vectors in a packed block of candidates or queries, and candidate blocks that share one group of the grid.
BLOCK, GROUP_BLOCKS = 1024, 16
PACKED = "slice int, dim int, ids binary, data binary, floors binary"
LOWEST = -(2**62)


def quantized(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double; null for null vectors, those with null or non-finite components, and
    those so long that an inner product might not fit 64 bits (squares that sum to 2**62 or more; see top_k)."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    square = F.aggregate(embedding, F.lit(0.0), lambda s, x: s + (F.abs(x.cast("double")) * scale + 1) * (F.abs(x.cast("double")) * scale + 1))
    return F.when(~bad & (square < 2.0**62), F.transform(embedding, lambda x: F.floor(x.cast("double") * scale)))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, exactly: in doubles while no sum can reach 2**53, and in 64-bit integers beyond."""
    most = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * a.shape[1]
    return (a.astype(float) @ b.astype(float).T).astype(np.int64) if most < 2**53 else a @ b.T


def _bounds(dim: int, slices: int) -> list[int]:
    return [dim * j // slices for j in range(slices + 1)]


def _pack(rows: DataFrame, slices: int, block: int) -> DataFrame:
    """Blocks of up to `block` vectors (id, v, floor) of one dimension and group `qb`; a row for each slice of a block."""

    def run(batches):
        waiting: dict[tuple, list] = {}

        def blocks(key):
            ids, data, floors = zip(*waiting.pop(key))
            x, at = np.stack(data), _bounds(key[1], slices)
            n = range(slices)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * slices, pa.int64()), pa.array(list(n), pa.int32()), pa.array([key[1]] * slices, pa.int32()), pa.array([np.array(ids, np.int64).tobytes()] * slices, pa.binary()),
                 pa.array([x[:, at[j] : at[j + 1]].tobytes() for j in n], pa.binary()), pa.array([np.array(floors, np.int64).tobytes()] * slices, pa.binary())],
                names=["qb", "slice", "dim", "ids", "data", "floors"],
            )

        for b in batches:
            for qb, i, v, floor in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                values = v.values.to_numpy(zero_copy_only=False)
                key = qb, len(values)
                waiting.setdefault(key, []).append((i, values, floor))
                if len(waiting[key]) == block:
                    yield blocks(key)
        for key in list(waiting):
            yield blocks(key)

    return rows.select("qb", "id", "v", "floor").mapInArrow(run, "qb bigint, " + PACKED)


def _matrix(ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(data, np.int64).reshape(len(i), -1)


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _grid(candidates: DataFrame, n_blocks: int, queries: DataFrame, n_groups: int) -> DataFrame:
    """Each block of candidates beside each block of queries, slice by slice: an equi-join on (query block, group, slice).

    Candidate blocks are copied once for each of the n_groups query blocks, and query blocks once for each group of
    candidate blocks, so that no task gets more than a group of blocks.
    """
    groups = max(1, math.ceil(n_blocks / GROUP_BLOCKS))
    left = candidates.drop("qb").withColumn("g", F.pmod(F.xxhash64("ids"), F.lit(groups))).withColumn("qb", F.explode(_numbers(n_groups)))
    right = queries.withColumn("g", F.explode(_numbers(groups))).select("qb", "g", "slice", F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("floors").alias("q_floors"))
    return left.join(right.hint("shuffle_hash"), ["qb", "g", "slice"]).where("dim = q_dim").select("slice", "ids", "data", "q_ids", "q_data", "q_floors")


ENTRIES = "query bigint, slice int, id bigint, score bigint"


def _entries(query, at, ids, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(np.full(len(ids), at), pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["query", "slice", "id", "score"])


def _local_lists(grid: DataFrame, k: int) -> DataFrame:
    """Phase 1: the k highest slice scores of each query among the candidates of a task."""

    def run(batches):
        best: dict[tuple, tuple] = {}

        def flush():
            for (at, q), (ids, scores) in best.items():
                queries = np.repeat(np.frombuffer(q, np.int64), ids.shape[1])
                yield _entries(queries, at, ids.ravel(), scores.ravel())
            best.clear()

        for b in batches:
            for at, ids, data, q_ids, q_data in zip(*(b.column(c).to_pylist() for c in ("slice", "ids", "data", "q_ids", "q_data"))):
                i, x = _matrix(ids, data)
                scores = product(_matrix(q_ids, q_data)[1], x)
                i = np.broadcast_to(i, scores.shape)
                if (old := best.get((at, q_ids))) is not None:
                    i, scores = np.hstack([old[0], i]), np.hstack([old[1], scores])
                if scores.shape[1] > k:
                    top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                    i, scores = np.take_along_axis(i, top, 1), np.take_along_axis(scores, top, 1)
                best[at, q_ids] = np.ascontiguousarray(i), scores
                if len(best) > 64:
                    yield from flush()
        yield from flush()

    return grid.mapInArrow(run, ENTRIES)


def _above(grid: DataFrame) -> DataFrame:
    """Phase 2: all entries whose slice score reaches the query's uniform threshold."""

    def run(batches):
        for b in batches:
            for at, ids, data, q_ids, q_data, floors in zip(*(b.column(c).to_pylist() for c in ("slice", "ids", "data", "q_ids", "q_data", "q_floors"))):
                i, x = _matrix(ids, data)
                q, y = _matrix(q_ids, q_data)
                scores = product(y, x)
                row, column = np.nonzero(scores >= np.frombuffer(floors, np.int64)[:, None])
                yield _entries(q[row], at, i[column], scores[row, column])

    return grid.mapInArrow(run, ENTRIES)


def _resolved(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """pairs (query, id) with their exact total."""
    a = heads.select(F.col("id").alias("query"), F.col("v").alias("qv"))
    dot = F.aggregate(F.zip_with("qv", "v", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
    return pairs.join(heads, "id").join(a, "query").select("query", "id", dot.alias("total"))


def top_k(df: DataFrame, k: int = 5, query_every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", slices: int = SLICES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible by query_every, the k highest inner
    products with the other rows' vectors (fewer if there are no more); ties go to the smaller id.

    Components x count as floor(256 * x).  Rows with a null id, or a vector that is null, empty or holds null or non-finite
    components, take no part, nor do vectors longer than about 2**31 / 256, whose products might not fit 64 bits.  Rows that
    repeat an id are rows of their own: each is a candidate, its id may come more than once in a result, and each asks
    a query, so equal rows give equal results.  Vectors of different length have no product.  Extra columns are left
    out.  Empty tables give empty results.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(f"`{vector_col}`")).alias("v")).where("id is not null and v is not null and size(v) > 0")
    rows = cut(rows)
    # a class of equal vectors goes by a number; `first` is its smallest id
    classes = cut(rows.groupBy("v").agg(F.min("id").alias("first")).withColumn("c", F.monotonically_increasing_id()))
    same = Window.partitionBy("v").orderBy("id")
    members = rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1).join(classes, "v").select("c", "id", "place")
    members = cut(members.withColumn("repeat", F.row_number().over(Window.partitionBy("c", "id").orderBy("place"))).drop("place"))
    heads = classes.select(F.col("c").alias("id"), "v")
    firsts = classes.select(F.col("c").alias("id"), "first")
    asked = rows.where(F.pmod("id", F.lit(query_every)) == 0).groupBy("id", "v").agg(F.count("*").alias("times"))
    asked = cut(asked.join(classes, "v").select(F.col("id").alias("query_id"), F.col("c").alias("head"), "times"))
    queries = asked.select(F.col("head").alias("id")).distinct().join(heads, "id")
    n_groups = max(1, math.ceil(queries.count() / BLOCK))
    group = F.pmod(F.xxhash64("id"), F.lit(n_groups)) if n_groups > 1 else F.lit(0).cast("long")
    packed = cut(_pack(heads.withColumn("qb", F.lit(0).cast("long")).withColumn("floor", F.lit(LOWEST)), slices, BLOCK))
    n_blocks = packed.count() // slices

    def grid(floored: DataFrame) -> DataFrame:
        q = floored.withColumn("qb", group).repartition(n_groups, "qb")
        return _grid(packed, n_blocks, _pack(q, slices, BLOCK), n_groups)

    wanted = k + 1  # classes: the query's own may be among them
    local = _local_lists(grid(queries.withColumn("floor", F.lit(LOWEST))), wanted)
    in_list = Window.partitionBy("query", "slice").orderBy(F.col("score").desc(), "id")
    listed = local.withColumn("place", F.row_number().over(in_list)).where(F.col("place") <= wanted).select("query", "id").distinct()
    by_total = Window.partitionBy("query").orderBy(F.col("total").desc(), "id")
    cutoffs = _resolved(listed, heads).withColumn("place", F.row_number().over(by_total)).where(F.col("place") == wanted).select(F.col("query").alias("id"), F.col("total").alias("cutoff"))
    known = cut(queries.join(cutoffs, "id", "left").withColumn("floor", F.coalesce(F.ceil(F.col("cutoff") / slices), F.lit(LOWEST))))
    merged = cut(
        _above(grid(known)).groupBy("query", "id").agg(F.sum("score").alias("sum"), F.count("*").alias("n"))
        .join(known.select(F.col("id").alias("query"), "cutoff", "floor"), "query")
        .where((F.col("n") == slices) | F.col("cutoff").isNull() | (F.col("sum") + (slices - F.col("n")) * (F.col("floor") - 1) >= F.col("cutoff")))
    )
    exact = merged.where(F.col("n") == slices).select("query", "id", F.col("sum").alias("total"))
    totals = exact.unionByName(_resolved(merged.where(F.col("n") < slices).select("query", "id"), heads))
    by_first = Window.partitionBy("query").orderBy(F.col("total").desc(), "first")
    best = totals.join(firsts, "id").withColumn("place", F.row_number().over(by_first)).where(F.col("place") <= wanted).select("query", F.col("id").alias("c"), "total")
    near = best.join(members, "c").withColumn("place", F.row_number().over(by_total)).where(F.col("place") <= wanted)
    final = Window.partitionBy("query_id", "head").orderBy(F.col("total").desc(), "id")
    own = (F.col("c") == F.col("head")) & (F.col("id") == F.col("query_id")) & (F.col("repeat") == 1)
    return (
        near.select(F.col("query").alias("head"), "c", "id", "repeat", "total").join(asked, "head").where(~own)
        .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
        .withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
        .select("query_id", "rank", F.col("id").alias("vec_id"), F.col("total").alias("score"))
    )
