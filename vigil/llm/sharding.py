"""Sharding: a uniform shuffle into shards of exact sizes.

The rows lie in P partitions.  How many rows of each partition go to each shard is one row of a random matrix with fixed
row and column sums, which has a multivariate hypergeometric law.  Rows are permuted inside their partition, exchanged by
the matrix, and permuted again inside their shard, which is cut into cells that a task can sort.

The matrix is never held as a whole.  It is drawn along a binary tree over the partitions: at each node the shards' open
places are split between the left and the right half.  Every node has a random generator of its own, seeded by its
bounds, so a task walks down to its own row alone, and a task that runs again draws the same numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import fresh, staged, without

#: Rows of a cell on average: what one task sorts in the last permutation.
CELL_ROWS = 2048
#: monotonically_increasing_id() has the partition above these bits, and the place in it below.
PLACE_BITS = 33


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """A draw of how many of n are good.  Beyond numpy's limit of 1e9: inversion, outwards from the mode."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    low, high = max(0, n - bad), min(n, good)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    lg = math.lgamma
    log = lambda a, b: lg(a + 1) - lg(b + 1) - lg(a - b + 1)
    left = right = mode
    p_left = p_right = math.exp(log(good, mode) + log(bad, n - mode) - log(good + bad, n))
    u = rng.random() - p_left
    while u > 0 and (left > low or right < high):
        if right < high:
            p_right *= (good - right) * (n - right) / ((right + 1) * (bad - n + right + 1))
            right += 1
            u -= p_right
            if u <= 0:
                return right
        if left > low:
            p_left *= left * (bad - n + left) / ((good - left + 1) * (n - left + 1))
            left -= 1
            u -= p_left
            if u <= 0:
                return left
    return mode


def split(rng: np.random.Generator, places: np.ndarray, n: int) -> np.ndarray:
    """How many of n rows fall into each shard, of which `places` are open: multivariate hypergeometric."""
    if places.sum() < 1_000_000_000:
        return rng.multivariate_hypergeometric(places, n, method="marginals")
    out, rest = np.zeros_like(places), int(places.sum())
    for c, open_ in enumerate(places):
        rest -= int(open_)
        out[c] = hypergeometric(rng, int(open_), rest, n)
        n -= int(out[c])
    return out


def matrix_row(counts: np.ndarray, places: np.ndarray, i: int, seed: int) -> np.ndarray:
    """Row i of the matrix with row sums `counts` and column sums `places`."""
    before = np.r_[0, np.cumsum(counts)]
    low, high = 0, len(counts)
    while high - low > 1:
        mid = (low + high) // 2
        left = split(np.random.default_rng([seed, low, high]), places, int(before[mid] - before[low]))
        low, high, places = (low, mid, left) if i < mid else (mid, high, places - left)
    return places


def shard_rows(df: DataFrame, shards: int = 16, seed: int = 17, cell_rows: int = CELL_ROWS, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """df with shard_col (0 to shards - 1) and slot_col (gapless from 0 in each shard): a uniform random shuffle.

    Shard sizes differ by one row at most; equal texts are rows like any others and may part.  The rows are first written
    to the shared folder together with their partition and place, so the matrix holds however the table is split when it
    is read again.  The driver gets one number for each partition.  Repeated rows, null and long values are rows like any
    other; with fewer rows than shards, some shards are empty.  Columns named shard_col or slot_col are replaced.  An
    empty table gives an empty result.
    """
    df = without(df, shard_col, slot_col)
    place, cell, order, before = fresh([*df.columns, shard_col, slot_col], "place", "cell", "order", "before")
    rows = staged(df.withColumn(place, F.monotonically_increasing_id()), "shards")
    found = dict(rows.groupBy(F.shiftright(place, PLACE_BITS).alias("p")).count().collect())
    parts = np.array(sorted(found), np.int64)
    counts = np.array([found[p] for p in parts.tolist()], np.int64)
    total = int(counts.sum())
    places = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    cells = max(1, -(-total // (shards * cell_rows)))  # of each shard

    def targets(i: int) -> np.ndarray:
        """The shard of each place of partition number i, after its own permutation."""
        row = matrix_row(counts, places, i, seed)
        return np.random.default_rng([seed, i]).permutation(np.repeat(np.arange(len(row)), row))

    @F.pandas_udf("int")
    def dealt(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        last, shards_at = -1, None
        for ids in batches:
            part, at = np.searchsorted(parts, ids.to_numpy() >> PLACE_BITS), ids.to_numpy() & ((1 << PLACE_BITS) - 1)
            out = np.zeros(len(ids), np.int32)
            for i in np.unique(part):
                if i != last:
                    last, shards_at = int(i), targets(int(i))
                out[part == i] = shards_at[at[part == i]]
            yield pd.Series(out)

    # a shard's order is by cell, then by hash inside it; slots follow from how many rows the cells before have
    own_cell = F.col(shard_col).cast("long") * cells + F.pmod(F.xxhash64(F.lit(seed + 1), F.col(place)), F.lit(cells))
    placed = rows.withColumn(shard_col, dealt(place)).withColumn(cell, own_cell)
    sizes = placed.select(shard_col, cell).groupBy(shard_col, cell).count()
    earlier = Window.partitionBy(shard_col).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(cell, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias(before))
    own = Window.partitionBy(cell).orderBy(order, place)
    within = placed.withColumn(order, F.xxhash64(F.lit(seed), F.col(place))).withColumn(slot_col, (F.row_number().over(own) - 1).cast("long"))
    return within.join(starts, cell).select(*[F.col(f"`{c}`") for c in df.columns], shard_col, (F.col(slot_col) + F.col(before)).alias(slot_col))
