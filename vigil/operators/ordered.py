"""What a row needs to know of the earlier or later rows of its key, for keys of any size.

A window over a key puts all its rows into one task.  Here rows are dealt by ranges of (key, order), so that a key with
many rows lies over several ranges and every range holds about as many rows.  Inside a range a window does the work.  At
most one key of a range began in an earlier one, its first; what the ranges before say about that key is one value a range,
and these values are composed along the ranges and carried in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..lineage import staged

_OWN = ("_range", "_row", "_head", "_tail")


class Ordered:
    """df dealt by ranges of keys and order (ascending, null first): `rows` is df in that form, on which the methods add columns.

    Rows of a key that tie in `order` stay together.  Only the keys at the ends of the ranges, and one value a range for each
    column, go through the driver; their number is that of the ranges (spark.sql.shuffle.partitions, or `parts`).
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], parts: int | None = None):
        self.spark, self.keys, self.columns = df.sparkSession, keys, df.columns
        by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
        parts = parts or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
        table = staged(dealt.withColumns({"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "ordered", free=False)
        key = F.struct(*keys)
        ends = sorted(table.groupBy("_range").agg(F.min(key).alias("low"), F.max(key).alias("high")).collect())
        #: (range, whether its first key began before, whether its last key goes on, whether one key fills it)
        self.ranges, edges = [], []
        for i, r in enumerate(ends):
            head = i > 0 and ends[i - 1].high == r.low
            tail = i + 1 < len(ends) and ends[i + 1].low == r.high
            self.ranges.append((r._range, head, tail, r.low == r.high))
            if r.low == r.high:
                edges += [(r._range, *r.low, head, tail)] if head or tail else []
            else:
                edges += [(r._range, *r.low, True, False)] if head else []
                edges += [(r._range, *r.high, False, True)] if tail else []
        self.split = bool(edges)
        if self.split:
            kinds = T.StructType([T.StructField("_range_at", T.IntegerType()), *(T.StructField(f"_range_key{i}", df.schema[k].dataType) for i, k in enumerate(keys)), T.StructField("_head", T.BooleanType()), T.StructField("_tail", T.BooleanType())])
            bound = F.broadcast(self.spark.createDataFrame(edges, kinds))  # two rows a range at most
            same = F.col("_range") == F.col("_range_at")
            for i, k in enumerate(keys):
                same = same & F.col(k).eqNullSafe(F.col(f"_range_key{i}"))
            table = table.join(bound, same, "left").drop("_range_at", *(f"_range_key{i}" for i in range(len(keys))))
        self.rows = table

    def _carried(self, df: DataFrame, summary: Column, compose: Callable, backward: bool) -> DataFrame | None:
        """(_at, _carry): for each range that a key enters, what the ranges before (or behind) say about that key."""
        part = df.where("_head" if backward else "_tail").groupBy("_range").agg(summary.alias("_range_carry"))
        said = dict(map(tuple, part.where("_range_carry is not null").collect()))
        out, state = [], None
        for at, head, tail, whole in reversed(self.ranges) if backward else self.ranges:
            entered = tail if backward else head
            state = state if entered else None
            if state is not None:
                out.append((at, state))
            state = compose(state if whole else None, said.get(at))
        kinds = T.StructType([T.StructField("_range_at", T.IntegerType()), T.StructField("_range_carry", part.schema["_range_carry"].dataType)])
        return F.broadcast(self.spark.createDataFrame(out, kinds)) if out else None

    def _with(self, df: DataFrame, name: str, own: Column, summary: Column, compose: Callable, join: Callable[[Column, Column], Column], backward: bool = False) -> DataFrame:
        df = df.withColumn(name, own)
        carried = self._carried(df, summary, compose, backward) if self.split else None
        if carried is None:
            return df
        enters = "_tail" if backward else "_head"
        both = df.join(carried, (F.col("_range") == F.col("_range_at")) & F.col(enters), "left")
        return both.withColumn(name, join(F.col(name), F.col("_range_carry"))).drop("_range_at", "_range_carry")

    def last(self, df: DataFrame, value: Column, name: str, strict: bool = False) -> DataFrame:
        """df (made of `rows`) with the last non-null value of the key at or before each row; strict: before it."""
        w = Window.partitionBy("_range", *self.keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
        df = df.withColumn("_range_value", value)
        out = self._with(df, name, F.last("_range_value", ignorenulls=True).over(w), F.max_by("_range_value", F.when(F.col("_range_value").isNotNull(), F.col("_row"))), lambda a, b: a if b is None else b, lambda x, c: F.coalesce(x, c))
        return out.drop("_range_value")

    def next(self, df: DataFrame, value: Column, name: str, strict: bool = False) -> DataFrame:
        """df with the first non-null value of the key at or after each row; strict: after it."""
        # backwards, so that each row is taken once: a frame up to the end is walked anew for every row
        w = Window.partitionBy("_range", *self.keys).orderBy(F.col("_row").desc()).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
        df = df.withColumn("_range_value", value)
        out = self._with(df, name, F.last("_range_value", ignorenulls=True).over(w), F.min_by("_range_value", F.when(F.col("_range_value").isNotNull(), F.col("_row"))), lambda a, b: a if b is None else b, lambda x, c: F.coalesce(x, c), True)
        return out.drop("_range_value")

    def most(self, df: DataFrame, value: Column, name: str, strict: bool = False) -> DataFrame:
        """df with the largest value of the key at or before each row; strict: before it.  Null values do not count."""
        w = Window.partitionBy("_range", *self.keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
        df = df.withColumn("_range_value", value)
        larger = lambda a, b: b if a is None else a if b is None else max(a, b)
        return self._with(df, name, F.max("_range_value").over(w), F.max("_range_value"), larger, lambda x, c: F.greatest(x, c)).drop("_range_value")

    def total(self, df: DataFrame, value: Column, name: str, strict: bool = False) -> DataFrame:
        """df with the sum of the key's values (long, null counts as 0) at or before each row; strict: before it."""
        w = Window.partitionBy("_range", *self.keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
        df = df.withColumn("_range_value", F.coalesce(value.cast("long"), F.lit(0)))
        out = self._with(df, name, F.coalesce(F.sum("_range_value").over(w), F.lit(0)), F.sum("_range_value"), lambda a, b: (a or 0) + (b or 0), lambda x, c: x + F.coalesce(c, F.lit(0)))
        return out.drop("_range_value")

    def done(self, df: DataFrame) -> DataFrame:
        """df without the columns of this form."""
        return df.drop(*_OWN)
