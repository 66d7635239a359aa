"""Evidence about processes: lifetimes, touched objects, templates, and scoring of samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import asof_last, asof_next, range_join
from .ordered import Ordered
from .selection import numbered


def observed_times(events: DataFrame, host: str, pid: str, at: str, is_creation: Column, is_reboot: Column) -> DataFrame:
    """(host, pid, at, what): each time at which a process was created or a host started (`reboot`, without pid), once."""
    what = F.when(is_reboot, "reboot").when(is_creation, "creation")
    own = F.when(what == "creation", F.col(pid))
    return events.select(host, own.alias(pid), at, what.alias("what")).where("what is not null").dropna(subset=[at]).distinct()


def lifetimes(creations: DataFrame, reboots: DataFrame, host: str, pid: str, at: str, owner: str) -> DataFrame:
    """(host, pid, at, owner, stop): lives of processes from their creation, included, to the next creation of their pid or
    the next reboot of their host, excluded; null while neither is known.  Of creations at one time the smallest owner counts.
    """
    born = creations.groupBy(host, pid, at).agg(F.min(owner).alias(owner))
    ends = born.select(host, pid, at, F.col(at).alias("_next"))
    lives = asof_next(born, ends, [host, pid], at, ["_next"])
    lives = asof_next(lives, reboots.select(host, at, F.col(at).alias("_boot")), host, at, ["_boot"])
    return lives.select(host, pid, at, owner, F.least("_next", "_boot").alias("stop"))


def lifetime_owner(events: DataFrame, creations: DataFrame, reboots: DataFrame, host: str, pid: str, at: str, owner: str) -> DataFrame:
    """events with the owner of the process lifetime they fall into, or null; an event at the creation's time belongs to it."""
    lives = lifetimes(creations, reboots, host, pid, at, owner)
    e = asof_last(events, lives, [host, pid], at, [owner, "stop"], strict=False)
    return e.withColumn(owner, F.when(F.col("stop").isNull() | (F.col(at) < F.col("stop")), F.col(owner))).drop("stop")


def bounded_intervals(intervals: DataFrame, creations: DataFrame, reboots: DataFrame, host: str, pid: str, start: str, at: str, tolerance: int) -> DataFrame:
    """intervals (host, pid, start and others) with `cutoff`: the first creation of the pid or reboot of the host that ends them, excluded, or null.

    Starts may be rounded down by up to `tolerance` units: a creation less than that after the start is the interval's own,
    and only the one after it ends the interval.  A reboot at the start ends nothing.
    """
    times = creations.select(host, pid, at).distinct()
    born = asof_next(times, times.select(host, pid, at, F.col(at).alias("_then")), [host, pid], at, ["_then"]).withColumnRenamed(at, start)
    i = asof_next(intervals, born.select(host, pid, start, F.col(start).alias("_born"), "_then"), [host, pid], start, ["_born", "_then"], strict=False)
    i = asof_next(i, reboots.select(host, F.col(at).alias(start), F.col(at).alias("_boot")), host, start, ["_boot"])
    own = F.col("_born") < F.col(start) + tolerance
    return i.withColumn("cutoff", F.least(F.when(own, F.col("_then")).otherwise(F.col("_born")), "_boot")).drop("_born", "_then", "_boot")


def in_intervals(events: DataFrame, intervals: DataFrame, host: str, pid: str, at: str, start: str, end: str, name: str = "inside") -> DataFrame:
    """events with `name`: whether an interval of their (host, pid) holds them: start and end included, cutoff excluded.

    Intervals may overlap.  Along the starts, the furthest end so far says for every event whether one still runs, so no
    pair of event and interval is made.  Times are whole numbers; an end or cutoff that is null does not bound.
    """
    last = F.least(F.coalesce(F.col(end), F.lit((1 << 63) - 1)), F.coalesce(F.col("cutoff") - 1, F.lit((1 << 63) - 1)))
    spans = intervals.where(last >= F.col(start)).select(host, pid, F.col(start).alias(at), last.alias("_last"), F.lit(0).alias("_event"))
    both = Ordered(events.withColumns({"_last": F.lit(None).cast("long"), "_event": F.lit(1)}).unionByName(spans, allowMissingColumns=True), [host, pid], [at, "_event"])
    reached = both.most(both.rows, F.col("_last"), "_far").where("_event = 1")
    return reached.select(*[c for c in events.columns if c != name], F.coalesce(F.col("_far") >= F.col(at), F.lit(False)).alias(name))


def touched_spans(touches: DataFrame, key: str, object_: str, at: str) -> DataFrame:
    """(key, object, first, last): from the first to the last time at which a key touched an object, both included."""
    return touches.groupBy(key, object_).agg(F.min(at).alias("first"), F.max(at).alias("last"))


def object_relations(events: DataFrame, touches: DataFrame, key: str, object_: str, at: str, bucket: int) -> DataFrame:
    """events with `touched`: the sorted objects that their key touched at or before and again at or after them, or null.

    The begins and ends of a key's spans cut its time into stretches in which the set of objects does not change.  An event
    meets its one stretch, and a set is made once for each stretch that has events, so no event is repeated.  Times are
    whole numbers; `bucket` is a length of time for joining spans with stretches.
    """
    spans = touched_spans(touches, key, object_, at)
    edges = spans.select(key, F.col("first").alias(at)).union(spans.select(key, F.col("last") + 1)).distinct().withColumn("_stretch", F.col(at))
    placed = asof_last(events, edges, key, at, ["_stretch"], strict=False)
    met = placed.where("_stretch is not null").select(key, F.col("_stretch").alias("_begin")).distinct()
    inside = range_join(met, spans, key, F.col("_begin"), F.col("first"), F.col("last"), bucket=bucket)
    sets = inside.groupBy(F.col(key).alias("_k"), F.col("_begin").alias("_b")).agg(F.array_sort(F.collect_set(object_)).alias("touched"))
    joined = placed.join(sets, (F.col(key) == F.col("_k")) & (F.col("_stretch") == F.col("_b")), "left")
    return joined.select(*[c for c in events.columns if c != "touched"], "touched")


def fill_templates(templates: DataFrame, pool: DataFrame, key: str, text: str, seed: str, variants: int = 1, bound: dict[str, str] | None = None) -> DataFrame:
    """templates with `filled`: each <name> takes a value of pool (name, value), the same for all of its places; `variant` counts from 0.

    A value is the one at an index among the name's values in order; the index comes from a hash of seed, key, variant and
    name.  bound: {name: group}; names of one group share the index, so that their values go together (say a host and its
    address).  The first variant is drawn as without variants.  A name without values stays.
    """
    order = Window.partitionBy("name").orderBy("value")
    entries = pool.where("value is not null").distinct().withColumns({"i": F.row_number().over(order) - 1, "n": F.count("*").over(Window.partitionBy("name"))})
    many = templates.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))))
    names = many.select(key, "variant", F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(r"<([a-z]+)>"), F.lit(1)))).alias("name"))
    sizes = entries.where("i = 0").select("name", "n")
    group = F.col("name")
    for name, shared in (bound or {}).items():
        group = F.when(F.col("name") == name, F.lit(f"={shared}")).otherwise(group)
    parts = [F.lit(seed), F.col(key), F.when(F.col("variant") > 0, F.col("variant")), group]
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 6), 16, 10).cast("long")
    chosen = names.join(sizes, "name").withColumn("i", (draw % F.col("n")).cast("int")).join(entries.drop("n"), ["name", "i"])
    values = chosen.groupBy(key, "variant").agg(F.collect_list(F.struct("name", "value")).alias("_values"))
    put = F.aggregate(F.coalesce("_values", F.array()), F.col(text), lambda s, v: F.replace(s, F.concat(F.lit("<"), v["name"], F.lit(">")), v["value"]))
    return many.join(values, [key, "variant"], "left").withColumn("filled", put).select(*[c for c in templates.columns if c not in ("variant", "filled")], "variant", "filled")


def score_samples(samples: DataFrame, scorer: Callable[[pd.Series], pd.Series], text: str, valid: tuple[str, ...]) -> DataFrame:
    """samples with `raw_prediction` and `prediction`: an answer that is no valid label counts as unknown, none stays null."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield p.assign(raw_prediction=scorer(p[text]))

    scored = samples.mapInPandas(run, samples.drop("raw_prediction", "prediction").schema.add("raw_prediction", "string"))
    raw = F.lower(F.trim("raw_prediction"))
    return scored.withColumn("prediction", F.when(raw.isin(*valid), raw).when(raw.isNotNull(), "unknown"))


def pending_samples(samples: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """samples that have no result of status ok yet."""
    return samples.join(results.where("status = 'ok'").select(key), key, "left_anti")


def capped_first_seen(df: DataFrame, identity: list[str], shape: list[str], order: str, cap: int) -> DataFrame:
    """The first row of each identity, at most `cap` of each shape, with `index` along the whole result.

    Rows are made distinct first, so the cap counts kept rows only.
    """
    first = df.groupBy(*shape, *[c for c in identity if c not in shape]).agg(F.min(order).alias(order))
    place = F.row_number().over(Window.partitionBy(*shape).orderBy(order))
    kept = first.withColumn("_n", place).where(F.col("_n") <= cap).drop("_n")
    return numbered(kept, order, "index")
