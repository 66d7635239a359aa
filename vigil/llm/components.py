"""Connected components of an edge table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, release


#: Edge ends that a task takes at least, and nodes up to which labels are sent to every task (16 bytes each).
TASK_ENDS, SENT_NODES = 100_000, 100_000


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of edges (a, b): component is the smallest node that can be reached.

    Each round takes the smallest label among a node's neighbours, passes it on to the node that was its label before,
    and then takes the label of its label, so paths shrink by about half.  Labels are aggregated before the shuffle; no
    neighbour list is ever collected.  Rounds end in the shared folder, so a lost executor costs one round at most.  Tables
    of few rows are held by few tasks, whatever the number of shuffle partitions, so that short rounds write few files.
    An empty edge table gives an empty result.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    n = both.count()
    tasks = max(1, -(-n // TASK_ENDS))
    held = (lambda df: df.coalesce(tasks)) if tasks < int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")) else (lambda df: df)
    sent = F.broadcast if n <= SENT_NODES else (lambda df: df)  # there are no more nodes than ends
    both = held(both)
    labels = cut(held(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"))))
    for _ in range(rounds):
        seen = both.join(sent(labels.withColumnsRenamed({"node": "b", "label": "l"})), "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l"))
        least = held(seen).join(sent(labels), "node").select("node", F.least("label", "l").alias("next"), F.col("label").alias("old"))
        hooks = held(least.groupBy(F.col("old").alias("node")).agg(F.min("next").alias("hook")))
        least = least.join(sent(hooks), "node", "left").select("node", F.least("next", "hook").alias("next"), "old")
        jump = sent(labels.select(F.col("node").alias("next"), F.col("label").alias("far")))
        after = cut(held(least.join(jump, "next").select("node", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("old")).alias("moved"))))
        moved = after.where("moved").limit(1).count()
        labels = after.select("node", "label")
        if not moved:
            release(edges.sparkSession)
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"components were not settled after {rounds} rounds")
