"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

from vigil.plans import catalog
from vigil.session import build_session

HEADLINE = ("launch_counts", "apply_labels", "window_range_join", "nearest_time_join", "boot_epoch_asof", "idle_sessions", "stratified_sample", "confusion_matrix", "unique_commands", "merge_summaries", "table_diff", "regex_rules")


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    shared = tempfile.mkdtemp(prefix="spark-")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__checkpoint__dir=shared)
    spark.sparkContext.setLogLevel("ERROR")
    began = time.perf_counter()
    for _ in range(3):  # a fixed job, to tell a slow machine from slow code
        spark.range(30_000_000, numPartitions=int(cpus)).selectExpr("sum(hash(id, id % 1000))").collect()
    calibration = round((time.perf_counter() - began) / 3, 3)
    found = {}
    for name in HEADLINE:
        times = []
        for _ in range(1 + repeats):  # the first warms up
            began = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        found[name] = round(median(times[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, sum of median wall seconds", "value": round(sum(found.values()), 3), "unit": "sec", "queries": found, "sf": os.path.basename(folder), "calibration_sec": calibration}))
    sys.stdout.flush()


if __name__ == "__main__":
    main()
