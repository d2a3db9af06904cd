"""Time the headline queries: one warm-up, then the median of BENCH_RUNS runs into a no-op sink.

Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES (names) set the run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from pyspark.sql import SparkSession

from merchlens.plans import all_queries

HEADLINE = [
    "agg_15_sales", "agg_15", "agg_6", "agg_8", "agg_12", "agg_14", "agg_19", "cln_3", "ses_1", "ses_2", "val_6", "dq_1", "prc_1",
    "prc_9", "prc_10", "fct_2", "fct_4", "fct_6", "seg_6", "rec_4", "rec_12", "evl_7", "ing_1", "spl_1", "jn_15", "mon_2", "smp_1",
    "prc_2", "seg_2", "fct_7",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g")).config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC").config("spark.log.level", "ERROR").getOrCreate()
    )
    took = {}
    for name in names:
        query = all_queries()[name]
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query.run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times[1:] or times), 3)
    sf = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": float(sf.group(1)) if sf else folder,
    }))


if __name__ == "__main__":
    main()
