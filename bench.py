"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables and BENCH_CPUS the number of local cores. Every
query starts from the tables; nothing is shared between them but a warm session.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from patronage.plans.catalog import QUERIES
from patronage.staging import drop_staged

HEADLINE = (
    "clean_stats",
    "rfm_base",
    "rfm_from_lines",
    "rfm_quartiles",
    "profile_by_quartile",
    "segment_lookup",
    "recommendations",
    "scaled_features",
    "silhouette_fixed",
    "elbow_pick",
    "hist_monetary",
    "grid_by_group",
    "box_monetary",
    "point_sample",
    "kmeans_customers",
    "gmm_customers",
    "model_scores",
    "cost_sweep",
    "segmented_customers",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("patronage-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["rfm_quartiles"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    drop_staged(spark)
    spark.stop()


if __name__ == "__main__":
    main()
