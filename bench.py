"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local threads.  Every query is
planned and run in full (measuring the panel included); results are written to
the no-op sink.  The first run of a query warms the JVM, the second is timed.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from checks.catalog import QUERIES

HEADLINE = [
    "clean_panel",
    "finalise",
    "aqi_table",
    "aqi_table_daily",
    "features",
    "state_mean_ci",
    "kpis",
    "monthly_median_aqi",
    "state_summary",
    "month_box",
    "category_share",
    "correlation_daily",
    "pollutant_histograms",
    "temporal_split",
    "pollutant_densities",
    "quality_profile",
    "aqi_lags",
    "burn_by_timestamp",
    "ml_linear",
    "ml_forest",
    "ml_boosted",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hazeframe-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    line = {"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
