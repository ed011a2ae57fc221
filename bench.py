"""Time the headline queries: one JSON line on standard output.

Settings from the environment: BENCH_SF_DIR (folder of the Parquet tables) and BENCH_CPUS.
Each query runs once to warm up code generation and file caches and is then timed three times,
of which the median counts; the long ones are timed on one run after the others. Results are written to Spark's ``noop``
sink, so the whole result is computed and none of it is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from epitally.plans.catalog import QUERIES

# A fit is far longer than its warm-up effects, so it runs once.
RUN_ONCE = ("forest_predictions", "whole_batch")

HEADLINES = (
    "global_summary",
    "continent_summary",
    "top_countries",
    "profile_one_pass",
    "quality_checks",
    "landing_lines",
    "document_parse",
    "lake_main_parquet",
    "lake_partitioned",
    "lake_analyst_csv",
    "lake_dual_write",
    "upsert_mysql_rule",
    "upsert_postgres_rule",
    "upsert_latest",
    "history_merge",
    "bucketed_merge",
    "kept_totals",
    "quarantine_rows",
    "stratified_split_rows",
    "assemble_features",
    "hash_split_rows",
    "evaluation",
    "trend",
    "forest_predictions",
    "whole_batch",
)


def compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("epitally-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        taken = []
        for _ in range(1 if name in RUN_ONCE else 4):
            started = time.perf_counter()
            compute(QUERIES[name](spark, base))
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        spark.catalog.clearCache()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
