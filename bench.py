"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the data, BENCH_CPUS the local cores, BENCH_QUERIES (comma-separated or
``all``) other queries. Each query is run in full into a sink that discards the rows; the time
is the median of BENCH_RUNS runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from lendscape.registry import QUERIES
from lendscape.session import tune

HEADLINE = (
    "silver_application",
    "silver_bureau",
    "silver_installments",
    "latest_per_composite_key",
    "upsert_merge",
    "upsert_composite",
    "scd2_two_snapshots",
    "scd2_history_from_log",
    "dim_applicant",
    "fact_loan_application",
    "fact_bureau_credit",
    "fact_installment_payment",
    "fk_orphans",
    "kpi_default_rate",
    "kpi_segment_rates",
    "kpi_exposure_per_applicant",
    "kpi_summary",
    "credit_quantiles",
    "applicant_features",
    "dq_suite",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE

    size = sum(os.path.getsize(f"{sf_dir}/{f}") for f in os.listdir(sf_dir))
    builder = tune(SparkSession.builder.master(f"local[{cpus}]").appName("bench"), size, cpus)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-"))

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
