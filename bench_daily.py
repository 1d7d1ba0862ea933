"""Time the stages of one day's batch on generated sources.

DAILY_SCALE 1 is about a thousand applications, BENCH_CPUS sets the local cores and
DAILY_DIR the folder to work in (default: a new temporary one). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from datetime import date, datetime

from pyspark.sql import SparkSession

from lendscape.operators import quality as q
from lendscape.plans import daily, suites
from lendscape.session import tune
from lendscape.sources.synth import all_sources
from lendscape.specs import SOURCES


def main() -> None:
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    scale = float(os.environ.get("DAILY_SCALE", "20"))
    folder = os.environ.get("DAILY_DIR") or tempfile.mkdtemp(prefix="daily-")
    spark = (
        tune(SparkSession.builder.master(f"local[{cpus}]").appName("daily"), 0, cpus)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name, df in all_sources(spark, scale).items():
        df.write.option("header", True).csv(f"{folder}/in/{SOURCES[name].files[-1]}")

    lake, seconds = daily.Lake(f"{folder}/lake"), {}

    def timed(stage, action):
        start = time.perf_counter()
        result = action()
        seconds[stage] = round(time.perf_counter() - start, 2)
        return result

    rows = {}
    for number, day in enumerate((date(2026, 5, 12), date(2026, 5, 13)), start=1):
        at = datetime(day.year, day.month, day.day, 1)
        landed = timed(f"land_{number}", lambda: daily.land(spark, f"{folder}/in", lake, day, at))
        rows = {r.table: r.rows_written for r in landed.values()}
        timed(f"bronze_gate_{number}", lambda: q.gate(daily.bronze_gate(spark, lake, day)))
        timed(f"refine_{number}", lambda: daily.refine(spark, lake, day))
        timed(f"silver_gate_{number}", lambda: q.gate(daily.silver_gate(spark, lake)))
        marts = timed(f"model_{number}", lambda: daily.model(spark, lake, at))
        timed(
            f"gold_gate_{number}",
            lambda: q.gate(q.evaluate(spark, marts, suites.gold_suites(marts))),
        )
        timed(f"summary_{number}", lambda: daily.summarise(spark, lake, marts, at))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "daily_batch_seconds",
                "value": round(sum(seconds.values()), 2),
                "unit": "sec",
                "stages": seconds,
                "rows_landed": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
