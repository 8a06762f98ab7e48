"""Time the headline queries; prints one JSON line.

`BENCH_SF_DIR` is the folder of tables, `BENCH_CPUS` the local cores, `BENCH_ALL=1` times every
registered query. Each query runs three times; the total counts the medians. `parts` splits them
into building the frame, planning it and running it.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from seriesmart.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "ingest_append_coerce",
    "stg_dedupe",
    "stg_labour_force",
    "dim_series_decoded",
    "fct_labour_force",
    "mart_national",
    "mart_region",
    "mart_ftpt",
    "mart_industry",
    "calendar_and_positional_lag",
    "kpi_labels",
    "page_overview",
    "page_state",
    "figures_json",
    "dq_overlap",
    "dq_report",
    "diff_tables",
]


def timed(query, spark: SparkSession, directory: str) -> tuple[float, float, float]:
    """Seconds of building, planning and running a query."""
    at = [time.perf_counter()]
    df = query(spark, directory)
    at.append(time.perf_counter())
    df._jdf.queryExecution().executedPlan()
    at.append(time.perf_counter())
    df.write.format("noop").mode("overwrite").save()
    at.append(time.perf_counter())
    return tuple(b - a for a, b in zip(at, at[1:]))


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("seriesmart-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["mart_national"](spark, directory).write.format("noop").mode("overwrite").save()
    seconds, parts = {}, {}
    for name in names:
        runs = [timed(QUERIES[name], spark, directory) for _ in range(3)]
        seconds[name] = round(median(map(sum, runs)), 3)
        steps = ("build", "plan", "run")
        parts[name] = {step: round(median(r[k] for r in runs), 3) for k, step in enumerate(steps)}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, median of three runs each after one warm-up",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "parts": parts,
                "sf": Path(directory).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
