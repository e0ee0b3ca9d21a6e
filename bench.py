"""Timings of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from epiledger.plans.reports import Inputs, results_of  # noqa: E402
from epiledger.sources import testbed  # noqa: E402
from epiledger.sources.shared import scratch_tables  # noqa: E402
from epiledger.sources.sinks import for_each_result  # noqa: E402
from verification.queries import ORDER, QUERIES  # noqa: E402

HEADLINE = [
    "clean_records",
    "country_frame_rows",
    "facts_frame_rows",
    "global_metrics",
    "country_summary",
    "daily_summary",
    "country_daily_summary",
    "vaccination_summary",
    "hospitalization_summary",
    "regional_summary",
    "country_summary_raw",
    "daily_summary_raw",
    "country_summary_estimated",
    "regional_summary_level1",
    "country_row_counts",
    "period_summary",
    "resample_weekly_cumulative",
    "monthly_top_countries",
    "country_month_pivot",
    "kpis",
    "ranked_breakdown",
    "metric_correlations",
    "metric_quartiles",
    "data_quality",
]


def shared_run(spark: SparkSession, sf_dir: str) -> None:
    """What a user runs: the seven results off one clean table."""
    s = testbed.load(spark, sf_dir)
    inputs = Inputs(s.cases, s.index, s.vaccinations, s.hospitalizations, s.demographics)
    with scratch_tables(spark):
        for_each_result(
            results_of(inputs, order_by=ORDER), lambda _, df: df.write.format("noop").mode("overwrite").save()
        )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["daily_summary"](spark, sf_dir).collect()  # class loading, not timed
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    shared_run(spark, sf_dir)
    seconds["shared_run"] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
