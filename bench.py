"""Seconds of the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS], as one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINES = (
    "selection_report",
    "util_trend",
    "feature_trend",
    "history_summary_all",
    "trend_summary_by_tag",
    "scope_summaries",
    "daily_p95",
    "risk_metrics",
    "heat_map",
    "daily_grid",
    "seasonal_naive_forecast",
    "seasonal_naive_backtest",
    "forecast_daily",
    "actions",
    "risk_probabilities",
    "item_diff",
    "inv_summary",
    "domain_dirs",
)


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    here = os.path.dirname(os.path.abspath(__file__))
    sys.path.insert(0, here)
    os.environ["PYTHONPATH"] = f"{here}:{os.environ.get('PYTHONPATH', '')}"
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from headroom.plans.queries import queries

    known, took = queries(), {}
    known["risk_metrics"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the JVM's compilers
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(","):
        began = time.time()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
