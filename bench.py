"""Times the headline queries on one machine and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tallyworks.registry import QUERIES  # noqa: E402

DATA_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3

HEADLINE = [
    "ad_features",
    "ad_features_event_grain",
    "daily_stats",
    "daily_revenue",
    "spike_diagnosis",
    "top5_ads_daily",
    "top10_ctr",
    "ctr_median_avg",
    "platform_sets",
    "orphan_click_platforms",
    "click_first_ads",
    "late_click_count",
    "never_active_share",
    "first_ad_gap",
    "describe_trips",
    "busiest_taxi",
    "avg_taxi_income",
    "trips_by_hour",
    "top_tip_dates",
    "top_car_model_trips",
    "clean_passengers",
    "passenger_features",
    "word_count",
    "linreg_simple",
    "dt_reg",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tallyworks-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per Column
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str) -> float:
    """Seconds for the whole query, every result row produced; jobs that build the frame count too."""
    started = time.perf_counter()
    QUERIES[name](spark, DATA_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = session()
    QUERIES["scan_parquet"](spark, DATA_DIR).collect()
    seconds = {name: round(min(timed(spark, name) for _ in range(REPEATS)), 3) for name in HEADLINE}
    spark.stop()
    folder = Path(DATA_DIR).name
    result = {
        "metric": "headline queries, sum of best-of-three wall times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(folder[2:]) if folder.startswith("sf") else folder,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
