"""Time the named queries and print one JSON line.

BENCH_SF_DIR   folder of Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default: all)
BENCH_QUERIES  comma-separated names, or "all" (default: HEADLINE)

Every query runs completely (all rows are produced and dropped), reading its tables anew. One untimed query warms up
the JVM first.
"""

from __future__ import annotations

import json
import os
import time

from hourgrid.plans.queries import QUERIES
from hourgrid.session import get_spark
from hourgrid.staging import release

HEADLINE = (
    "profile_raw", "raw_csv_roundtrip", "station_hour", "station_locations", "reindexed", "iqr_caps", "quality_counts",
    "cleaned", "features", "features_range", "split_counts", "baseline_metrics", "baseline_by_station",
    "hourly_profile", "weekday_hour_pivot", "top_stations", "volatility", "peak_hours", "map_table", "station_slice",
    "crowding_alerts", "summary", "gbt_encoding_of_many", "gbt_default_predictions", "gbt_boosted",
    "daily_station_day", "daily_caps", "daily_cleaned", "daily_features", "daily_baseline_metrics", "daily_volatility",
    "daily_borough_totals", "supplier_grid_totals", "supplier_features",
    # The first of these builds the store by month in two batches, the others read ranges of it.
    "monthly_updated", "monthly_range", "monthly_computed_range",
    # The first of these runs the search of 18 trials, the second the final fit; the last reads what they stored.
    "gbt_trials", "gbt_predictions", "gbt_metrics",
)


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 4)
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    names = list(QUERIES) if chosen == ["all"] else chosen
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["features"], spark, folder)
    times = {name: round(run(QUERIES[name], spark, folder), 3) for name in names}
    release(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
