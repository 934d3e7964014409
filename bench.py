"""Time the headline queries; prints one JSON line.

Every query runs to a sink that keeps nothing, so each row and column is
computed; the better of two runs counts, but for the whole hourly job, which runs once. One untimed query first starts the engine and the Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelcast.session import build_session  # noqa: E402
from panelcast_checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "trip_totals",
    "dense_hourly_shipments",
    "lags_hourly_shipments",
    "statistics_hourly_1_day",
    "statistics_hourly_1_week",
    "statistics_hourly_1_month",
    "statistics_hourly_3_months",
    "statistics_at_horizon",
    "date_features_daily",
    "feature_table",
    "feature_table_hourly",
    "errors_of_price_rule",
    "errors_by_split_and_series",
    "errors_by_fold",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("statistics_hourly_events")
    times = {name: min(run(name) for _ in range(1 if name == "feature_table_hourly" else 2)) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
