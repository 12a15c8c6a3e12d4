"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import catalog  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402

HEADLINE = (
    "daily_totals", "open_balances_policy", "roll_one_day", "rebuild_balances", "loan_day_report",
    "upsert_payments", "forecast_schedule", "recalculate_schedule",
    "loan_cycle", "revenue", "revenue_snapshot_day", "form_fields", "application_state",
    "attributes_with_expiry",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)  # warm-up
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds over headline queries, each the median of 3 after one warm-up",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
