"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times into a sink that discards the rows;
its value is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgermill.session import build_session  # noqa: E402
from ledgermill.testing.queries import QUERIES  # noqa: E402

HEADLINE = (
    "dim_customer",
    "dim_account",
    "dim_card",
    "fact_transaction",
    "fact_app_session",
    "fact_app_event",
    "customer_scd2",
    "customer_360",
    "daily_transaction_summary",
    "mcc_risk_enriched_transactions",
    "pipeline_operations_dashboard",
    "bronze_load",
    "stored_fact_transaction",
    "warehouse_build",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_QUERIES")
    scratch = tempfile.mkdtemp(prefix="bench-")  # of this machine, which is the whole cluster here
    extra = {"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"), "spark.checkpoint.dir": scratch}
    spark = build_session(f"local[{cpus}]", int(cpus), **extra)
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in only.split(",") if only else HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
