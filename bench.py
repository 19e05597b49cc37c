"""Times the headline queries and prints one JSON line.

A `cold` time starts from the raw tables: the query builds every layer it needs.
A `warm` time is a report on a star schema that is already built.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse.session import get_session  # noqa: E402
from verification.queries import QUERIES, forget_warehouses, warehouse  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COLD = ("dedup_refunds", "reconciliation_base", "dq_report", "risk_summary", "fact_refund", "vw_executive_summary")
RAW = ("incremental_slice_orders", "checkpoint_events", "dq_raw_uniqueness", "surrogate_key_orders", "stream_events_ingest")
WARM = (
    "dq_report",
    "rule_refund_amount",
    "contract_violations",
    "vw_executive_summary",
    "vw_merchant_risk",
    "bi_kpis",
    "bi_risk_by_merchant",
    "bi_chargeback_reasons",
    "bi_top_risk_merchants",
    "bi_refund_vs_chargeback",
    "bi_sliced_summary",
)


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    spark = get_session(
        "bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()

    run("scan_transactions")  # start the JVM's code paths once, outside the times
    seconds = {}
    for name in COLD:
        forget_warehouses()
        seconds[f"{name}_cold"] = timed(lambda name=name: run(name))
    for name in RAW:
        seconds[name] = timed(lambda name=name: run(name))
    forget_warehouses()
    built = warehouse(spark, FOLDER)
    seconds["star_schema_cold"] = timed(built.build_gold)
    for name in WARM:
        seconds[f"{name}_warm"] = timed(lambda name=name: run(name))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
