"""Time the registered queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each query runs to a sink that discards rows, so every row and column is computed. Model
queries read their stored upstream models; `full_refresh` builds all of them from the
landing rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

from table_queries import all_queries, settings, shared_dir, warehouse
from vigil.plans.pipeline import Warehouse
from vigil.session import get_session

HEADLINE = [
    "confirmed_by_week_and_county", "flatten_events", "record_hash_dedup", "stream_ingest",
    "latest_per_key", "epi_week_range_join", "role_playing_dates", "lookup_cascade",
    "lookup_cascade_large", "age_years", "turnaround", "result_and_outcome_rules",
    "running_total", "domain_union_summary", "slv_adam_cases", "slv_adam_travellers",
    "slv_lims_results", "dim_labtest", "dim_laboratory", "fct_case_investigation",
    "fct_screening", "fct_lab_result", "fct_treatment_outcome", "report_case_investigation",
    "report_contact_registration", "report_treatment_outcome", "report_screening",
    "report_lab_result", "report_case_trend", "report_laboratory_summary",
    "report_geographic_summary",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    queries, seconds = all_queries(), {}

    def full_refresh() -> None:
        root = f"{shared_dir(spark)}/vigil-{uuid.uuid4().hex}"
        Warehouse(spark, root, warehouse(spark, sf).landing, settings(spark, sf)).build()

    if not sys.argv[1:]:
        warehouse(spark, sf).build()  # warm-up, and the store the model queries read
        seconds["full_refresh"] = timed(full_refresh)
    for name in names:
        run = lambda: queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        run()
        seconds[name] = statistics.median(timed(run) for _ in range(repeats))
    seconds = {k: round(v, 3) for k, v in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
