"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query computes its whole result (a `noop` write). `silver` and `quality_log` start from the raw tables; the gold
queries read the silver table, whose build is timed as `silver_build`. `value` is the sum of the first runs;
`repeat` holds the median of further runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.compare import local_session
from checks.queries import all_queries, tables

HEADLINE = (
    "dedup_exact", "dedup_latest", "impute_engagement", "impute_salary", "silver", "quality_log", "bronze_gate",
    "expectations_bronze", "expectations_silver", "protect_pii", "check_pk", "check_fk", "group_median",
    "monthly_series", "granular_series", "productivity_by_area", "cohort_join", "area_risk_proxy", "nine_box",
    "root_cause", "action_plan", "kpi_cover", "workforce_plan", "plan_gap", "scd2_employee", "dim_employee",
    "fact_departure", "fact_headcount", "turnover_ltm", "nine_box_view", "turnover_cost_ltm", "departure_careers",
    "departure_profiles", "star_constraints",
    "funnel", "attrition_labels", "attrition_scores", "model_metrics", "risk_by_area", "top_risk", "csv_roundtrip",
    "silver_partitions", "incremental_ingest", "intake_quarantine", "funnel_by_cohort", "stratified_split", "encode_city",
    "rule_auc",
)
ONCE = {"attrition_scores", "model_metrics"}  # the forest is trained once per session, so a repeat only reads results
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    registered = all_queries()
    spark.read.parquet(f"{folder}/orders.parquet").write.format("noop").mode("overwrite").save()

    def once(name: str) -> float:
        started = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    started = time.perf_counter()
    tables(spark, folder).staged.count()
    seconds = {"silver_build": round(time.perf_counter() - started, 3)}
    repeat: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds[name] = once(name)
        if REPEATS and name not in ONCE:
            repeat[name] = statistics.median(once(name) for _ in range(REPEATS))
    print(json.dumps({
        "metric": "workforce_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "repeat": repeat, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
