"""Benchmark: headline queries, one JSON line.

BENCH_SF_DIR  directory of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from saldora import catalog  # noqa: E402
from saldora.session import local_session  # noqa: E402

HEADLINE = [
    "c16_clean_churn_report", "c17_clean_campaign_report", "v9_no_duplicates",
    "a2_column_profile", "a7_skew_audit", "qa0_customer_profile", "qa0b_churn_summary",
    "qa4_churn_by_balance_quartile", "qa5_churn_by_recency", "qa7_high_balance_high_churn",
    "qb0_campaign_summary", "qb2_adoption_by_age_band", "qb3_adoption_by_job",
    "qb8_above_average_groups", "qb9_adoption_by_balance_quartile", "m12_metrics_by_month",
    "t1_mann_whitney_balance_churn", "t5_chi_square_prior_contact",
    "t_7_bootstrap_median_difference", "k6_davies_bouldin", "k8_segment_profile",
    "e7_model_evaluation", "e8_threshold_sweep", "e15_capacity",
    "f7_stratified_split_campaign", "f8_stratified_folds", "f11_logistic_regression",
    "f13_random_forest", "w1_ntile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus=cpus, partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("qb3_adoption_by_job")  # start-up of the session, the readers and the compiler
    times = {name: round(run(name), 3) for name in HEADLINE}
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
