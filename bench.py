"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores), BENCH_RUNS (default 3, after
one warm-up; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from loanloom.plans.catalog import registered
from loanloom.session import build_session

HEADLINE = [
    "w2_normalised_curve",
    "d6_vintage_curve",
    "d5_yearly_irr",
    "d7_product_repayment_report",
    "a5_reconcile_balances",
    "a6_quarterly_collected_pct",
    "j2_loan_cashflows",
    "p15_features_default",
    "f3_filter_audit",
    "u2_dedupe",
    "r5_transaction_flags",
    "m12_underwrite",
    "a11_score_percentiles",
    "a14_lift_quantiles",
    "a16_classification_report",
    "a22_roc_auc",
    "a25_welch_t",
    "a26_spearman",
    "w4_percentile_bucket",
    "w5_learning_curve",
]


def seconds(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("OFF")
    queries, timings = registered(), {}
    for name in sys.argv[1:] or HEADLINE:
        build = queries[name].build
        seconds(build, spark, sf_dir)
        timings[name] = round(statistics.median(seconds(build, spark, sf_dir) for _ in range(runs)), 3)
    result = {
        "metric": "headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "spark": spark.version,
        "cpus": int(cpus),
        "runs": runs,
        "date": time.strftime("%Y-%m-%d"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
