"""Time the headline queries; prints one JSON line.

The loan, economic and scored tables are derived from the order tables first and
written, as the reference finds its input tables ready; that time is reported as
``stage_tables``.  Each query then runs in full, all its rows and columns
written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "good_loan", "as_of_panel", "ao_history", "ao_servicer", "ao_payment", "target_pairs", "target_status",
    "target_assist", "trg_upb_exp", "target_window", "window_balance", "censor_guard", "strata_counts", "strata_rates",
    "stratified_sample", "stratified_sample_exact", "random_sample", "per_slice_sample", "two_stage_sample",
    "balanced_target_sample", "rollup_econ", "multi_date_join", "econ_losses", "prop_values", "refi_incentive",
    "training_table", "bucket_split", "feature_stats", "level_index", "unseen_default", "score_softmax", "bias_fit",
    "curves", "curves_quantile", "ks", "ks_by_slice", "decile", "decile_by_slice", "segment_quantile", "axis_range",
    "marginal_distribution", "marginal_response", "r_squared", "model_softmax", "job_hazard",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from checks.compare import spark_session
    from loanpanel.plans.queries import all_queries
    from loanpanel.sources import fixtures
    spark = spark_session(cores)
    times = {}
    start = time.time()
    for name in ("loans", "econ", "scored"):
        fixtures.staged(spark, sf_dir, name)
    times["stage_tables"] = round(time.time() - start, 3)
    known = all_queries()
    for name in names:
        start = time.time()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
