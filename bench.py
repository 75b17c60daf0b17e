"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice, whole result to a no-op sink; the better time counts. One
that takes over ``LONG`` seconds runs once.
Inputs that a query prepares once per session (the raw site files and their
sniff for ``ingest_union``, the stored models for ``profile_chain`` and
``score_batch``) therefore fall into its first run: ``ingest_union`` times the
parse and union alone, ``profile_chain`` and ``score_batch`` loading and scoring
without training. ``ingest_clean`` times sniff, parse, cleaning and write; the
training and tree queries time all of their fits.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import QUERIES  # noqa: E402
from estrato.session import local_session  # noqa: E402

LONG = 30

HEADLINE = (
    "site_summary", "clean_rows", "numeric_coerce", "null_column_profile", "load_clean",
    "ingest_union", "ingest_clean",
    "corr_matrix", "corr_all_numeric", "depth_profile_nspt", "depth_profile_by_item",
    "impute_median", "impute_mode", "standardize", "one_hot", "feature_vector",
    "train_test_split", "split_composite_key", "kfold_assign",
    "regression_metrics_by", "residuals", "model_leaderboard",
    "fit_ridge", "grid_search_linear", "score_batch",
    "parse_requests", "profile_grid", "profile_chain", "profile_export", "csv_roundtrip",
    "fit_random_forest", "fit_gbt", "grid_search_trees", "train_target",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(cores, cores, "bench", **{"spark.checkpoint.dir": f"file:{shared}"})
    times = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
            if runs[-1] > LONG:
                break
        times[name] = round(min(runs), 3)
        print(name, times[name], file=sys.stderr)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
