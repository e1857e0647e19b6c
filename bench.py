"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores),
BENCH_REPEATS (default 2; the best run counts), BENCH_QUERIES (comma-separated names).
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "cash_flow_change", "free_cash_flow", "prepared_statements", "balance_imputation", "join_company", "lookup_company",
    "companies_by_place", "null_profile", "describe", "corr_matrix", "reconcile", "extremes", "group_mean_fill",
    "fuse_years_weighted", "fuse_years_pct", "label_encode", "standardize", "stratified_folds", "outlier_limits",
    "drop_outlier_rows", "f_regression", "f_classif", "page_fields", "nearest_embeddings", "nearest_companies",
    "knn_imputation", "knn_classification", "edited_companies", "tomek_links", "smote", "isolation_forest",
    "classification_metrics", "balance_long", "kpi_by_year", "random_forest_regressor", "score_valuation",
)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from firmlens.plans import QUERIES
    from firmlens.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
            if runs[-1] > 20:  # long enough for one run to tell
                break
        times[name] = round(min(runs), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
