"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowbench.plans.catalog import REGISTRY
from flowbench.session import local_session

HEADLINE = [
    "describe_numeric", "correlation_matrix", "duplicate_report", "twin_overlap", "split_stratified", "clip_quantile", "standardize",
    "prepare_dataset", "supplier_report", "gaussian_nb", "knn_classify", "fit_logistic", "fit_tree", "fit_random_forest", "fit_bagging", "fit_gbt",
    "fit_adaboost", "fit_linear", "fit_ridge", "fit_forest_reg", "fit_gbt_reg", "fit_kmeans", "gaussian_mixture", "hierarchical", "dbscan", "silhouette",
    "classification_metrics", "roc_auc_ovr", "bootstrap_ci_multinomial", "mcnemar", "threshold_curve", "rank_metrics", "stream_score",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "flowbench-bench")
    spark.read.parquet(f"{folder}/region.parquet").count()
    times: dict[str, float] = {}
    only = sys.argv[1:]
    for name in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
