"""Wall time of the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from statloom.plans.catalogue import REGISTRY
from statloom.session import local_session

HEADLINE = [
    "revenue_report",
    "dedupe_keep_first",
    "distinct_rows",
    "keyed_update",
    "column_info",
    "describe_long",
    "descriptive_stats",
    "group_stats",
    "corr_long",
    "outlier_counts",
    "impute_median",
    "clean_chain",
    "anova_f",
    "ci_t",
    "hist30",
    "box_by_group",
    "kde_grid",
    "pair_bins",
    "standard_scale",
    "stratified_split",
    "label_encode",
    "roc_auc_orders",
    "class_report",
    "ols",
    "ridge_loo",
    "lasso_path",
    "pps_matrix",
    "isolation_forest",
    "logistic",
    "svm_rbf",
    "score_batch",
]
REPEATS = 2


def run(spark, name: str, root: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: round(min(run(spark, name, root) for _ in range(REPEATS)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
