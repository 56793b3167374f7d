"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from faultline.catalog.queries import QUERIES  # noqa: E402
from faultline.session import local_session  # noqa: E402

HEADLINE = [
    "normalize_names", "file_hash_prefix", "header_check", "dtype_first_error", "short_rows", "file_verdicts", "validation_summary",
    "load_union_by_name", "load_drop_bad_files", "load_coerce_types", "qmark_to_null", "zero_variance_columns",
    "mean_impute", "mode_impute", "prediction_fill", "row_positions", "knn_impute", "approximate_neighbors", "knn_classify", "standardize", "wcss_k1",
    "assign_fixed_centers", "kmeans_clusters", "auc_rank_sum", "select_best_model", "prediction_labels", "prediction_sorted",
    "prediction_summary", "raw_line_verdicts", "append_twice", "csv_round_trip", "prediction_order",
    "train_logisticregression", "train_decisiontree", "train_adaboost", "train_svm", "train_knn", "train_randomforest",
    "kmeans_step", "elbow_wcss", "boost_one_round", "train_xgboost", "train_gradientboosting", "best_model_per_cluster", "predict_end_to_end",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["accuracy"](spark, sf_dir).collect()  # start the JVM's machinery
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale[1]) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
