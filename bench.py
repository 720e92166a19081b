"""Seconds per headline query; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardline.plans import catalog  # noqa: E402
from wardline.session import build_session  # noqa: E402

HEADLINE = [
    "dedup_rows", "prep_fit_transform", "stratified_split", "stratified_kfold",
    "event_profile", "ip_behavior_lookup", "ip_topology", "ip_activity_windows", "hard_features", "label_purity",
    "robust_scale", "target_encode", "feature_fit_transform", "char_wb_ngrams", "tfidf_transform", "select_by_mutual_info",
    "compute_metrics", "roc_points", "random_under", "random_over", "knn_any_class", "smote", "smote_enn", "knn_lsh",
    "random_forest", "gbt_ovr", "gbt_ovr_balanced", "leafwise", "mlp", "stacking", "shap_tree", "permutation_importance", "stream_ip_activity",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    catalog.queries()["label_purity"](spark, folder).collect()  # start-up is not measured
    seconds = {}
    for name in HEADLINE:
        start = time.monotonic()
        catalog.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
