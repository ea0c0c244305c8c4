"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from tallywise.plans import catalog
from tallywise.session import build_session

HEADLINE = [
    "d7_user_features", "d8_database_stats", "d9_noise_statistics", "m8_perturb_transactions",
    "i13_transform_steps", "i15_correlation_matrix", "n10_boxplot_stats", "n5_histogram",
    "c4_decorrelated_ratio", "j1_kmeans", "j2_kmeans_fixed_init", "j8_cluster_metrics",
    "j10_cluster_profiles", "k1_isolation_forest", "k2_rbf_boundary_score", "k5_supervised_forest",
    "k13_rule_flags", "l1_knn_exact", "l4_similarity_join", "l5_knn_lsh", "p1_incremental_features",
    "j5_dbscan", "j15_clustering_analysis", "k12_anomaly_analysis", "l11_similarity_analysis",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="16g",
                          spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = catalog.queries(), {}
    # One untimed run starts the JVM's compilers and the Python workers.
    queries[names[0]](spark, folder).write.format("noop").mode("overwrite").save()
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
