"""Time the registered queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma separated, or ``all``) steer the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "error_rate_trend", "latency_by_prompt", "quality_pass_rate", "token_cost_by_day", "top_failure_modes",
    "trace_metrics", "smoke_stats", "monitor_signals_hourly", "numeric_profile", "categorical_profile",
    "histogram_inference", "psi_by_feature", "ks_by_feature", "drift_report", "drift_rollup", "weekly_drift",
    "buildability", "metric_means", "threshold_gate", "failure_extract", "failure_categories", "failure_examples",
    "ldr_parse", "ldr_validate", "structural_features", "part_stats", "bbox_overlaps", "color_share",
    "prompt_experiment", "rag_tuning", "pareto_front", "chunk_documents", "vector_topk", "keyword_topk", "hybrid_topk",
    "context_assembly", "finetune_messages", "span_fill", "walls_built", "floor_plates", "cornice",
    "confusion_report", "stratified_split", "standardize", "silhouette", "traffic_split", "archival_candidates",
    "stream_error_rate", "stream_monitor", "stream_drift", "density_clusters",
]


def main() -> None:
    from mortarline.plans.registry import all_queries
    from mortarline.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    picked = os.environ.get("BENCH_QUERIES", "")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = list(queries) if picked == "all" else [q for q in picked.split(",") if q] or HEADLINE
    queries["error_rate_trend"](spark, sf_dir).count()  # start the JVM threads before timing
    timings: dict[str, float] = {}
    for name in names:
        begin = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
