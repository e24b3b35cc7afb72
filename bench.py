"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Queries run to a ``noop`` sink. Predictions and the metric log, the files that the analyses read, are
built first and reported as queries of their own.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "running_minmax_normalize",
    "preq_reg_segment_metrics",
    "preq_cls_segment_metrics",
    "preq_run_summary",
    "segment_assign",
    "prediction_diversity",
    "confusion_kappa",
    "sgd_regress_keyed",
    "pa_keyed",
    "sgd_stream_blocked",
    "multi_learner_compare",
    "preq_with_drift",
    "adwin_runs",
    "adwin_grained",
    "drift_gate",
    "knn_classify",
    "split_statistics",
    "hoeffding_tree_preq",
    "fimtdd_preq",
    "arf_classify_preq",
    "arf_regress_preq",
    "multiclass_linear",
    "mean_shift",
    "accuracy_variance",
    "drift_impact",
    "drift_report",
    "metric_trajectory",
    "latest_metrics",
    "live_stats",
    "log_scan_union",
    "stream_preq_metrics",
)


def main() -> None:
    from tidemark.catalog import queries
    from tidemark.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("build_predictions", lambda: queries._pred(spark, sf_dir))
    timed("build_metric_log", lambda: queries._log(spark, sf_dir))
    wanted = os.environ.get("BENCH_QUERIES")
    for name in wanted.split(",") if wanted else HEADLINE:
        query = queries.QUERIES[name]
        timed(name, lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save())
    events = queries.table(spark, sf_dir, "events").count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").split("sf")[-1],
                "cpus": int(cpus),
                "events": events,
                "instances_per_second": {
                    name: round(events / seconds[name])
                    for name in ("sgd_regress_keyed", "pa_keyed", "sgd_stream_blocked")
                    if name in seconds
                },
            }
        )
    )


if __name__ == "__main__":
    main()
