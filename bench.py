"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print one JSON line.

Each query is executed end to end into Spark's no-op sink (full computation,
nothing collected to the driver). Stage tables are forgotten before every run,
so each query pays for its own cleaning/split stages. One warm-up run, then
the median of $BENCH_RUNS (default 1) timed runs per query. A query that fails is
reported on stderr and left out.

Exception, mirroring how the reference reports its store model: the
feature-store build is timed on its own (``feature_store``), and
``train_from_store`` times training and evaluation on an already built store. The
score cache is off, so every run trains and scores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "validation_report", "clean_and_label", "attrition_ledger", "stratified_split",
    "term_stats", "tfidf_sublinear", "top_terms_per_doc", "metric_bundle", "pr_curve",
    "precision_at_recall", "monitor_signals", "drift_metrics", "request_validation",
    "feature_store", "feature_store_k32", "train_from_store", "tfidf_logreg", "controlled_comparison",
    "ablation", "data_job",
]
REUSE_STORE = {"train_from_store"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from revlens.plans.catalog import REGISTRY
    from revlens.session import build_session, forget_stages
    spark = build_session(f"local[{cpus}]", app="revlens-bench", shuffle_partitions=cpus)
    from revlens.plans.catalog import SCORE_CACHE
    spark.conf.set(SCORE_CACHE, "off")
    times: dict[str, float] = {}
    import uuid

    def data_job(spark, sf):
        # ingest view -> validate -> report -> clean -> write -> ids -> split -> write
        from revlens.plans.jobs import data_job as run
        from revlens.session import scratch_path
        from revlens.sources.tables import reviews
        run(spark, reviews(spark, sf), scratch_path(spark, f"data-job-{uuid.uuid4().hex}"))
        return None

    def feature_store_k32(spark, sf):
        # the dimensions of the first round's figure, for comparison
        from revlens.plans.catalog import feature_store_of
        return feature_store_of(spark, sf, k=32)[0]

    own = {"data_job": data_job, "feature_store_k32": feature_store_k32}
    for name in (only or HEADLINE):
        fn = own.get(name) or REGISTRY.get(name)
        if fn is None:
            continue
        samples = []
        try:
            for i in range(runs + 1):
                if name not in REUSE_STORE:
                    forget_stages()
                t0 = time.perf_counter()
                out = fn(spark, sf_dir)
                if out is not None:
                    out.write.format("noop").mode("overwrite").save()
                if i:
                    samples.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001
            print(f"{name} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            continue
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
