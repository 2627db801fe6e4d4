"""End-to-end batch jobs composed from the operators (the reference's scripts
re-expressed as Spark jobs). Each stage writes its output, so a later job (or
a lost executor) restarts from files, not from raw input."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators import evaluate as EV
from revlens.operators import models as MD
from revlens.operators import monitor as MO
from revlens.operators import quality as Q
from revlens.operators import sampling as S
from revlens.operators import store as ST
from revlens.session import materialize
from revlens.sources import ingest, sinks


def data_job(spark: SparkSession, raw: DataFrame, out_dir: str, min_rows: int = 100,
             expected_split: dict | None = None) -> dict:
    """Validate (halts on critical rules), write the report, clean and label,
    write the cleaned table, assign ids, split, gate the counts, write the split.

    After the gates the report and the cleaning are independent passes over the input, so
    they run as concurrent Spark jobs."""
    Q.gate(raw, min_rows)                                               # P2, P1

    def report() -> dict:
        sinks.write_json_one(Q.validation_report_nested(raw), f"{out_dir}/validation_report")   # A1-A6
        return ingest.read_manifest(spark, f"{out_dir}/validation_report")

    with ThreadPool(1) as pool:
        reported = pool.apply_async(inheritable_thread_target(spark)(report))
        sinks.write_cleaned(Q.clean_and_label(raw), f"{out_dir}/cleaned")   # S6
        cleaned = spark.read.parquet(f"{out_dir}/cleaned")
        split = S.ids_and_split(cleaned)                                # W1, W5
        if expected_split:
            split = materialize(split, "ids-and-split")
            S.check_split_counts(split, expected_split)                 # P11
        cleaned.join(split, "review_key").write.mode("overwrite").partitionBy("split") \
            .parquet(f"{out_dir}/reviews_split")                        # S7
        stored = spark.read.parquet(f"{out_dir}/reviews_split")
        counts = S.assert_split_ok(stored.drop("split"), stored.select("review_id", "split"))  # J2, U2, J8
        return {"report": reported.get(), "split_counts": counts}


def feature_job(spark: SparkSession, data_dir: str, out_dir: str, **settings) -> dict:
    """Fit the transformer on train rows, write the store, transformer and manifest."""
    docs = spark.read.parquet(f"{data_dir}/reviews_split")
    store, tr = ST.build_store(docs, **settings)
    ST.write_store(store, f"{out_dir}/features")                        # S7
    ST.save_transformer(tr, f"{out_dir}/transformer")                   # S11
    stored = spark.read.parquet(f"{out_dir}/features")
    man = ST.manifest(spark, stored, tr)
    sinks.write_json_one(man, f"{out_dir}/schema")                      # S8, M7
    ok = ST.conformance(stored, man).first()
    return {"sizes_ok": ok["sizes_ok"], "rows_ok": ok["rows_ok"]}


def train_job(spark: SparkSession, store_dir: str, run_name: str, runs_path: str,
              sample: int | None = None, C: float = 1.0) -> dict:
    """Read the manifest and the store, optional stratified sample, fit,
    evaluate, log the run."""
    man = ingest.read_manifest(spark, f"{store_dir}/schema")              # S5
    store = spark.read.parquet(f"{store_dir}/features")
    bad = store.filter(F.size("features") != man["n_features"]).limit(1).count()
    if bad:
        raise ValueError(f"store rows do not have the manifest's {man['n_features']} features")
    train = store.filter(F.col("split") == "train")                     # P10 (partition pruned)
    if sample is not None:
        train = S.stratified_sample(train, sample, check=True)          # W6
    vec = lambda d: d.withColumn("fv", F.col("features").cast("array<double>"))
    from pyspark.ml.functions import array_to_vector
    fit_in = vec(train).withColumn("fv", array_to_vector("fv"))
    model = MD.fit_lr(fit_in, features="fv", C=C, max_iter=1000)
    test = vec(store.filter(F.col("split") == "test")).withColumn("fv", array_to_vector("fv"))
    scored = MD.score(model, test, run_name=run_name)
    m = MD.run_metrics(scored).first().asDict()
    report = EV.classification_report(scored).collect()
    text = "\n".join(f"{r['row_name']:>12} {r['precision'] or 0:.2f} {r['recall'] or 0:.2f} "
                     f"{r['f1']:.2f} {r['support']}" for r in report)
    params = {"model": "LogisticRegression", "C": C, "class_weight": "balanced",
              "train_rows": fit_in.count(), "test_rows": test.count()}
    metrics = {k: m[k] for k in ("accuracy", "macro_f1", "roc_auc", "negative_precision",
                                 "negative_recall")}
    MD.append_runs(MD.run_record(spark, run_name, params, metrics, text), runs_path)   # S12
    return metrics


def monitor_job(log: DataFrame, window: int = MO.WINDOW) -> dict:
    """R3 + R4 over the last ``window`` rows per model of a prediction log."""
    sig = materialize(MO.signals(MO.last_n(log, window)), "signals")    # one row per model
    checks = [r.asDict() for r in MO.health_checks(sig).collect()]
    trig = [r.asDict() for r in MO.retrain_trigger(sig, window=window).collect()]
    return {"checks": checks, "trigger": trig}
