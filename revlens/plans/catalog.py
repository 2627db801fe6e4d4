"""Named queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the driver tables (or views Spark derives from them), so its
work grows with the data. Oracle SQL for the same names lives in
``revlens.plans.oracle``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import quality as Q
from revlens.operators import sampling as S
from revlens.operators import tfidf as TF
from revlens.operators import colocated as CO
from revlens.operators import evaluate as EV
from revlens.operators import monitor as MO
from revlens.operators import models as MD
from revlens.operators import serving as SV
from revlens.operators import store as ST
from revlens.operators import vectors as VEC
from revlens.sources import fingerprint as FP
import uuid

from revlens.session import drop_written, input_stamp, materialize, memo_get, memo_put, scratch_path, shuffle_partitions, written
from revlens.sources import tables as V

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def cleaned_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.clean_and_label(V.reviews(spark, sf_dir))


# --- data quality and cleaning ---------------------------------------------------

@query("clean_and_label")
def q_clean_and_label(spark, sf_dir):
    return cleaned_reviews(spark, sf_dir)


@query("clean_and_label_dirty")
def q_clean_and_label_dirty(spark, sf_dir):
    return Q.clean_and_label(V.dirty_reviews(spark, sf_dir))


@query("light_clean_pages")
def q_light_clean_pages(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    return pages.select("page_id", T.light_clean("html").alias("text_light_clean"),
                        T.word_count(T.light_clean("html")).alias("word_count"))


@query("heavy_clean_docs")
def q_heavy_clean_docs(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    return docs.select("doc_id", T.heavy_clean("text").alias("text_heavy_clean"))


@query("validation_report")
def q_validation_report(spark, sf_dir):
    return Q.validation_report(V.dirty_reviews(spark, sf_dir))


@query("validation_report_reviews")
def q_validation_report_reviews(spark, sf_dir):
    return Q.validation_report(V.reviews(spark, sf_dir))


@query("attrition_ledger")
def q_attrition_ledger(spark, sf_dir):
    return Q.attrition_ledger(V.dirty_reviews(spark, sf_dir))


@query("class_shares")
def q_class_shares(spark, sf_dir):
    return Q.class_shares(cleaned_reviews(spark, sf_dir))


@query("dedup_first")
def q_dedup_first(spark, sf_dir):
    """W2 on documents: first doc per distinct text, with its copy count."""
    docs = V.table(spark, sf_dir, "documents").select(
        F.col("doc_id"), F.col("text").alias("review_text"), "source")
    # digests are counted; the winners fetch their source by id, no text is shuffled
    first = (docs.groupBy(Q.text_digest().alias("digest"))
             .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies")))
    return (first.join(docs.select("doc_id", "source"), F.col("first_id") == F.col("doc_id"))
            .select("doc_id", "source", "n_copies"))


# --- ids, split, samples ---------------------------------------------------------

def review_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage tables, as the reference keeps its cleaned file and split file:
    cleaned rows are written once, ids and the split are assigned over their keys
    and labels, and the joined result, which holds all of it, is written partitioned by split."""
    stamp = input_stamp(spark, sf_dir)
    found = written(spark, "reviews_split", stamp)
    if found is not None:
        return found
    # a task joins and sorts a bounded amount of text
    with shuffle_partitions(spark, TF.text_parts(V.table(spark, sf_dir, "documents"), "text")):
        cleaned = materialize(cleaned_reviews(spark, sf_dir), "cleaned")
        store = materialize(cleaned.join(S.ids_and_split(cleaned), "review_key"), "reviews_split", memo=stamp, partition_by="split")
    drop_written(cleaned)
    return store


def ided_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_store(spark, sf_dir).drop("split")


def split_of(spark: SparkSession, sf_dir: str):
    store = review_store(spark, sf_dir)
    return store.drop("split"), store.select("review_id", "split")


@query("row_ids")
def q_row_ids(spark, sf_dir):
    return ided_reviews(spark, sf_dir).select("review_key", "review_id")


@query("stratified_split")
def q_stratified_split(spark, sf_dir):
    return split_of(spark, sf_dir)[1]


@query("split_counts")
def q_split_counts(spark, sf_dir):
    ided, split = split_of(spark, sf_dir)
    return S.split_counts(ided, split)


@query("split_leak")
def q_split_leak(spark, sf_dir):
    ided, split = split_of(spark, sf_dir)
    return S.split_checks(ided, split)


@query("stratified_sample")
def q_stratified_sample(spark, sf_dir):
    ided, split = split_of(spark, sf_dir)
    pool = S.attach_split(ided.select("review_id", "label"), split, "train")
    return S.stratified_sample(pool, 100).select("review_id", "label")


@query("simple_sample")
def q_simple_sample(spark, sf_dir):
    ided, split = split_of(spark, sf_dir)
    test = S.attach_split(ided.select("review_id", "label"), split, "test")
    return S.simple_sample(test, 200).select("review_id", "label")


# --- TF-IDF -----------------------------------------------------------------------

def train_test_docs(spark: SparkSession, sf_dir: str):
    """Cleaned rows with ids and split attached (the store's row set); the
    train filter prunes the split partition."""
    docs = review_store(spark, sf_dir)
    return docs, docs.filter(F.col("split") == "train")


def fitted(spark, sf_dir, **kw):
    docs, train = train_test_docs(spark, sf_dir)
    model = TF.fit(train, **kw)
    return model, docs


@query("term_stats")
def q_term_stats(spark, sf_dir):
    _, train = train_test_docs(spark, sf_dir)
    return TF.written_stats(train, ngram_max=2)


@query("vocab_topn")
def q_vocab_topn(spark, sf_dir):
    model, _ = fitted(spark, sf_dir, ngram_max=1, max_features=5000)
    return model.vocab.select("term", "idx", "cf", "df", F.round("idf", 6).alias("idf"))


def _weights(spark, sf_dir, **kw):
    model, docs = fitted(spark, sf_dir, **kw)
    w = TF.transform(model, docs)
    return w.select("review_id", "term", F.round("weight", 6).alias("weight"))


@query("tfidf_plain")
def q_tfidf_plain(spark, sf_dir):
    return _weights(spark, sf_dir, ngram_max=1, max_features=5000)


@query("tfidf_bigram")
def q_tfidf_bigram(spark, sf_dir):
    return _weights(spark, sf_dir, ngram_max=2, max_features=20000)


@query("tfidf_sublinear")
def q_tfidf_sublinear(spark, sf_dir):
    return _weights(spark, sf_dir, ngram_max=2, max_features=20000, sublinear=True)


@query("top_terms_per_doc")
def q_top_terms_per_doc(spark, sf_dir):
    model, docs = fitted(spark, sf_dir, ngram_max=1, max_features=5000)
    top = TF.top_terms(TF.transform(model, docs), 8)
    return top.select("review_id", "rank", "term", F.round("weight", 6).alias("weight"))


@query("sequence_encode")
def q_sequence_encode(spark, sf_dir):
    model, docs = fitted(spark, sf_dir, ngram_max=1, max_features=5000)
    enc = TF.sequence_encode(docs, model.vocab)
    return enc.select("review_id", "n_tokens", "truncated",
                      F.array_join("input_ids", " ").alias("input_ids"),
                      F.array_join("attention_mask", " ").alias("attention_mask"))


# --- evaluation ---------------------------------------------------------------------

def _r6(*cols):
    return [F.round(c, 6).alias(c) for c in cols]


@query("confusion")
def q_confusion(spark, sf_dir):
    return EV.confusion(V.scored(spark, sf_dir))


@query("metric_bundle")
def q_metric_bundle(spark, sf_dir):
    m = EV.metric_bundle(V.scored(spark, sf_dir))
    return m.select("model", "n", *_r6("accuracy", "macro_f1", "roc_auc",
                                       "negative_precision", "negative_recall"))


@query("classification_report")
def q_classification_report(spark, sf_dir):
    r = EV.classification_report(V.scored(spark, sf_dir))
    return r.select("model", "row_name", *_r6("precision", "recall", "f1"), "support")


@query("roc_auc")
def q_roc_auc(spark, sf_dir):
    return EV.roc_auc(V.scored(spark, sf_dir)).select("model", *_r6("roc_auc"))


@query("pr_curve")
def q_pr_curve(spark, sf_dir):
    c = EV.pr_curve(V.scored(spark, sf_dir))
    return c.select("model", "threshold", "flagged", "hits", "positives",
                    *_r6("precision", "recall"))


@query("precision_at_recall")
def q_precision_at_recall(spark, sf_dir):
    a = EV.at_recall(EV.pr_curve(V.scored(spark, sf_dir)))
    return a.select("model", "target", "threshold", *_r6("precision", "recall"))


@query("false_alarms")
def q_false_alarms(spark, sf_dir):
    a = EV.at_recall(EV.pr_curve(V.scored(spark, sf_dir)))
    return a.select("model", "target", "caught", "false_alarms")


def scored_runs(spark, sf_dir) -> DataFrame:
    """One run per scored model: five metrics plus a fingerprint of its test ids."""
    sc = V.scored(spark, sf_dir)
    m = EV.metric_bundle(sc)
    fp = FP.content_hash(sc.select("model", "id"), ["id"], group_cols=["model"])
    return (m.join(fp.select("model", F.col("content_hash").alias("test_fingerprint")), "model")
            .withColumnRenamed("model", "run_name"))


@query("leaderboard")
def q_leaderboard(spark, sf_dir):
    lb = EV.leaderboard(scored_runs(spark, sf_dir))
    return lb.select("run_name", "rank", *_r6("accuracy", "macro_f1", "roc_auc",
                                              "negative_precision", "negative_recall"))


@query("best_run")
def q_best_run(spark, sf_dir):
    b = EV.best_run(scored_runs(spark, sf_dir))
    return b.select("best_run", *_r6("macro_f1"))


@query("promotion_gate")
def q_promotion_gate(spark, sf_dir):
    g = EV.promotion_gate(scored_runs(spark, sf_dir), candidate="b", incumbent="a")
    return g.select("candidate", "incumbent", *_r6("cand_f1", "inc_f1"),
                    "same_test_rows", "promote")


@query("dataset_fingerprint")
def q_dataset_fingerprint(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    a = FP.content_hash(docs, cols).withColumn("dataset", F.lit("documents"))
    cl = cleaned_reviews(spark, sf_dir)
    b = (FP.content_hash(cl, ["review_key", "review_text", "rating", "label",
                              "text_heavy_clean", "text_light_clean"])
         .withColumn("dataset", F.lit("cleaned_reviews")))
    return a.unionByName(b).select("dataset", "n_rows", "content_hash")


# --- monitoring and drift --------------------------------------------------------

def _signals(spark, sf_dir):
    return MO.signals(MO.last_n(V.prediction_log(spark, sf_dir)))


@query("monitor_signals")
def q_monitor_signals(spark, sf_dir):
    s = _signals(spark, sf_dir)
    return s.select("model", "predictions", *_r6("mean_confidence", "low_confidence_rate",
                                                 "positive_share", "median_word_count",
                                                 "p95_latency_ms"))


@query("health_checks")
def q_health_checks(spark, sf_dir):
    h = MO.health_checks(_signals(spark, sf_dir))
    return h.select("model", "check", *_r6("value"), "limit", "ok", "state")


@query("retrain_trigger")
def q_retrain_trigger(spark, sf_dir):
    r = MO.retrain_trigger(_signals(spark, sf_dir))
    return r.select("model", "predictions", *_r6("low_confidence_rate"), "retrain", "reason")


@query("hard_examples")
def q_hard_examples(spark, sf_dir):
    w = MO.last_n(V.prediction_log(spark, sf_dir))
    return MO.hard_examples(w).select("model", "id", "ts", "confidence")


@query("drift_metrics")
def q_drift_metrics(spark, sf_dir):
    d = MO.drift_metrics(V.labelled_batch(spark, sf_dir))
    return d.select("batch", "drift_type", "level", "n", "scored", "rejected",
                    *_r6("accuracy", "mean_confidence", "low_confidence_rate"))


@query("drift_delta")
def q_drift_delta(spark, sf_dir):
    d = MO.drift_delta(MO.drift_metrics(V.labelled_batch(spark, sf_dir), by_type=False))
    return d.select("metric", *_r6("baseline", "drifted", "change"))


@query("misclassified")
def q_misclassified(spark, sf_dir):
    m = MO.misclassified(V.labelled_batch(spark, sf_dir))
    return m.select("id", "batch", "drift_type", "confidence", "pred", "truth")


@query("request_validation")
def q_request_validation(spark, sf_dir):
    r = MO.validate_text(V.requests(spark, sf_dir))
    return r.select("request_id", "accepted", "reject_reason", "text_light_clean", "word_count")


# --- features, models, runs ----------------------------------------------------------

STORE_SETTINGS = dict(max_features=20000, ngram_max=2, sublinear=True, k=600)


def feature_store_of(spark, sf_dir, **over):
    """Store rows + fitted transformer; the store table is written once per
    session and settings (the transformer is kept beside it)."""
    settings = dict(STORE_SETTINGS, **over)
    key = (spark.sparkContext.applicationId, input_stamp(spark, sf_dir), tuple(sorted(settings.items())))
    hit = memo_get(key)
    if hit is not None:
        path, tr = hit
        return spark.read.parquet(path), tr
    docs, _ = train_test_docs(spark, sf_dir)
    store, tr = ST.build_store(docs, **settings)
    path = scratch_path(spark, f"feature_store-{uuid.uuid4().hex}")
    ST.write_store(store, path)
    tr.svd.release()
    memo_put(key, (path, tr))
    return spark.read.parquet(path), tr


@query("feature_store")
def q_feature_store(spark, sf_dir):
    return feature_store_of(spark, sf_dir)[0]


@query("store_manifest")
def q_store_manifest(spark, sf_dir):
    """M7 through S8 (JSON document) and S5 (read back, as readers use it)."""
    from revlens.sources import sinks
    store, tr = feature_store_of(spark, sf_dir)
    path = scratch_path(spark, f"schema-{uuid.uuid4().hex}")
    sinks.write_json_one(ST.manifest(spark, store, tr), path)
    doc = spark.read.option("multiLine", True).json(path)
    return doc.select(F.col("n_features").cast("int").alias("n_features"),
                      F.size("feature_columns").alias("n_names"),
                      F.col("tfidf_max_features").cast("int").alias("tfidf_max_features"), "tfidf_sublinear_tf",
                      F.col("random_state").cast("int").alias("random_state"),
                      F.col("rows.train").alias("train_rows"), F.col("rows.test").alias("test_rows"))


@query("store_conformance")
def q_store_conformance(spark, sf_dir):
    store, tr = feature_store_of(spark, sf_dir)
    return ST.conformance(store, ST.manifest(spark, store, tr))


#: changes when scores of the same configuration would: part of every cache key
SCORES_VERSION = 3
#: session setting: folder of the score cache (default: under the checkpoint folder), or "off"
SCORE_CACHE = "revlens.scoreCache"


def cached_scores(spark, sf_dir, config: dict, compute, folder: str | None = None) -> DataFrame:
    """(model, id, prob_neg, label) of a configuration over one input, computed once and
    found again, also by a later session, by its hash (version and input files included)."""
    from revlens.sources import ingest
    folder = folder or spark.conf.get(SCORE_CACHE, None) or scratch_path(spark, "score-cache")
    if folder == "off":
        return materialize(compute(), "scores")
    return ingest.cached_scores(spark, folder, dict(config, input=input_stamp(spark, sf_dir), version=SCORES_VERSION), compute)


def _dense(df):
    return df.withColumn("fv", VEC.dense("features"))


def _lr_on_store(store, run_name, sample=None, C=1.0, balanced=True):
    train = store.filter(F.col("split") == "train")
    if sample is not None:
        train = S.stratified_sample(train, sample)
    model = MD.fit_lr(_dense(train), features="fv", C=C, balanced=balanced)
    scored = MD.score(model, _dense(store.filter(F.col("split") == "test")), run_name=run_name)
    return model, scored


def served(spark, sf_dir):
    """Store, test scores and serving artifact (M12) of the balanced LR on the published store: fitted
    and saved once per session and input, then loaded as a server does."""
    from pyspark.ml import PipelineModel
    key = (spark.sparkContext.applicationId, input_stamp(spark, sf_dir), "served")
    if memo_get(key) is None:
        store, tr = feature_store_of(spark, sf_dir)
        model, scored = _lr_on_store(store, "served")
        path = scratch_path(spark, f"serving-{uuid.uuid4().hex}")
        SV.serving_model(tr, model).write().overwrite().save(path)
        memo_put(key, (path, materialize(scored, "served-scores"), model))
    path, scored, model = memo_get(key)
    return feature_store_of(spark, sf_dir)[0], scored, model, PipelineModel.load(path)


def store_scores(spark, sf_dir, run_name, C=1.0, **settings):
    """Test-row scores of a balanced LR on a feature store."""
    config = dict(dict(STORE_SETTINGS, **settings), run=run_name, C=C)
    return cached_scores(spark, sf_dir, config, lambda: _lr_on_store(
        feature_store_of(spark, sf_dir, **settings)[0], run_name, C=C)[1])


@query("train_from_store")
def q_train_from_store(spark, sf_dir):
    """Train split of the store (P10), balanced LR, test metrics."""
    return MD.run_metrics(store_scores(spark, sf_dir, "store-lr"))


@query("ablation")
def q_ablation(spark, sf_dir):
    """One knob at a time against the base store (300 dimensions, plain tf,
    20,000 terms): sublinear tf, 600 dimensions, 50,000 terms, weaker penalty."""
    return MD.with_delta(_ablation_runs(spark, sf_dir), "base")


_BASE = dict(max_features=20000, ngram_max=2, sublinear=False, k=300)
ABLATION = (("base", _BASE, 1.0), ("sublinear", dict(_BASE, sublinear=True), 1.0), ("dims-600", dict(_BASE, k=600), 1.0),
            ("terms-50k", dict(_BASE, max_features=50000), 1.0), ("penalty-quarter", _BASE, 4.0))


def _ablation_runs(spark, sf_dir):
    @functools.cache
    def stores():
        docs, _ = train_test_docs(spark, sf_dir)
        return ST.build_nested(docs, {name: cfg for name, cfg, _ in ABLATION})

    out = None
    for name, cfg, C in ABLATION:
        scores = cached_scores(spark, sf_dir, dict(cfg, run=name, C=C, stores="nested"),
                               lambda n=name, c=C: _lr_on_store(stores()[n], n, C=c)[1])
        m = MD.run_metrics(scores)
        out = m if out is None else out.unionByName(m)
    return out


@query("ablation_counts")
def q_ablation_counts(spark, sf_dir):
    """Every run of the ablation scores all test rows, and its delta is against the base run."""
    from pyspark.sql import Window
    runs = materialize(q_ablation(spark, sf_dir), "ablation-runs")          # one row per run
    base = F.first(F.when(F.col("run_name") == "base", F.col("macro_f1")), ignorenulls=True).over(Window.partitionBy())
    return runs.select("run_name", "n",
                       (F.abs(F.col("macro_f1") - base - F.col("macro_f1_delta")) < 1e-12).alias("delta_ok"))


def _vectors(tf, docs, *more):
    """Written TF-IDF vectors of ``docs``: every step of a solver reads them in partitions by size."""
    rows = TF.vectorize(tf, docs.select("review_id", "label", "text_heavy_clean", *more))
    return materialize(rows.drop("text_heavy_clean"), "tfidf-vectors")


CONTROLLED_SAMPLE = 50_000     # bound on the labelled training rows of the comparison


@query("controlled_comparison")
def q_controlled_comparison(spark, sf_dir):
    """Same stratified sample (at most CONTROLLED_SAMPLE rows, quotas checked) and
    test rows; balanced vs unweighted LR on inline TF-IDF bigrams; ranked (T7)."""
    names = ("balanced", "unweighted")

    @functools.cache
    def fitted_pair():
        # both weightings see the same written vectors, in one pass over them
        docs, train = train_test_docs(spark, sf_dir)
        sample = materialize(S.stratified_sample(train.select("review_id", "label", "text_heavy_clean"),
                                                 min(CONTROLLED_SAMPLE, train.count()), check=True), "controlled-sample")
        tf = TF.fit(sample, ngram_max=2, max_features=20000)
        models = MD.fit_lrs(_vectors(tf, sample), [True, False])
        return dict(zip(names, models)), _vectors(tf, docs.filter(F.col("split") == "test"))

    out = None
    for name in names:
        scores = cached_scores(spark, sf_dir, {"run": f"controlled-{name}", "sample": CONTROLLED_SAMPLE},
                               lambda n=name: MD.score(fitted_pair()[0][n], fitted_pair()[1], run_name=n))
        m = MD.run_metrics(scores)
        out = m if out is None else out.unionByName(m)
    return EV.leaderboard(out)


@query("controlled_counts")
def q_controlled_counts(spark, sf_dir):
    """Both runs of the comparison are scored on all test rows and ranked by macro F1."""
    from pyspark.sql import Window
    runs = materialize(q_controlled_comparison(spark, sf_dir), "controlled-runs")       # one row per run
    every = F.collect_list("macro_f1").over(Window.partitionBy())
    return runs.select("run_name", "n", F.size(every).cast("long").alias("n_runs"),
                       (F.col("rank") == 1 + F.size(F.filter(every, lambda x: x > F.col("macro_f1")))).alias("ranked"))


def drift_batches(spark, sf_dir) -> DataFrame:
    """A seeded sample of test reviews and all test reviews wrapped in markup noise,
    as (request_id, batch, text, truth) with an id per (batch, review), validated (P12)."""
    docs, _ = train_test_docs(spark, sf_dir)
    test = docs.filter(F.col("split") == "test").select("review_id", "review_text", "label")
    def batch(rows, name, number, text):
        return rows.select((F.col("review_id") * 2 + number).alias("request_id"), F.lit(name).alias("batch"),
                           text.alias("text"), F.col("label").alias("truth"))
    both = batch(S.simple_sample(test, 200), "baseline", 0, F.col("review_text")).unionByName(
        batch(test, "drifted", 1, F.concat(F.lit("<br />"), F.col("review_text"), F.lit(" <b>x</b>"))))
    return MO.validate_text(both)


@query("drift_counts")
def q_drift_counts(spark, sf_dir):
    """Requests, scored and rejected per batch of the drift experiment."""
    b = drift_batches(spark, sf_dir)
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.count_if("accepted").alias("scored"),
                                  F.count_if(~F.col("accepted")).alias("rejected"))


@query("drift_experiment")
def q_drift_experiment(spark, sf_dir):
    """Serve both batches; accuracy and confidence compared (A17 -> A19)."""
    return _drift(spark, sf_dir, served(spark, sf_dir)[3])


def _drift(spark, sf_dir, model):
    batches = materialize(drift_batches(spark, sf_dir), "drift-batches")
    got = SV.serve(model, batches.where("accepted").select("request_id", "text"))     # M12
    joined = batches.join(got.select("request_id", "label", "confidence"), "request_id", "left")   # J5
    rows = joined.select("request_id", "batch", F.lit(None).cast("string").alias("drift_type"),
                         (F.col("label") == "positive").cast("int").alias("pred"), "truth",
                         "confidence")
    return MO.drift_delta(MO.drift_metrics(rows, by_type=False))             # A17, A19


def fixed_model(spark, sf_dir):
    """A serving artifact without a solver: coefficients by vocabulary position (-5.0 to 5.0), saved and
    loaded like the fitted one, so that SQL can follow every score."""
    from pyspark.ml import PipelineModel
    _, train = train_test_docs(spark, sf_dir)
    tf = TF.fit(train, ngram_max=1, max_features=5000)
    coefficients = tf.vocab.select("term", (((F.col("idx") * 37) % 101 - 50) / 10.0).alias("coefficient"))
    path = scratch_path(spark, f"term-model-{uuid.uuid4().hex}")
    SV.term_model(tf, coefficients, 0.25).write().overwrite().save(path)
    return PipelineModel.load(path)


@query("fixed_drift")
def q_fixed_drift(spark, sf_dir):
    """R6, J5, A17, A19 through the serving artifact with given coefficients."""
    d = _drift(spark, sf_dir, fixed_model(spark, sf_dir))
    return d.select("metric", *_r6("baseline", "drifted", "change"))


@query("fixed_scores")
def q_fixed_scores(spark, sf_dir):
    """Test reviews scored from raw text with given coefficients, all metrics of the run."""
    docs, _ = train_test_docs(spark, sf_dir)
    test = docs.filter(F.col("split") == "test").select("review_id", "review_text", "label")
    got = SV.serve(fixed_model(spark, sf_dir), test.select("review_id", "review_text"), "review_id", "review_text")
    scored = got.select("review_id", F.round(1 - F.col("p_positive"), 9).alias("prob_neg")).join(
        test.select("review_id", F.col("label").alias("label")), "review_id").select(
        F.lit("fixed").alias("model"), F.col("review_id").alias("id"), "prob_neg", "label")
    m = MD.run_metrics(materialize(scored, "fixed-scores"))
    return m.select("run_name", "n", *_r6(*RUN_METRICS))


@query("store_types")
def q_store_types(spark, sf_dir):
    """stored features are 32-bit floats, also in the wide view with one column per dimension."""
    store, tr = feature_store_of(spark, sf_dir)
    k = tr.settings["svd_dims"]
    view = ST.wide(store, k)
    floats = sum(t == "float" for _, t in view.dtypes)
    return store.groupBy(F.typeof("features").alias("feature_type")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("features") - F.lit(floats)).cast("long").alias("off_columns"))


@query("log_clock")
def q_log_clock(spark, sf_dir):
    """every logged row has the time of its scoring, an ISO-8601 instant in UTC."""
    from revlens.sources import sinks
    path = scratch_path(spark, f"clock-{uuid.uuid4().hex}")
    before = spark.range(1).select(F.current_timestamp().alias("t")).first()["t"]
    rows = V.requests(spark, sf_dir).select(F.col("request_id").alias("id"), F.current_timestamp().alias("ts"))
    sinks.append_log(rows, path)
    got = spark.read.schema("id long, timestamp string").json(path)
    at = F.to_timestamp("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return got.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("timestamp").rlike(r"\+00:00$")).alias("in_utc"),
                   F.count_if(at.between(F.lit(before), F.current_timestamp())).alias("in_time"))


@query("serving_parity")
def q_serving_parity(spark, sf_dir):
    """M12 against M10: the test reviews served from raw text get the confidence their
    stored features get."""
    _, scored, _, model = served(spark, sf_dir)
    docs, _ = train_test_docs(spark, sf_dir)
    test = docs.filter(F.col("split") == "test").select("review_id", "review_text")
    got = SV.serve(model, test, id_col="review_id", text_col="review_text")
    p = 1 - F.col("prob_neg")
    both = got.join(scored.select(F.col("id").alias("review_id"), T.confidence(p).alias("stored")), "review_id")
    return both.agg(F.count(F.lit(1)).alias("n_test"),
                    F.count_if(F.abs(F.col("confidence") - F.col("stored")) <= 1.5e-4).alias("n_equal"))


@query("class_weights")
def q_class_weights(spark, sf_dir):
    """M8: weight and rows of each class of the train split."""
    _, train = train_test_docs(spark, sf_dir)
    return (MD.balanced_weights(train.select("label")).groupBy("label")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 6).alias("weight")))


@query("store_shape")
def q_store_shape(spark, sf_dir):
    """M6: metadata columns and feature count of every store row."""
    return feature_store_of(spark, sf_dir)[0].select("review_id", "label", "text_length", "split",
                                                     F.size("features").alias("n_features"))


@query("stored_order")
def q_stored_order(spark, sf_dir):
    """Rows per split of the written store, and how many of them stand before a
    smaller id of the same file."""
    store, _ = feature_store_of(spark, sf_dir)
    from pyspark.sql import Window
    # a row's place in its file: Spark's running id grows along each file it reads
    rows = store.select("split", "review_id", F.col("_metadata.file_path").alias("file"),
                        F.monotonically_increasing_id().alias("at"))
    last = F.lag("review_id").over(Window.partitionBy("file").orderBy("at"))
    return (rows.withColumn("before", last).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") > F.col("review_id")).alias("out_of_order")))


@query("svd_energy")
def q_svd_energy(spark, sf_dir):
    """M4 over the embeddings: with all components kept, the singular values carry the
    whole Frobenius norm, and components have unit length and a positive largest loading."""
    import numpy as np

    from revlens.operators import svd as SVD
    rows = V.table(spark, sf_dir, "embeddings").select("embedding")
    dims = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    arrays = rows.select(F.sequence(F.lit(0), F.size("embedding") - 1).alias("idx"),
                         F.transform("embedding", lambda x: x.cast("double")).alias("val"))
    model = SVD.fit(arrays, dims, dims)
    v = model.components
    off = int((np.abs(np.linalg.norm(v, axis=0) - 1) > 1e-6).sum()
              + (v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0).sum())
    return rows.limit(1).select(F.lit(int(dims)).alias("dims"),
                                F.lit(round(float(np.sqrt((model.singular_values ** 2).sum())), 4)).alias("frobenius"),
                                F.lit(off).alias("off_unit"))


@query("svd_truncated")
def q_svd_truncated(spark, sf_dir):
    """M4, truncated: customers as rows with one entry, 0.5 ^ nation in their nation's column. Columns are
    orthogonal, so the singular values are those weights times the root of the customers."""
    from revlens.operators import svd as SVD
    nation = F.col("c_nationkey").cast("int")
    rows = V.table(spark, sf_dir, "customer").where("c_nationkey is not null").select(
        F.array(nation).alias("idx"), F.array(F.pow(F.lit(0.5), nation)).alias("val"))
    n = rows.agg(F.max(F.col("idx")[0])).first()[0] or 0
    values = [(i + 1, float(v)) for i, v in enumerate(SVD.fit(rows, n + 1, 8).singular_values)]
    out = spark.createDataFrame(values, "rank int, value double")           # eight values
    return out.select("rank", F.round("value", 6).alias("singular_value"))


@query("lr_optimum")
def q_lr_optimum(spark, sf_dir):
    """M9: at the optimum the unpenalised intercept makes the weighted mean of
    P(positive) equal the weighted share of positives, one half when balanced."""
    store, _, model, _ = served(spark, sf_dir)
    train = MD.balanced_weights(store.filter(F.col("split") == "train")).withColumn("fv", VEC.dense("features"))
    from pyspark.ml.functions import vector_to_array
    p = model.transform(train).select("weight", vector_to_array("probability")[1].alias("p"))
    return p.agg(F.count(F.lit(1)).alias("n_train"),
                 F.round(F.sum(F.col("weight") * F.col("p")) / F.sum("weight"), 3).alias("weighted_mean"))


def published_scores(spark, sf_dir) -> DataFrame:
    """The published baseline: 50,000 uni- and bigrams, sublinear tf, balanced LR."""
    def compute():
        docs, train = train_test_docs(spark, sf_dir)
        tf = TF.fit(train, ngram_max=2, max_features=50000, sublinear=True)
        size = tf.vocab.count()
        rows = TF.to_vectors(TF.transform(tf, docs), docs.select("review_id", "label", "split"), size)
        model = MD.fit_lr(rows.filter(F.col("split") == "train"), balanced=True)
        return MD.score(model, rows.filter(F.col("split") == "test"), run_name="terms-50k-sublinear")
    return cached_scores(spark, sf_dir, {"run": "terms-50k-sublinear"}, compute)


@query("tfidf_logreg_50k")
def q_tfidf_logreg_50k(spark, sf_dir):
    """M9 at the published baseline setting, test metrics."""
    return MD.run_metrics(published_scores(spark, sf_dir))


@query("model_pr_curve")
def q_model_pr_curve(spark, sf_dir):
    """W3 on real M10 scores of the published baseline."""
    return EV.pr_curve(published_scores(spark, sf_dir))


@query("model_precision_at_recall")
def q_model_precision_at_recall(spark, sf_dir):
    """J6, M15, M16 on real M10 scores of the published baseline."""
    return EV.at_recall(EV.pr_curve(published_scores(spark, sf_dir)))


# --- sources, caches, gates --------------------------------------------------------------

@query("pruned_reread")
def q_pruned_reread(spark, sf_dir):
    """Two columns, NULLs of the required one dropped."""
    from revlens.sources import ingest
    return ingest.read_columns(spark, f"{sf_dir}/documents.parquet", ["doc_id", "lang"], required=["lang"])


@query("column_subset")
def q_column_subset(spark, sf_dir):
    """S3: a column subset of a parquet table."""
    from revlens.sources import ingest
    return ingest.read_columns(spark, f"{sf_dir}/events.parquet", ["event_id", "event_type", "value"])


@query("labelled_rows")
def q_labelled_rows(spark, sf_dir):
    """The test reviews as a labelled batch."""
    from revlens.sources import ingest
    docs, _ = train_test_docs(spark, sf_dir)
    return ingest.labelled_rows(spark, docs.filter(F.col("split") == "test").select(
        F.col("review_id").alias("id"), F.col("review_text").alias("text"), F.col("label").alias("truth")), "test")


@query("transformer_vocab")
def q_transformer_vocab(spark, sf_dir):
    """The fitted transformer saved and loaded; its vocabulary as read back."""
    _, tr = feature_store_of(spark, sf_dir)
    path = scratch_path(spark, f"transformer-{uuid.uuid4().hex}")
    ST.save_transformer(tr, path)
    vocab = ST.load_transformer(spark, path).tfidf.vocab
    return vocab.select("term", "idx", "cf", "df", *_r6("idf"))


RUN_METRICS = ("accuracy", "macro_f1", "roc_auc", "negative_precision", "negative_recall")


@query("run_log")
def q_run_log(spark, sf_dir):
    """Both scored models appended to a run log, one write each, and read back."""
    path = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    for r in MD.run_metrics(V.scored(spark, sf_dir)).collect():      # one row per model
        MD.append_runs(MD.run_record(spark, r["run_name"], {"source": "scored"},
                                     {m: r[m] for m in RUN_METRICS}), path)
    return spark.read.parquet(path).select("run_name", *[F.round(F.col("metrics")[m], 6).alias(m) for m in RUN_METRICS])


@query("cached_score_metrics")
def q_cached_score_metrics(spark, sf_dir):
    """The score table is written under its configuration's hash, then found again."""
    def missing():
        raise AssertionError("the score table was not reused")
    folder = scratch_path(spark, f"score-cache-{uuid.uuid4().hex}")
    cached_scores(spark, sf_dir, {"run": "scored-view"}, lambda: V.scored(spark, sf_dir), folder)
    again = cached_scores(spark, sf_dir, {"run": "scored-view"}, missing, folder)
    m = EV.metric_bundle(again)
    return m.select("model", "n", *_r6(*RUN_METRICS))


@query("split_fallback")
def q_split_fallback(spark, sf_dir):
    """No store yet -> recomputed and written; then copied from the store."""
    from revlens.sources import ingest
    path = scratch_path(spark, f"split-source-{uuid.uuid4().hex}")
    made = ingest.split_with_fallback(spark, path, lambda: split_of(spark, sf_dir)[1])
    made.write.mode("overwrite").parquet(path)

    def missing():
        raise AssertionError("the stored split was not used")
    return ingest.split_with_fallback(spark, path, missing)


@query("expected_counts")
def q_expected_counts(spark, sf_dir):
    """The split passes the gate on the counts its quotas promise."""
    ided, split = split_of(spark, sf_dir)
    q = S.split_quotas(ided).agg(F.sum("test_quota").alias("test"), F.sum("n_rows").alias("n")).first()
    S.check_split_counts(split, {"train": q["n"] - q["test"], "test": q["test"]})
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("extended_training")
def q_extended_training(spark, sf_dir):
    """The cleaned reviews extended by newly labelled rows and cleaned again."""
    new = V.dirty_reviews(spark, sf_dir).withColumn("review_key", F.col("review_key") + 1_000_000_000)
    return Q.extend_training(cleaned_reviews(spark, sf_dir), new)


@query("extended_store")
def q_extended_store(spark, sf_dir):
    """U3 as an increment: the cleaned rows are written once with their digest index, new rows
    are cleaned against that index and appended; equal to cleaning the union again."""
    path = scratch_path(spark, f"cleaned-store-{uuid.uuid4().hex}")
    Q.write_cleaned_store(cleaned_reviews(spark, sf_dir), path)
    new = V.dirty_reviews(spark, sf_dir).withColumn("review_key", F.col("review_key") + 1_000_000_000)
    Q.extend_store(spark, path, new, 1)
    return spark.read.parquet(f"{path}/rows").drop("batch")


def colocated_store(spark, sf_dir) -> list[DataFrame]:
    """Rows, split and TF-IDF terms of the reviews as bucketed tables."""
    docs, train = train_test_docs(spark, sf_dir)
    tf = TF.fit(train, ngram_max=2, max_features=20000, sublinear=True)
    terms = TF.transform(tf, docs).groupBy("review_id").agg(F.count(F.lit(1)).alias("n_terms"),
                                                            F.round(F.sum("weight"), 6).alias("weight"))
    return [CO.write_bucketed(t, name) for name, t in (
        ("rows", docs.select("review_id", "label")), ("split", docs.select("review_id", "split")), ("terms", terms))]


@query("colocated_join")
def q_colocated_join(spark, sf_dir):
    """Ids, split and features joined from co-located tables."""
    return CO.join_all(colocated_store(spark, sf_dir))


@query("sql_clean_docs")
def q_sql_clean_docs(spark, sf_dir):
    """Section 2.11: the cleaners as SQL functions."""
    T.register_sql_functions(spark)
    V.table(spark, sf_dir, "documents").createOrReplaceTempView("revlens_documents")
    return spark.sql("SELECT doc_id, light_clean(text) AS text_light_clean, heavy_clean(text) AS text_heavy_clean "
                     "FROM revlens_documents")


@query("csv_keep_first")
def q_csv_keep_first(spark, sf_dir):
    """S1 + W2 over two sources of unequal size, the labelled documents and all documents, each written
    as part files whose names sort in id order: the copy of the source first by name wins though
    the second is larger. Texts that CSV reads as missing have no row."""
    from revlens.sources import ingest
    base = scratch_path(spark, f"two-csv-{uuid.uuid4().hex}")
    docs = V.table(spark, sf_dir, "documents").where(~F.col("text").isin(list(ingest.NA_TOKENS)))
    labelled = docs.join(V.table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    for name, part, rating in (("a", labelled, 5), ("b", docs, 1)):
        (part.select(F.col("doc_id").alias("Id"), F.col("text").alias("Text"), F.lit(rating).alias("Score"))
         .repartitionByRange("Id").sortWithinPartitions("Id").write.option("header", True).option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{base}/{name}"))
    rows = ingest.ingest_csv(spark, f"{base}/*", "Text", "Score")
    return Q.first_per_text(rows).select(F.md5("review_text").alias("digest"), "rating")


@query("nullable_fingerprint")
def q_nullable_fingerprint(spark, sf_dir):
    """S13 over nullable columns: the same texts in the first or the second column are
    different data."""
    d = V.dirty_reviews(spark, sf_dir)
    none = F.lit(None).cast("string")
    both = d.select(F.col("review_text").alias("a"), none.alias("b")).unionByName(
        d.select(none.alias("a"), F.col("review_text").alias("b")))
    sides = [("as given", both), ("first", both.where("a is not null")), ("second", both.where("b is not null"))]
    out = None
    for name, rows in sides:
        h = FP.content_hash(rows, ["a", "b"]).withColumn("side", F.lit(name))
        out = h if out is None else out.unionByName(h)
    return out.select("side", "n_rows", "content_hash")


# --- streams (batch twins above) ------------------------------------------------------

@query("monitor_stream")
def q_monitor_stream(spark, sf_dir):
    """R2: the prediction log replayed as files through the count-window state;
    the latest emitted signals per model equal the batch twin."""
    from revlens.streaming import monitor_stream as MS
    base = scratch_path(spark, f"monitor-stream-{uuid.uuid4().hex}")
    log = V.prediction_log(spark, sf_dir)
    # four files by id range -> four micro-batches
    from revlens.sources import sinks
    sinks.append_log(log.repartitionByRange(4, "id"), f"{base}/log")        # S9 JSON lines
    sig = MS.run_to_table(spark, f"{base}/log", f"{base}/out", f"{base}/ckpt")
    return sig.select("model", "predictions", *_r6("mean_confidence", "low_confidence_rate",
                                                   "positive_share", "median_word_count",
                                                   "p95_latency_ms"))


@query("scoring_stream")
def q_scoring_stream(spark, sf_dir):
    """Request bodies streamed through validation and the served model;
    accepted rows land in the log, rejected rows in quarantine."""
    from revlens.streaming import scoring_stream as SS
    model = served(spark, sf_dir)[3]
    base = scratch_path(spark, f"scoring-stream-{uuid.uuid4().hex}")
    SS.bodies(V.requests(spark, sf_dir)).write.mode("overwrite").json(f"{base}/in")
    q = SS.start(spark, model, "store-lr", f"{base}/in", f"{base}/log",
                 f"{base}/quarantine", f"{base}/ckpt")
    q.awaitTermination()
    from revlens.sources import ingest
    log = ingest.read_log(spark, f"{base}/log").select(
        F.col("id").alias("request_id"), F.lit(None).cast("string").alias("reject_reason"),
        "label", "confidence")
    bad = spark.read.parquet(f"{base}/quarantine").select(
        "request_id", "reject_reason", F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("double").alias("confidence"))
    return log.unionByName(bad)


@query("scoring_verdicts")
def q_scoring_verdicts(spark, sf_dir):
    """Verdict and reason of every request that went through the scoring stream."""
    out = REGISTRY["scoring_stream"](spark, sf_dir)
    return out.select("request_id", F.col("reject_reason").isNull().alias("accepted"), "reject_reason")


@query("tfidf_logreg")
def q_tfidf_logreg(spark, sf_dir):
    """M9 on inline TF-IDF: uni+bigram vocabulary (20k cap) fitted on the whole
    train split, balanced LR, scored on the test split (the bigram run)."""
    def compute():
        docs, train = train_test_docs(spark, sf_dir)
        tf = TF.fit(train, ngram_max=2, max_features=20000)
        rows = _vectors(tf, docs, "split")
        model = MD.fit_lr(rows.filter(F.col("split") == "train"), balanced=True)
        return MD.score(model, rows.filter(F.col("split") == "test"), run_name="bigram-lr")
    return MD.run_metrics(cached_scores(spark, sf_dir, {"run": "bigram-lr"}, compute))


@query("csv_roundtrip_report")
def q_csv_roundtrip_report(spark, sf_dir):
    """S6 + S1 + A1-A6: the reviews written as CSV (quoted multi-line texts),
    ingested back by column name, and validated; equals the report on the
    original rows."""
    from revlens.sources import ingest, sinks
    path = scratch_path(spark, f"raw-csv-{uuid.uuid4().hex}")
    raw = V.reviews(spark, sf_dir).select(F.col("review_key").alias("Id"),
                                          F.col("review_text").alias("Text"),
                                          F.col("rating").alias("Score"))
    sinks.write_cleaned(raw, path, fmt="csv")
    return Q.validation_report(ingest.ingest_csv(spark, path, "Text", "Score"))


@query("log_roundtrip_signals")
def q_log_roundtrip_signals(spark, sf_dir):
    """S9 + S4: the prediction log appended as JSON lines with ISO-8601 UTC
    timestamps, read back, and monitored; equals the signals on the original."""
    from revlens.sources import ingest, sinks
    path = scratch_path(spark, f"log-{uuid.uuid4().hex}")
    sinks.append_log(V.prediction_log(spark, sf_dir), path)
    s = MO.signals(MO.last_n(ingest.read_log(spark, path)))
    return s.select("model", "predictions", *_r6("mean_confidence", "low_confidence_rate",
                                                 "positive_share", "median_word_count",
                                                 "p95_latency_ms"))


@query("serve_and_monitor")
def q_serve_and_monitor(spark, sf_dir):
    """R1 -> S9 -> R2: requests scored by the scoring stream land in the
    prediction log, and the count-window monitor stream reads that log."""
    from revlens.streaming import monitor_stream as MS
    from revlens.streaming import scoring_stream as SS
    model = served(spark, sf_dir)[3]
    base = scratch_path(spark, f"serve-monitor-{uuid.uuid4().hex}")
    SS.bodies(V.requests(spark, sf_dir)).write.mode("overwrite").json(f"{base}/in")
    SS.start(spark, model, "store-lr", f"{base}/in", f"{base}/log",
             f"{base}/quarantine", f"{base}/ckpt").awaitTermination()
    sig = MS.run_to_table(spark, f"{base}/log", f"{base}/signals", f"{base}/ckpt-monitor")
    return sig.select("model", "predictions", *_r6("mean_confidence", "low_confidence_rate",
                                                   "positive_share", "median_word_count",
                                                   "p95_latency_ms"))


@query("gated_validation_report")
def q_gated_validation_report(spark, sf_dir):
    """P2 then P1 (the gates halt with DataValidationError), then A1-A6: the
    order the data pipeline runs them in."""
    raw = V.reviews(spark, sf_dir)
    Q.require_min_rows(raw, 100)
    Q.require_columns(raw)
    return Q.validation_report(raw)
