"""S1 CSV ingest edge cases and the end-to-end jobs on sf0.001."""
import os
import tempfile

import pytest

from revlens.operators.quality import DataValidationError
from revlens.plans import jobs
from revlens.sources import ingest
from revlens.sources.tables import reviews

from .conftest import SF001

CSV = (
    'Id,Text,Score\n'
    '1,"line one\nline ""two""",5\n'
    '2,NA,4\n'
    '3,nan,1\n'
    '4,"",2\n'
    '5,,3\n'
    '6,"  padded text  ",NA\n'
)


def test_csv_ingest(spark):
    d = tempfile.mkdtemp(prefix="revlens-csv-")
    p = os.path.join(d, "raw.csv")
    with open(p, "w") as f:
        f.write(CSV)
    df = ingest.ingest_csv(spark, p, "Text", "Score")
    rows = sorted((r["review_key"], r["review_text"], r["rating"]) for r in df.collect())
    texts = [t for _, t, _ in rows]
    assert texts == ['line one\nline "two"', None, None, None, None, "  padded text  "]
    assert [r for _, _, r in rows] == [5.0, 4.0, 1.0, 2.0, 3.0, None]
    with pytest.raises(DataValidationError, match="lacks Body"):
        ingest.ingest_csv(spark, p, "Body", "Score")
    with pytest.raises(FileNotFoundError):
        ingest.ingest_csv(spark, p + ".missing", "Text", "Score")


def test_csv_order_is_file_name_then_position(spark):
    """The first file by name wins keep-first also when a later file is larger."""
    from revlens.operators.quality import first_per_text
    d = tempfile.mkdtemp(prefix="revlens-csv2-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("Text,Score\nsame text,5\nsame text,4\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("Text,Score\n" + "".join(f"filler {i} {'x' * 200},3\n" for i in range(200)) + "same text,1\n")
    rows = ingest.ingest_csv(spark, d, "Text", "Score")
    got = first_per_text(rows).where("review_text = 'same text'").collect()
    assert [r["rating"] for r in got] == [5.0]
    order = [r["review_text"] for r in rows.orderBy("review_key").collect()]
    assert order[:3] == ["same text", "same text", f"filler 0 {'x' * 200}"] and order[-1] == "same text"


def test_memo_notices_changed_input(spark):
    from revlens.session import forget_stages, input_stamp, materialize
    d = tempfile.mkdtemp(prefix="revlens-stamp-")
    spark.range(3).write.mode("overwrite").parquet(f"{d}/t")
    one = input_stamp(spark, d)
    spark.range(4).write.mode("append").parquet(f"{d}/t")
    assert one != input_stamp(spark, d)
    path = materialize(spark.range(2), "probe").inputFiles()[0].split("/part-")[0].removeprefix("file:")
    assert os.path.isdir(path)
    forget_stages()
    assert not os.path.isdir(path)


def test_fingerprint_tells_null_places_apart(spark):
    from revlens.sources import fingerprint as FP
    a = spark.createDataFrame([("x", None, "y")], "a string, b string, c string")
    b = spark.createDataFrame([("x", "y", None)], "a string, b string, c string")
    c = spark.createDataFrame([("x", "-", "y")], "a string, b string, c string")
    got = {FP.content_hash(d, ["a", "b", "c"]).first()["content_hash"] for d in (a, b, c)}
    assert len(got) == 3


def test_data_and_feature_jobs(spark):
    out = tempfile.mkdtemp(prefix="revlens-job-")
    raw = reviews(spark, SF001)
    res = jobs.data_job(spark, raw, out, min_rows=100)
    n = res["split_counts"]
    assert res["report"]["total_rows"] == raw.count()
    assert n["test"] == -(-(n["train"] + n["test"]) * 2 // 10)   # ceil(0.2 n)
    feats = jobs.feature_job(spark, out, out, max_features=500, ngram_max=2, sublinear=True, k=8)
    assert feats == {"sizes_ok": True, "rows_ok": True}
    m = jobs.train_job(spark, out, "store-run", f"{out}/runs")
    assert 0.0 <= m["accuracy"] <= 1.0
    runs = spark.read.parquet(f"{out}/runs")
    assert runs.count() == 1 and runs.first()["metrics"]["macro_f1"] == pytest.approx(m["macro_f1"])


def test_data_job_gate(spark):
    raw = reviews(spark, SF001).limit(10)
    with pytest.raises(DataValidationError):
        jobs.data_job(spark, raw, tempfile.mkdtemp(), min_rows=100)


def test_monitor_job(spark):
    from revlens.sources.tables import prediction_log
    res = jobs.monitor_job(prediction_log(spark, SF001))
    assert len(res["checks"]) == 4 * len(res["trigger"])
    assert all(isinstance(t["retrain"], bool) for t in res["trigger"])


def test_transformer_save_load_and_caches(spark):
    import numpy as np
    from revlens.operators import store as ST
    from revlens.plans import catalog as C
    out = tempfile.mkdtemp(prefix="revlens-tr-")
    docs, _ = C.train_test_docs(spark, SF001)
    store, tr = ST.build_store(docs, max_features=300, ngram_max=2, sublinear=True, k=4)
    ST.save_transformer(tr, f"{out}/transformer")
    back = ST.load_transformer(spark, f"{out}/transformer")
    assert np.allclose(back.svd.components, tr.svd.components)
    meta = docs.select("review_id", "text_heavy_clean")
    a = {r["review_id"]: r["features"] for r in ST.transform(tr, meta).collect()}
    b = {r["review_id"]: r["features"] for r in ST.transform(back, meta).collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)
    # Computed once, then read back
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)
    first = ingest.cached_scores(spark, f"{out}/scores", {"C": 1}, compute).count()
    again = ingest.cached_scores(spark, f"{out}/scores", {"C": 1}, compute).count()
    assert (first, again, len(calls)) == (3, 3, 1)
    # another configuration, or a folder whose write never finished, is computed
    ingest.cached_scores(spark, f"{out}/scores", {"C": 2}, compute)
    for folder in os.listdir(f"{out}/scores"):
        os.replace(f"{out}/scores/{folder}/_SUCCESS", f"{out}/scores/{folder}/_unfinished")
    ingest.cached_scores(spark, f"{out}/scores", {"C": 1}, compute)
    assert len(calls) == 3
    # Every written file is in id order
    ST.write_store(store, f"{out}/sorted")
    import pyarrow.parquet as pq
    for folder, _, names in os.walk(f"{out}/sorted"):
        for name in (n for n in names if n.endswith(".parquet")):
            ids = pq.read_table(os.path.join(folder, name), columns=["review_id"]).column(0).to_pylist()
            assert ids == sorted(ids)
    # An id may name one request only
    from revlens.operators import serving as SV
    with pytest.raises(ValueError, match="more than one"):
        SV.serve(None, spark.createDataFrame([(1, "a"), (1, "b")], "request_id long, text string"))
    # Copy the split from an existing store, else recompute
    ST.write_store(store, f"{out}/features")
    got = ingest.split_with_fallback(spark, f"{out}/features", lambda: None)
    assert got.count() == store.count() and got.columns == ["review_id", "split"]
    assert ingest.split_with_fallback(spark, f"{out}/missing", lambda: "recomputed") == "recomputed"


def test_serving_artifact_in_a_fresh_session(spark):
    """Saved as one artifact, loaded by another process: same labels and confidences."""
    import json
    import subprocess
    import sys

    from revlens.operators import serving as SV
    from revlens.plans import catalog as C
    out = tempfile.mkdtemp(prefix="revlens-artifact-")
    store, tr = C.feature_store_of(spark, SF001, k=4, max_features=300)
    model = SV.serving_model(tr, C._lr_on_store(store, "served")[0])
    model.write().overwrite().save(f"{out}/model")
    rows = [(1, "<b>Good</b> the  on it"), (2, ""), (3, None)]
    rows += [(10 + i, r["review_text"]) for i, r in enumerate(store.sparkSession.read.parquet(
        f"{SF001}/documents.parquet").selectExpr("text AS review_text").limit(20).collect())]
    requests = spark.createDataFrame(rows, "request_id long, text string")
    requests.write.parquet(f"{out}/requests")
    want = {r["request_id"]: [r["label"], r["confidence"], r["text_light_clean"]] for r in SV.serve(model, requests).collect()}
    code = f"""
import json
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from revlens.operators import serving as SV
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false") \\
    .config("spark.sql.shuffle.partitions", "2").getOrCreate()
got = SV.serve(PipelineModel.load({out + "/model"!r}), spark.read.parquet({out + "/requests"!r})).collect()
print("RESULT" + json.dumps({{r["request_id"]: [r["label"], r["confidence"], r["text_light_clean"]] for r in got}}))
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, timeout=240)
    line = next((ln for ln in run.stdout.splitlines() if ln.startswith("RESULT")), run.stderr[-2000:])
    assert {int(k): v for k, v in json.loads(line.removeprefix("RESULT")).items()} == want and len(want) == 23


def test_term_model_is_a_sum_over_known_terms(spark):
    import math

    from pyspark.ml import PipelineModel

    from revlens.operators import serving as SV
    from revlens.operators import tfidf as TF
    docs = spark.createDataFrame([(1, "good tasty snack"), (2, "stale snack"), (3, "good")], "review_id long, text_heavy_clean string")
    tf = TF.fit(docs, ngram_max=1, max_features=None)
    coef = spark.createDataFrame([("good", 3.0), ("stale", -4.0)], "term string, coefficient double")
    path = tempfile.mkdtemp(prefix="revlens-term-") + "/m"
    SV.term_model(tf, coef, 0.5).write().overwrite().save(path)
    req = spark.createDataFrame([(7, "GOOD <i>"), (8, "stale!"), (9, "unknown words"), (10, None)], "request_id long, text string")
    got = {r["request_id"]: (r["label"], r["p_positive"]) for r in SV.serve(PipelineModel.load(path), req).collect()}
    for rid, z in ((7, 3.5), (8, -3.5), (9, 0.5), (10, 0.5)):
        assert got[rid][1] == pytest.approx(1 / (1 + math.exp(-z))) and got[rid][0] == ("positive" if z > 0 else "negative")


def test_score_cache_outlives_the_session(spark):
    """A second application finds the table, a changed input does not."""
    from revlens.plans import catalog as C
    from revlens.session import forget_stages
    d, folder = tempfile.mkdtemp(prefix="revlens-in-"), tempfile.mkdtemp(prefix="revlens-cache-")
    spark.range(3).write.mode("overwrite").parquet(f"{d}/t")
    calls = []

    def compute():
        calls.append(1)
        return spark.range(5)
    assert C.cached_scores(spark, d, {"C": 1}, compute, folder).count() == 5
    forget_stages()                                     # what a session knows and owns is gone
    assert C.cached_scores(spark.newSession(), d, {"C": 1}, compute, folder).count() == 5 and len(calls) == 1
    assert not [f for f in os.listdir(folder) if f.startswith("writing")]
    spark.range(1).write.mode("append").parquet(f"{d}/t")
    C.cached_scores(spark, d, {"C": 1}, compute, folder)
    assert len(calls) == 2
    spark.conf.set(C.SCORE_CACHE, "off")
    try:
        C.cached_scores(spark, d, {"C": 1}, compute)
        C.cached_scores(spark, d, {"C": 1}, compute)
    finally:
        spark.conf.unset(C.SCORE_CACHE)
    assert len(calls) == 4
