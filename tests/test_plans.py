"""Plan shape checks: the properties the design relies on at scale."""
import contextlib
import io

from pyspark.sql import functions as F

from revlens.operators import monitor as MO
from revlens.plans import catalog as C
from revlens.sources import tables as V

from .conftest import SF01


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_last_n_limits_before_shuffle(spark):
    p = plan(MO.signals(MO.last_n(V.prediction_log(spark, SF01))))
    first_limit = p.index("WindowGroupLimit")
    first_exchange = p.index("Exchange")
    # the tree is printed top-down: a limit below the exchange appears after it
    assert p.count("WindowGroupLimit") >= 2 and first_limit < first_exchange
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double,props:string>" in p


def test_train_read_prunes_partition_and_columns(spark):
    _, train = C.train_test_docs(spark, SF01)
    p = plan(train.select("review_id", "text_heavy_clean"))
    assert "PartitionFilters: [isnotnull(split" in p and "= train)" in p
    schema = [ln for ln in p.splitlines() if ln.startswith("ReadSchema:")][0]
    cols = sorted(schema.split("struct<")[1].rstrip(">").split(","))
    assert cols == ["review_id:bigint", "text_heavy_clean:string"]


def test_tfidf_weights_one_exchange_and_bounded_broadcast(spark):
    p = plan(C.REGISTRY["tfidf_sublinear"](spark, SF01))
    body = p.split("\n\n")[0]
    assert body.count("Exchange") == 2            # the id repartition + the vocabulary broadcast
    assert "BroadcastExchange" in body and "BroadcastHashJoin" in body


def test_text_counts_hash_aggregate_and_move_no_text(spark):
    """Report, ledger, duplicate counting and leak checks work on digests."""
    for name in ("validation_report", "attrition_ledger", "dedup_first", "split_leak"):
        p = plan(C.REGISTRY[name](spark, SF01))
        assert "SortAggregate" not in p, name
        moved = [ln for ln in p.splitlines() if ln.startswith("Arguments: hashpartitioning")]
        assert moved and not any("text" in ln for ln in moved), name
        inputs = [b for b in p.split("\n\n") if ") Exchange" in b]
        assert inputs and not any("review_text" in b or "text#" in b for b in inputs), name


def test_clean_joins_repeated_digests_only(spark):
    p = plan(C.cleaned_reviews(spark, SF01))
    assert "SortAggregate" not in p and "repeated-texts" in p


def test_ranks_have_no_unpartitioned_window_over_rows(spark):
    ided, split = C.split_of(spark, SF01)
    from revlens.operators import windows as W
    body = plan(W.row_numbers(split.select("split", "review_id"), ["split"], [F.col("review_id")]))
    windows = [ln for ln in body.splitlines() if ln.startswith("Arguments:") and "row_number" in ln]
    assert windows and all(W.PART in ln for ln in windows)


def test_sequence_encode_single_shuffle(spark):
    body = plan(C.REGISTRY["sequence_encode"](spark, SF01)).split("\n\n")[0]
    shuffles = [ln for ln in body.splitlines() if "Exchange" in ln and "Broadcast" not in ln]
    assert len(shuffles) == 1 and "BroadcastExchange" in body


def test_csv_keep_first_writes_range_parts(spark, monkeypatch):
    """Each source is written by many tasks, in files whose names sort in id order."""
    from revlens.sources import ingest
    seen, read_csv = [], ingest.ingest_csv

    def spy(spark, path, *rest):
        seen.append(path)
        return read_csv(spark, path, *rest)

    monkeypatch.setattr(ingest, "ingest_csv", spy)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = C.REGISTRY["csv_keep_first"](spark, SF01)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(seen[0]) \
        .select("Id", "Score", F.col("_metadata.file_path").alias("f")).groupBy("Score", "f") \
        .agg(F.min(F.col("Id").cast("long")).alias("low"), F.max(F.col("Id").cast("long")).alias("high")).collect()
    for score in ("5", "1"):
        ends = [(r["low"], r["high"]) for r in sorted((r for r in files if r["Score"] == score), key=lambda r: r["f"])]
        assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where(~F.col("text").isin(list(ingest.NA_TOKENS)))
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", F.lit(1).alias("labelled"))
    want = docs.join(labels, "doc_id", "left").groupBy("text").agg(F.max("labelled").alias("labelled"))
    assert {(r["digest"], r["rating"]) for r in out.collect()} == {
        (r["d"], 5.0 if r["labelled"] else 1.0) for r in want.select(F.md5("text").alias("d"), "labelled").collect()}


def test_colocated_tables_join_without_exchange(spark):
    from revlens.operators import colocated as CO
    tables = C.colocated_store(spark, SF01)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = CO.join_all(tables)
        p = plan(joined)
        n = joined.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert p.count("SortMergeJoin") >= 2 and "Exchange" not in p
    assert n == C.review_store(spark, SF01).count()


def test_extension_reads_the_digest_index_only(spark, monkeypatch):
    """The stored rows are not read when new ones are cleaned."""
    import uuid

    from revlens.operators import quality as Q
    from revlens.session import scratch_path
    path = scratch_path(spark, f"test-extend-{uuid.uuid4().hex}")
    Q.write_cleaned_store(C.cleaned_reviews(spark, SF01), path)
    seen, clean = [], Q.clean_and_label

    def spy(df, key):
        seen.append(plan(df))
        return clean(df, key)
    monkeypatch.setattr(Q, "clean_and_label", spy)
    new = V.dirty_reviews(spark, SF01).withColumn("review_key", F.col("review_key") + 1_000_000_000)
    got = sorted(r["review_key"] for r in Q.extend_store(spark, path, new, 1).collect())
    assert len(seen) == 1 and "/rows" not in seen[0] and "known-keys" in seen[0]
    again = Q.extend_store(spark, path, new, 1)          # a retry writes the same batch
    assert sorted(r["review_key"] for r in again.collect()) == got and got
    both = spark.read.parquet(f"{path}/rows")
    assert both.count() == both.select("review_text").distinct().count()
