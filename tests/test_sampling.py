"""Quotas, exactness and partition independence."""
from pyspark.sql import functions as F

from revlens.operators import sampling as S
from revlens.operators import windows as W


def labelled(spark, n_neg, n_pos, parts=4):
    return (spark.range(0, n_neg + n_pos, numPartitions=parts)
            .select(F.col("id").alias("review_id"),
                    (F.col("id") >= n_neg).cast("int").alias("label")))


def test_split_quota_golden(spark):
    q = {r["label"]: r["test_quota"] for r in
         S.split_quotas(labelled(spark, 57_067, 306_758)).collect()}
    assert q == {0: 11_413, 1: 61_352}


def test_split_exact_and_partition_independent(spark):
    results = []
    for parts in (1, 4, 17):
        d = labelled(spark, 57, 287, parts)
        s = S.stratified_split(d)
        results.append(sorted((r["review_id"], r["split"]) for r in s.collect()))
    assert results[0] == results[1] == results[2]
    test = [i for i, sp in results[0] if sp == "test"]
    assert len(test) == 69 and len(results[0]) == 344


def test_dense_ids_partition_independent(spark):
    outs = []
    for parts in (1, 4, 17):
        d = spark.range(0, 1000, 7, numPartitions=parts).select((F.col("id") * 3 + 5).alias("k"))
        outs.append(sorted((r["k"], r["review_id"]) for r in W.dense_ids(d, "k").collect()))
    assert outs[0] == outs[1] == outs[2]
    assert [i for _, i in outs[0]] == list(range(len(outs[0])))


def test_stratified_sample_quotas(spark):
    pool = labelled(spark, 45_654, 245_406)
    q = {r["label"]: r["quota"] for r in S.sample_quotas(pool, 50_000).collect()}
    assert q[0] + q[1] == 50_000
    got = S.stratified_sample(labelled(spark, 30, 170), 50)
    c = {r["label"]: r["count"] for r in got.groupBy("label").count().collect()}
    assert c == {0: round(50 * 30 / 200), 1: round(50 * 170 / 200)}


def test_running_sums_match_window(spark):
    from pyspark.sql import Window
    d = spark.range(0, 500, numPartitions=5).select(
        (F.col("id") % 3).alias("g"), ((F.col("id") * 37) % 101).alias("x"), F.col("id").alias("v"))
    fast = W.running_sums(d, ["g"], [F.col("x"), F.col("v")], ["v"])
    w = Window.partitionBy("g").orderBy("x", "v").rowsBetween(Window.unboundedPreceding, 0)
    slow = d.withColumn("v_cum", F.sum("v").over(w))
    assert sorted(fast.collect()) == sorted(slow.collect())


def test_row_numbers_with_null_groups_and_many_ranges(spark):
    from pyspark.sql import Window
    d = spark.range(0, 3000, numPartitions=7).select(
        F.when(F.col("id") % 5 != 0, F.col("id") % 2).alias("g"), F.md5(F.col("id").cast("string")).alias("h"), "id")
    w = Window.partitionBy("g").orderBy("h", "id")
    slow = sorted(tuple(map(str, r)) for r in d.withColumn("rank", F.row_number().over(w)).collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fast = sorted(tuple(map(str, r)) for r in W.row_numbers(d, ["g"], [F.col("h"), F.col("id")]).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert fast == slow


def test_sample_is_the_quota_smallest_digests(spark):
    pool = labelled(spark, 300, 900, parts=5)
    got = {r["review_id"] for r in S.stratified_sample(pool, 120).collect()}
    rows = [(r["label"], r["h"], r["review_id"]) for r in
            pool.select("label", "review_id", S.seeded_hash().alias("h")).collect()]
    want = {i for lab, q in ((0, 30), (1, 90)) for _, _, i in sorted(r for r in rows if r[0] == lab)[:q]}
    assert got == want


def test_simple_sample_exact_n(spark):
    d = labelled(spark, 100, 400)
    assert S.simple_sample(d, 200).count() == 200


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


def brute_quotas(counts, test_size=0.2):
    """Test quotas by the splitter's counting rule, written out directly."""
    import math
    n = sum(counts)
    n_train = n - math.ceil(test_size * n)
    floors = [n_train * c // n for c in counts]
    rems = [n_train * c - f * n for c, f in zip(counts, floors)]
    short = n_train - sum(floors)
    order = sorted(range(len(counts)), key=lambda i: (-rems[i], i))
    train = list(floors)
    for i in order[:short]:
        train[i] += 1
    return [c - t for c, t in zip(counts, train)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=3000), min_size=2, max_size=3))
def test_split_quotas_property(spark, counts):
    edges = [sum(counts[:i]) for i in range(1, len(counts))]
    label = F.lit(0)
    for e in edges:
        label = label + (F.col("id") >= e).cast("int")
    d = spark.range(sum(counts)).select(F.col("id").alias("review_id"), label.alias("label"))
    got = {r["label"]: r["test_quota"] for r in S.split_quotas(d).collect()}
    assert [got[i] for i in range(len(counts))] == brute_quotas(counts)


@settings(max_examples=15, deadline=None)
@given(st.integers(min_value=1, max_value=400), st.integers(min_value=1, max_value=400),
       st.integers(min_value=1, max_value=400))
def test_sample_quotas_property(spark, n_neg, n_pos, n):
    """W6 quotas equal Python's round(n * c / pool) (half to even)."""
    pool = n_neg + n_pos
    n = min(n, pool)
    d = labelled(spark, n_neg, n_pos, parts=3)
    got = {r["label"]: r["quota"] for r in S.sample_quotas(d, n).collect()}
    assert got == {0: int(round(n * n_neg / pool)), 1: int(round(n * n_pos / pool))}
