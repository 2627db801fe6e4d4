"""M4 against numpy SVD, M9 against a numpy Newton solve, on the embeddings table."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.operators import models as MD
from revlens.operators import svd as SVD

from .conftest import SF01


# The embeddings' spectrum is almost flat (random vectors), the slowest case
# for power iteration, so the randomized solver is given more passes here.
@pytest.mark.parametrize("method,tol,n_iter", [("exact", 1e-6, 0), ("randomized", 1e-4, 60)])
def test_svd_matches_numpy(spark, method, tol, n_iter):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    arr = emb.select(F.col("vec_id").alias("review_id"),
                     F.sequence(F.lit(0), F.size("embedding") - 1).alias("idx"),
                     F.col("embedding").cast("array<double>").alias("val"))
    m = SVD.fit(arr, 64, 5, method=method, n_iter=n_iter)
    x = np.array([r["embedding"] for r in emb.orderBy("vec_id").collect()], dtype=np.float64)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(m.singular_values, s[:5], rtol=tol)
    v = SVD.fix_signs(vt[:5].T)
    assert np.allclose(np.abs(m.components), np.abs(v), atol=100 * tol)
    proj = SVD.project(m, arr.select("review_id"), arr).orderBy("review_id").collect()
    got = np.array([r["features"] for r in proj])
    assert np.allclose(got, (x @ m.components).astype(np.float32), atol=1e-4)


def newton_lr(x, y, w, lam):
    """Weighted logistic loss / sum(w) + lam/2 ||beta||^2, intercept unpenalised;
    damped Newton with backtracking."""
    n, d = x.shape
    xb = np.hstack([x, np.ones((n, 1))])
    reg = np.full(d + 1, lam)
    reg[-1] = 0.0
    sw = w.sum()

    def obj(b):
        z = xb @ b
        return (w * (np.logaddexp(0, z) - y * z)).sum() / sw + 0.5 * (reg * b * b).sum()

    beta = np.zeros(d + 1)
    for _ in range(100):
        p = 0.5 * (1 + np.tanh(0.5 * (xb @ beta)))
        g = xb.T @ (w * (p - y)) / sw + reg * beta
        h = (xb * (w * p * (1 - p))[:, None]).T @ xb / sw + np.diag(reg) + 1e-12 * np.eye(d + 1)
        step = np.linalg.lstsq(h, g, rcond=None)[0]
        t, f0 = 1.0, obj(beta)
        while obj(beta - t * step) > f0 and t > 1e-8:
            t *= 0.5
        beta = beta - t * step
        if np.abs(g).max() < 1e-10:
            break
    return beta


@pytest.mark.parametrize("C", [0.05, 0.01])
def test_lr_matches_newton(spark, C):
    from pyspark.ml.functions import array_to_vector
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        (F.col("label") == 0).cast("int").alias("label"))   # binary: class 0 against the rest
    model = MD.fit_lr(emb, C=C, tol=1e-12, max_iter=1000)
    rows = emb.join(MD.balanced_weights(emb.select("vec_id", "label")), ["vec_id", "label"]).collect()
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([r["label"] for r in rows], dtype=float)
    w = np.array([r["weight"] for r in rows])
    beta = newton_lr(x, y, w, 1.0 / (C * w.sum()))
    assert np.allclose(model.coefficients.toArray(), beta[:-1], atol=1e-4)
    assert abs(model.intercept - beta[-1]) < 1e-4


def test_vectorize_equals_long_table(spark):
    """JVM-side vectors (CountVectorizer + idf + L2) equal the long-table weights."""
    from revlens.operators import tfidf as TF
    rows = [(1, "good tasty snack good"), (2, "stale awful snack"), (3, "zz"), (4, "good good good")]
    docs = spark.createDataFrame(rows, "review_id long, text_heavy_clean string")
    tf = TF.fit(docs, ngram_max=2, max_features=6)
    vocab = {r["term"]: r["idx"] for r in tf.vocab.collect()}
    long = {(r["review_id"], vocab[r["term"]]): r["weight"] for r in TF.transform(tf, docs).collect()}
    vec = {r["review_id"]: r["features"] for r in TF.vectorize(tf, docs).collect()}
    for rid, v in vec.items():
        got = {int(i): float(x) for i, x in zip(v.indices, v.values)}
        want = {i: w for (d, i), w in long.items() if d == rid}
        assert got.keys() == want.keys()
        assert all(abs(got[i] - want[i]) < 1e-12 for i in got)


def test_gram_pass_tree_sum_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(SVD, "CHUNK_ROWS", 16)
    monkeypatch.setattr(SVD, "RADIX", 2)
    monkeypatch.setattr(SVD, "CELLS", 700)
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    arr = emb.select(F.col("vec_id").alias("review_id"),
                     F.sequence(F.lit(0), F.size("embedding") - 1).alias("idx"),
                     F.col("embedding").cast("array<double>").alias("val")).repartition(9)
    x = np.array([r["val"] for r in arr.orderBy("review_id").collect()], dtype=np.float64)
    q = np.random.default_rng(1).standard_normal((64, 7))
    got = SVD._gram_pass(arr, q, 9)
    assert np.allclose(got, x.T @ (x @ q), rtol=1e-9, atol=1e-9)


def test_blocks_and_orthonormal_columns(spark, monkeypatch):
    """Products by blocks equal the whole product; dependent columns are dropped."""
    monkeypatch.setattr(SVD, "BLOCK_TERMS", 10)
    rng = np.random.default_rng(2)
    m = rng.standard_normal((64, 5))
    blocks = SVD._Blocks(spark, m)
    assert len(blocks.parts) == 7
    dense = rng.standard_normal((9, 64)) * (rng.random((9, 64)) < 0.2)
    dense[4] = 0
    rows, cols = np.nonzero(dense)
    assert np.allclose(blocks.times(cols, dense[rows, cols], rows, 9), dense @ m)
    z = np.hstack([m, m @ rng.standard_normal((5, 2)), np.zeros((64, 1))]) * np.array([1, 1e-6, 1e5, 1, 1, 1, 1, 1])
    q = SVD._orthonormal(z)
    assert q.shape == (64, 5) and np.allclose(q.T @ q, np.eye(5), atol=1e-12)
    assert np.allclose(q @ (q.T @ m), m, atol=1e-6)


def test_to_vectors_equals_vectorize_and_keeps_empty_docs(spark):
    from revlens.operators import tfidf as TF
    rows = [(1, "good tasty snack good", 1), (2, "stale awful snack", 0), (3, "q", 0), (4, "good good", 1)]
    docs = spark.createDataFrame(rows, "review_id long, text_heavy_clean string, label int")
    tf = TF.fit(docs, ngram_max=2, max_features=6)
    size = tf.vocab.count()
    a = {r["review_id"]: r["features"] for r in
         TF.to_vectors(TF.transform(tf, docs), docs.select("review_id", "label"), size).collect()}
    b = {r["review_id"]: r["features"] for r in TF.vectorize(tf, docs).collect()}
    assert a.keys() == b.keys() == {1, 2, 3, 4}
    assert a[3].numNonzeros() == 0 and a[3].size == size          # no known term: zero vector
    for k in a:
        assert np.allclose(a[k].toArray(), b[k].toArray())


def test_nested_stores_equal_separate_ones(spark):
    """Shared counts, vocabulary and range finder give the features that separate builds give."""
    from revlens.operators import store as ST
    from revlens.plans import catalog as C
    from .conftest import SF001
    docs, _ = C.train_test_docs(spark, SF001)
    base = dict(max_features=300, ngram_max=2, sublinear=False, k=4)
    configs = {"a": base, "b": dict(base, k=8), "c": dict(base, sublinear=True), "d": dict(base, max_features=400, ngram_max=1)}
    nested = ST.build_nested(docs, configs)
    for name, cfg in configs.items():
        want = {r["review_id"]: r for r in ST.build_store(docs, **cfg)[0].collect()}
        got = {r["review_id"]: r for r in nested[name].collect()}
        assert got.keys() == want.keys()
        for i in want:
            assert got[i]["split"] == want[i]["split"] and got[i]["text_length"] == want[i]["text_length"]
            assert len(got[i]["features"]) == cfg["k"]
        # leading components of the wider finder are at least as well converged: compare energies and signs
        x = np.array([want[i]["features"] for i in sorted(want)])
        y = np.array([got[i]["features"] for i in sorted(want)])
        assert np.allclose((x ** 2).sum(axis=0), (y ** 2).sum(axis=0), rtol=0.02)
        assert np.allclose(x[:, :2], y[:, :2], atol=0.02)


def test_gram_pass_by_one_group_shuffles_nothing_and_leaves_no_files(spark):
    """One group's sums cover all its partitions, the result does not depend on the groups, and no broadcast file stays."""
    import os
    rng = np.random.default_rng(5)
    rows = [(i, sorted(rng.choice(300, 12, replace=False).tolist()), rng.random(12).tolist()) for i in range(200)]
    arr = spark.createDataFrame(rows + [(200, [], []), (201, None, None)], "review_id long, idx array<int>, val array<double>").repartition(7)
    x = np.zeros((300, 202))
    for i, idx, val in rows:
        x[idx, i] = val
    q = rng.standard_normal((300, 9))
    folder = spark.sparkContext._temp_dir
    before = len(os.listdir(folder))
    one = SVD._gram_pass(arr, q, 1)
    assert len(os.listdir(folder)) == before
    assert np.allclose(one, x @ (x.T @ q), rtol=1e-9, atol=1e-12)
    assert np.allclose(one, SVD._gram_pass(arr, q, 5), rtol=1e-9, atol=1e-12)
    m = SVD.fit(arr, 300, 5, n_iter=30)
    assert np.allclose(m.singular_values, np.linalg.svd(x)[1][:5], rtol=1e-3)
    assert len(os.listdir(folder)) == before


def test_groups_sum_up_little_beside_the_rows():
    # 1,000 entries of 20,000 x 600: one group; many entries: at most an eighth of their bytes, or GROUP entries each
    assert SVD._groups(1000, 20_000 * 600, 32) == 1
    assert SVD._groups(3_000_000, 64 * 64, 32) == 32
    assert SVD._groups(10 * SVD.GROUP, 20_000 * 600, 1000) == 10


def test_projection_sends_components_once_and_releases_them(spark):
    import os
    m = SVD.SvdModel(np.pad(np.eye(6)[:, :2], ((0, 0), (0, 3))), np.ones(5), 6)
    arr = spark.createDataFrame([(1, [0, 4], [2.0, 1.0]), (2, [1], [3.0])], "review_id long, idx array<int>, val array<double>")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "review_id long")
    folder = spark.sparkContext._temp_dir
    before = len(os.listdir(folder))
    for _ in range(3):
        got = {r["review_id"]: r["features"] for r in SVD.project(m, ids, arr).collect()}
        assert got == {1: [2, 0, 0, 0, 0], 2: [0, 3, 0, 0, 0], 3: [0] * 5}
    assert len(os.listdir(folder)) == before + 1
    m.release()
    assert len(os.listdir(folder)) == before


def test_projection_sends_a_block_of_columns_at_a_time(spark, monkeypatch):
    """Components above the bound are never broadcast whole, and no broadcast or earlier table stays."""
    import os

    from revlens import session as RS
    rng = np.random.default_rng(3)
    v = np.pad(rng.standard_normal((40, 7)), ((0, 0), (0, 2)))
    rows = [(i, sorted(rng.choice(40, 6, replace=False).tolist()), rng.random(6).tolist()) for i in range(30)]
    arr = spark.createDataFrame(rows, "review_id long, idx array<int>, val array<double>")
    ids = spark.createDataFrame([(i, f"t{i}") for i in range(31)] + [(4, "again"), (None, "none")], "review_id long, t string")
    want = {r["t"]: r["features"] for r in SVD.project(SVD.SvdModel(v, np.ones(9), 40), ids, arr).collect()}
    folder, sent, written = spark.sparkContext._temp_dir, [], len(RS._WRITTEN)
    before = len(os.listdir(folder))
    plain = SVD._Blocks.__init__
    monkeypatch.setattr(SVD._Blocks, "__init__", lambda self, s, m: (sent.append(m.size), plain(self, s, m))[1])
    monkeypatch.setattr(SVD, "SENT_CELLS", 120)
    m = SVD.SvdModel(v, np.ones(9), 40)
    out = SVD.project(m, ids, arr)
    assert sent == [120, 120, 40] and len(os.listdir(folder)) == before and len(RS._WRITTEN) == written + 1
    got = {r["t"]: r["features"] for r in out.collect()}
    assert got == want and len(got) == 33 and got["none"] == got["t30"] == [0.0] * 9 and out.columns == ["review_id", "t", "features"]
    m.release()
    assert len(RS._WRITTEN) == written and not os.path.exists(out._written_path.removeprefix("file:"))


def test_projection_in_blocks_writes_texts_once(spark, monkeypatch):
    """Tables between the blocks hold products only: neither what else the rows hold nor the sparse rows again;
    the sparse rows go before the result is written."""
    import os
    v = np.random.default_rng(5).standard_normal((8, 6))
    rows = [(i, [i % 8], [1.0]) for i in range(20)]
    arr = SVD.materialize(spark.createDataFrame(rows, "review_id long, idx array<int>, val array<double>"), "rows")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "review_id long, t string")
    plain, columns, there = SVD.materialize, [], []

    def noted(df, name, *more, **kw):
        columns.append(df.columns)
        there.append(os.path.exists(arr._written_path.removeprefix("file:")))
        return plain(df, name, *more, **kw)

    monkeypatch.setattr(SVD, "SENT_CELLS", 16)
    monkeypatch.setattr(SVD, "materialize", noted)
    m = SVD.SvdModel(v, np.ones(6), 8, tables=[arr])
    got = {r["review_id"]: r["features"] for r in SVD.project(m, docs, arr).collect()}
    assert columns == [["review_id", "at", "part"]] * 3 + [["review_id", "t", "features"]]
    assert there == [True] * 3 + [False]
    assert all(got[i] == v[i % 8].astype(np.float32).tolist() for i in range(20))
    m.release()


def test_term_counts_get_partitions_by_text(spark, monkeypatch):
    """A task counts a bounded amount of text, whatever the session's shuffle partitions; counts stay the same."""
    from revlens.operators import tfidf as TF
    rows = [(i, "good tasty snack good" if i % 3 else "stale awful snack") for i in range(40)] + [(40, None), (41, "")]
    docs = spark.createDataFrame(rows, "review_id long, text_heavy_clean string")
    want = sorted(map(tuple, TF.term_counts(docs, ngram_max=2).collect()))
    monkeypatch.setattr(TF, "TASK_CHARS", 50)
    counts = TF.term_counts(docs, ngram_max=2)
    assert TF.text_parts(docs) == -(-sum(len(t or "") for _, t in rows) // 50) > 10
    assert counts.rdd.getNumPartitions() == TF.text_parts(docs)
    assert sorted(map(tuple, counts.collect())) == want and len(want) == 26 * 6 + 14 * 5
    assert TF.text_parts(docs.where("review_id = 40")) == 1


def test_term_statistics_get_partitions_by_text(spark, monkeypatch):
    """The shuffle by term follows the text's size, not the session's setting, which comes back as it was."""
    from revlens.operators import tfidf as TF
    docs = spark.createDataFrame([(i, f"word{i} snack good") for i in range(40)] + [(40, None)], "review_id long, text_heavy_clean string")
    want = sorted(map(tuple, TF.term_stats(TF.term_counts(docs)).collect()))
    used, key = [], "spark.sql.shuffle.partitions"
    plain = TF.materialize
    monkeypatch.setattr(TF, "TASK_CHARS", 50)
    monkeypatch.setattr(TF, "materialize", lambda df, name, **kw: (used.append(int(spark.conf.get(key))), plain(df, name, **kw))[1])
    before = spark.conf.get(key)
    assert sorted(map(tuple, TF.written_stats(docs).collect())) == want and len(want) == 42
    assert {r["term"] for r in TF.fit(docs, max_features=30).vocab.collect()} >= {"snack", "good"}
    assert used == [TF.text_parts(docs)] * 2 and used[0] > int(before) and spark.conf.get(key) == before


def test_written_tables_leave_no_shuffle_files(spark):
    """A stage table's shuffle files go when it is written, not at the driver's next garbage collection."""
    import time
    from revlens.session import materialize

    def files():
        every = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x for x in every.mkString(" ").split() if "/shuffle_" in x}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old, before = spark.conf.get(key, None), files()
    got = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("l")), "rows")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    left = files() - before
    assert not left and got.count() == 7 and spark.conf.get(key, None) == old


def test_run_sums_are_stacked_products_of_bounded_pieces(monkeypatch):
    """Runs of one length are one product; a work array holds CELLS doubles also where one run is longer."""
    monkeypatch.setattr(SVD, "CELLS", 40)
    rng = np.random.default_rng(9)
    sizes = [1, 3, 3, 1, 50, 3, 1]
    keys = np.repeat(np.arange(7) * 2, sizes)
    of, vals, factors = rng.integers(0, 11, len(keys)), rng.random(len(keys)), rng.standard_normal((11, 5))
    got, seen = np.zeros((13, 5)), []
    for k, sums in SVD._run_sums(vals, of, factors, keys):
        assert len(set(k.tolist())) == len(k)
        got[k] += sums
        seen.append(k.tolist())
    want = np.zeros((13, 5))
    np.add.at(want, keys, vals[:, None] * factors[of])
    assert np.allclose(got, want, rtol=1e-12) and seen.count([8]) == 7 and [0, 6, 12] in seen
    assert not list(SVD._run_sums(vals[:0], of[:0], factors, keys[:0]))


def test_power_pass_takes_few_wide_blocks(spark, monkeypatch):
    """20,000 terms by 610 columns on four cores: 12 blocks of 52 columns, not 24 of 26."""
    arr = spark.createDataFrame([(1, [0, 19_999], [1.0, 2.0]), (2, [5], [3.0])], "review_id long, idx array<int>, val array<double>")
    q = np.random.default_rng(4).standard_normal((20_000, 610))
    sent = []
    broadcast = spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: (sent.append(x.shape), broadcast(x))[1])
    got = SVD._gram_pass(arr, q, 1)
    assert len(sent) == -(-610 // (SVD.SENT_CELLS // spark.sparkContext.defaultParallelism // 20_000)) <= 12
    assert np.allclose(got[0], q[0] + 2 * q[-1]) and np.allclose(got[5], 9 * q[5]) and not got[6].any()


def test_lr_caches_the_rows_once(spark, monkeypatch):
    """Beside the solver's own blocks only the weighted rows are cached, and nothing stays cached."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    rng = np.random.default_rng(6)
    rows = [(x.tolist(), int(x[0] + 0.3 * rng.standard_normal() > 0)) for x in rng.standard_normal((60, 3))]
    train = spark.createDataFrame(rows, "f array<double>, label int").select(array_to_vector("f").alias("features"), "label")
    plain, cached = Classic.persist, []
    monkeypatch.setattr(Classic, "persist", lambda self, *a: (cached.append(self.columns), plain(self, *a))[1])
    there = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    both = MD.fit_lrs(train, [True, False])
    assert cached == [["features", "label", "w_balanced", "w_plain"]] and len(both) == 2
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == there
