"""Row ids, the stratified split, samples and split checks.

W1, W5, W6, T4, J1, J2, J8, U2, A7, P10, P11.

Row membership is decided by ``md5(concat(seed, ':', review_id))``: a stable,
engine-independent pseudo-random order (the same digest in Spark and DuckDB),
so a split or sample is reproducible from the ids alone. Quotas are computed
on the tiny per-label table; the per-row rank inside each label is computed over
range partitions of (label, digest, id) (see ``windows.row_numbers``) so no label
is ever gathered into one task, and only ids and labels are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.operators import windows as W
from revlens.session import materialize

SEED = 42
TEST_SIZE = 0.2


def seeded_hash(id_col: str = "review_id", seed: int = SEED):
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(id_col).cast("string")))


def assign_ids(cleaned: DataFrame, key: str = "review_key") -> DataFrame:
    """``review_id`` = position 0..n-1 in ``key`` order."""
    return W.dense_ids(cleaned, key, "review_id")


def _label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))


def split_quotas(df: DataFrame, label: str = "label",
                 test_size: float = TEST_SIZE) -> DataFrame:
    """Per-label test quotas of a stratified split.

    n_test = ceil(test_size * n) (float arithmetic, as the splitter does);
    train quotas are floor(n_train * c / n) plus largest remainders (ties by
    label), and test quota = c - train quota. Runs on the per-label table.
    """
    c = F.col("_c")
    w = Window.partitionBy()
    n = F.sum(c).over(w)
    counts = _label_counts(df, label)
    q = (counts
         .withColumn("_n", n)
         .withColumn("_n_train", F.col("_n") - F.ceil(F.lit(test_size) * F.col("_n")).cast("bigint"))
         .withColumn("_prod", F.col("_n_train") * c)
         .withColumn("_floor", F.expr("_prod div _n"))
         .withColumn("_rem", F.col("_prod") - F.col("_floor") * F.col("_n")))
    short = F.col("_n_train") - F.sum("_floor").over(w)
    pos = F.row_number().over(Window.partitionBy().orderBy(F.col("_rem").desc(), F.col(label)))
    q = q.withColumn("_train_q", F.col("_floor") + F.when(pos <= short, 1).otherwise(0))
    return q.select(label, c.alias("n_rows"), "_train_q",
                    (c - F.col("_train_q")).alias("test_quota"))


def stratified_split(ided: DataFrame, label: str = "label", test_size: float = TEST_SIZE,
                     seed: int = SEED) -> DataFrame:
    """(review_id, split) with exact per-label test quotas; ids and labels only."""
    narrow = ided.select("review_id", label)
    quotas = split_quotas(narrow, label, test_size).select(label, "test_quota")
    ranked = W.row_numbers(narrow.withColumn("_h", seeded_hash("review_id", seed)), [label],
                           [F.col("_h"), F.col("review_id")], out="_rank")
    # the label rule yields two classes, so the quota table has two rows
    split = F.when(F.col("_rank") <= F.col("test_quota"), "test").otherwise("train").alias("split")
    return ranked.join(F.broadcast(quotas), label).select("review_id", split)


def ids_and_split(cleaned: DataFrame, key: str = "review_key", label: str = "label") -> DataFrame:
    """W1 then W5 on (key, label) alone: (key, review_id, split). The ids are written once;
    quotas and rank read that table, and the caller joins the result to the wide rows once."""
    ids = materialize(W.numbered(cleaned.select(key, label), key), "row-ids")
    return ids.select(key, "review_id").join(stratified_split(ids, label), "review_id")


def sample_quotas(pool: DataFrame, n: int, label: str = "label") -> DataFrame:
    """Per-label quotas round_half_even(n * c / pool) of a stratified sample."""
    w = Window.partitionBy()
    counts = _label_counts(pool, label)
    return counts.select(label, F.col("_c").alias("n_rows"),
                         F.bround(F.lit(n) * F.col("_c") / F.sum("_c").over(w), 0)
                         .cast("bigint").alias("quota"))


def check_sample_quotas(quotas: DataFrame) -> None:
    """A quota larger than its group is an error (sampling without replacement)."""
    over = [r.asDict() for r in quotas.filter(F.col("quota") > F.col("n_rows")).collect()]
    if over:
        raise ValueError(f"sample larger than population: {over}")


def _digest_share(h: Column) -> Column:
    """Position of an md5 digest in [0, 1)."""
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / float(16 ** 8)


def stratified_sample(pool: DataFrame, n: int, label: str = "label", seed: int = SEED,
                      check: bool = False) -> DataFrame:
    """Exactly the per-label quota rows of ``pool`` (no replacement).

    Digests are uniform, so rows far above a label's quota share can't be in the
    sample: only digests below a generous bound are ranked (about the sample's size,
    not the pool's). Should a bound ever leave too few rows, all of them are ranked."""
    quotas = sample_quotas(pool, n, label)
    if check:
        check_sample_quotas(quotas)
    # one row per class of the label rule
    want = {r[label]: (r["quota"], r["n_rows"]) for r in quotas.collect()}
    narrow = pool.select("review_id", label).withColumn("_h", seeded_hash("review_id", seed))
    bound, quota = F.lit(2.0), F.lit(0)
    for value, (q, rows) in want.items():
        here = F.col(label).eqNullSafe(F.lit(value))
        bound = F.when(here, (q + 8 * q ** 0.5 + 16) / max(rows, 1)).otherwise(bound)
        quota = F.when(here, F.lit(q)).otherwise(quota)
    near = W.row_numbers(narrow.where(_digest_share(F.col("_h")) < bound), [label],
                         [F.col("_h"), F.col("review_id")], out="_rank")
    got = {r[label]: r["c"] for r in near.groupBy(label).agg(F.count(F.lit(1)).alias("c")).collect()}
    if any(got.get(v, 0) < min(q, rows) for v, (q, rows) in want.items()):
        near = W.row_numbers(narrow, [label], [F.col("_h"), F.col("review_id")], out="_rank")
    ids = near.where(F.col("_rank") <= quota).select(F.col("review_id").alias("_sampled"))
    return pool.join(ids, F.col("review_id") == F.col("_sampled"), "left_semi")


def simple_sample(df: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """T4: exactly ``n`` rows by seeded order (a top-n: partial per task)."""
    return (df.withColumn("_h", seeded_hash("review_id", seed))
            .orderBy("_h", "review_id").limit(n).drop("_h"))


def attach_split(df: DataFrame, split: DataFrame, which: str | None = None) -> DataFrame:
    """J1 + P10: rows of ``df`` with their split, optionally one side only."""
    s = split if which is None else split.filter(F.col("split") == which)
    return df.join(s, "review_id", "inner")


def split_counts(ided: DataFrame, split: DataFrame) -> DataFrame:
    """Rows per split and label."""
    return (attach_split(ided.select("review_id", "label"), split)
            .groupBy("split", "label").agg(F.count(F.lit(1)).alias("n")))


def check_split_counts(split: DataFrame, expected: dict) -> dict:
    """Refuse when the split's counts differ from the declared ones."""
    got = {r["split"]: r["n"] for r in
           split.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    if got != dict(expected):
        raise ValueError(f"rows per split are {got}; the caller expects {dict(expected)}")
    return got


def split_checks(ided: DataFrame, split: DataFrame) -> DataFrame:
    """J2, U2, J8 as (check, value) rows: sizes, alignment, disjointness, leakage.

    unmatched_ids: ids on one side of the (table, split) full outer join only;
    overlap_ids: ids labelled both train and test; leaked_test_rows: test rows
    whose text also occurs in train.
    """
    # one digest per text: equal texts meet by 128 bits, no text crosses the network
    ids = ided.select("review_id", F.md5("review_text").alias("_digest"))
    per_id = split.groupBy("review_id").agg(
        F.count_if(F.col("split") == "train").alias("a"),
        F.count_if(F.col("split") == "test").alias("b"))
    both = ids.join(per_id.withColumnRenamed("review_id", "_sid"), F.col("review_id") == F.col("_sid"), "full_outer")
    per_text = both.groupBy("_digest").agg(
        F.sum(F.coalesce("a", F.lit(0))).alias("train_rows"), F.sum(F.coalesce("b", F.lit(0))).alias("test_rows"),
        F.count_if((F.col("a") > 0) & (F.col("b") > 0)).alias("overlap_ids"),
        F.count_if(F.col("review_id").isNull() | F.col("_sid").isNull()).alias("unmatched_ids"))
    leaked = F.when(F.col("_digest").isNotNull() & (F.col("train_rows") > 0), F.col("test_rows")).otherwise(0)
    names = ("train_rows", "test_rows", "overlap_ids", "unmatched_ids")
    total = per_text.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
                         F.coalesce(F.sum(leaked), F.lit(0)).alias("leaked_test_rows"))
    return total.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("check"), F.col(c).cast("bigint").alias("value"))
        for c in (*names, "leaked_test_rows")])))


def assert_split_ok(ided: DataFrame, split: DataFrame) -> dict[str, int]:
    """Halt when the split does not line up with the table or leaks texts; returns its row counts."""
    got = {r["check"]: r["value"] for r in split_checks(ided, split).collect()}
    bad = {k: v for k, v in got.items() if k not in ("train_rows", "test_rows") and v}
    if bad:
        raise ValueError(f"split does not line up with the table: {bad}")
    return {"train": got["train_rows"], "test": got["test_rows"]}
