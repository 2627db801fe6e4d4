"""Quality classifier: a factorisation machine over hashed words and statistics.

Features of a document are the distinct hashed words of its whole text (value 1 /
sqrt of their number), buckets of structure statistics, and buckets of numeric
metadata columns. Pairwise interactions have low rank and are scored in linear time,
    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Features are made by Spark built-ins; Python gets integer ids only, a batch at a time.
The model is fitted on a bounded sample of labelled rows (``max_rows``, the smallest
id hashes of each label) with numpy on the driver: at most ``max_rows`` sparse rows and
a (2^bits + statistics) x rank table, whatever the corpus holds.

Defined cases: null and empty texts have no word, their statistics still give a
score; null metadata is a bucket of its own; with labels of one kind only, or none,
the score is that share (0.5 for none); repeated rows score equally.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import SPACES, hash_share, packed, words

BITS = 16
STAT_SLOTS = 1 << 10   # ids after the words' for statistics and metadata


@dataclass(frozen=True)
class FactorMachine:
    bias: float
    linear: np.ndarray     # (features,)
    factors: np.ndarray    # (features, rank)

    def score(self, ids: list[np.ndarray]) -> np.ndarray:
        """Probability of label 1 of each id list."""
        flat, x, starts = batch(ids)
        z, _ = self.margin(flat, x, starts)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))

    def margin(self, flat, x, starts):
        vx = self.factors[flat] * x[:, None]
        sums = np.add.reduceat(vx, starts)
        squares = np.add.reduceat(vx * vx, starts)
        z = self.bias + np.add.reduceat(self.linear[flat] * x, starts)
        return z + 0.5 * (sums * sums - squares).sum(axis=1), sums


def batch(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Concatenated ids, their values and row starts (every row has a statistic)."""
    sizes = np.fromiter((len(r) for r in ids), np.int64, len(ids))
    flat = np.concatenate(ids) if len(ids) else np.zeros(0, np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(ids) else np.zeros(0, np.int64)
    is_word = flat < (1 << BITS)
    per_row = np.add.reduceat(is_word.astype(np.float64), starts) if len(ids) else np.zeros(0)
    x = np.where(is_word, np.repeat(1.0 / np.sqrt(np.maximum(per_row, 1.0)), sizes), 1.0)
    return flat, x.astype(np.float32), starts


def _slot(name: str, bucket: Column) -> Column:
    """Feature id of a named bucket."""
    return (F.pmod(F.xxhash64(F.lit(name), bucket.cast("int")), F.lit(STAT_SLOTS)) + (1 << BITS)).cast("int")


def features(text: Column, metadata: dict[str, Column] | None = None) -> Column:
    """array<int> of feature ids of a document; never empty."""
    t = F.coalesce(text, F.lit(""))
    w = words(t, SPACES)

    def build(ws):
        n = F.greatest(F.size(ws), F.lit(1))
        distinct = F.array_distinct(ws)
        hashed = F.array_distinct(F.transform(distinct, lambda x: F.pmod(F.xxhash64(x), F.lit(1 << BITS)).cast("int")))
        def rate(count):
            return F.floor(F.least(F.lit(20.0), 10 * count / n))
        stats = [
            _slot("words", F.floor(F.log2(n.cast("double")))),
            _slot("distinct", F.floor(10 * F.size(distinct) / n)),
            _slot("length", F.floor(F.length(F.array_join(ws, "")) / n)),
            _slot("symbols", rate(F.regexp_count(t, F.lit(r"[#*$%&|<>]")))),
            _slot("bangs", rate(F.regexp_count(t, F.lit("!")))),
            _slot("upper", rate(F.regexp_count(t, F.lit(r"\p{Lu}")))),
            _slot("digits", rate(F.regexp_count(t, F.lit("[0-9]+")))),
            _slot("lines", F.floor(F.log2(F.regexp_count(t, F.lit("\n")) + F.lit(1.0)))),
        ]
        return F.concat(hashed, F.array(*stats))

    ids = F.transform(F.array(w), build).getItem(0)
    extra = [_slot("meta:" + name, F.coalesce(F.floor(F.log2(F.greatest(c.cast("double"), F.lit(0.0)) + 1)), F.lit(-1)))
             for name, c in (metadata or {}).items()]
    return F.concat(ids, F.array(*extra)) if extra else ids


def fit(labelled: DataFrame, label: str = "label", key: str = "doc_id", ids: str = "features",
        max_rows: int = 6000, rank: int = 8, epochs: int = 8, rate: float = 0.1,
        penalty: float = 1e-4, seed: int = 7) -> FactorMachine:
    """Fit on at most ``max_rows`` rows, half of each label where both have enough."""
    rows = labelled.where(F.col(label).isin(0, 1)).select(
        F.col(label).cast("int").alias("label"), F.xxhash64(F.lit(seed), F.col(key)).alias("h"), F.col(key).alias("key"))
    half = max_rows // 2
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    near = F.lit(False)
    for value, n in counts.items():
        near = near | ((F.col("label") == value) & hash_share(F.col("h"), n, half))
    order = Window.partitionBy("label").orderBy(F.pmod("h", F.lit(1 << 31)), "h", "key")
    chosen = rows.where(near).withColumn("k", F.row_number().over(order)).where(F.col("k") <= half) \
        .select(F.col("key").alias("chosen")).distinct()
    sample = labelled.where(F.col(label).isin(0, 1)).join(
        F.broadcast(chosen), F.col(key) == F.col("chosen"), "left_semi")   # at most max_rows ids
    got = sample.select(F.col(label).cast("int").alias("label"), F.col(ids).alias("ids"),
                        F.xxhash64(F.lit(seed), F.col(key)).alias("h")).orderBy("h", "label").limit(2 * max_rows).toArrow()
    y = got.column("label").to_numpy().astype(np.float64)
    size = (1 << BITS) + STAT_SLOTS
    rng = np.random.default_rng(seed)
    w = np.zeros(size, np.float32)
    v = (rng.standard_normal((size, rank)) * 0.01).astype(np.float32)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        return FactorMachine(float(np.log(share / (1 - share))), w, np.zeros_like(v))
    lists = [r.values.to_numpy() for chunk in got.column("ids").chunks for r in chunk]
    # both labels weigh the same in the loss
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    model = FactorMachine(0.0, w, v)
    gw, gv, bias, gb = np.full(size, 1e-6), np.full((size, rank), 1e-6), 0.0, 1e-6
    for _ in range(epochs):
        turn = rng.permutation(len(y))
        for at in range(0, len(turn), 64):
            pick = turn[at:at + 64]
            flat, x, starts = batch([lists[i] for i in pick])
            z, sums = FactorMachine(bias, w, v).margin(flat, x, starts)
            g = weight[pick] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
            rep = np.repeat(np.arange(len(pick)), np.diff(np.append(starts, len(flat))))
            slot, where = np.unique(flat, return_inverse=True)
            gx = (g[rep] * x).astype(np.float32)
            dw = np.bincount(where, gx, len(slot)) + penalty * w[slot]
            dv = np.zeros((len(slot), rank), np.float32)
            np.add.at(dv, where, gx[:, None] * (sums[rep] - v[flat] * x[:, None]))
            dv += penalty * v[slot]
            gw[slot] += dw * dw
            gv[slot] += dv * dv
            gb += g.sum() ** 2
            w[slot] -= (rate * dw / np.sqrt(gw[slot])).astype(np.float32)
            v[slot] -= (rate * dv / np.sqrt(gv[slot])).astype(np.float32)
            bias -= rate * g.sum() / np.sqrt(gb)
    return FactorMachine(float(bias), w, v)


def score(docs: DataFrame, model: FactorMachine, ids: str = "features", out: str = "score") -> DataFrame:
    """``_row`` (the whole input row) and the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.linear, model.factors))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fm = FactorMachine(*shared.value)
        for rows in batches:
            lists = list(rows)
            got = [fm.score(lists[i:i + 256]) for i in range(0, len(lists), 256)]
            yield pd.Series(np.concatenate(got) if got else np.zeros(0))

    return packed(docs).withColumn(out, run(F.col("_row")[ids]))
