"""Logistic regression, scoring, runs, ablation and controlled comparison.

M8-M14, S12. Spark ML's LogisticRegression (distributed L-BFGS over
``treeAggregate``) is the solver. The reference's objective
``C * sum(w_i * loss_i) + 0.5 * ||beta||^2`` (intercept not penalised) equals
Spark's ``(1 / sum w) * sum(w_i * loss_i) + (lambda / 2) * ||beta||^2`` with
``lambda = 1 / (C * sum w)`` and ``standardization = False``.
"""

from __future__ import annotations

import time

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from revlens.operators import evaluate as EV
from revlens.session import materialize


def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """M8: w_c = n / (n_classes * n_c). The class table (one row per class) is written,
    so its real size decides whether the join broadcasts it."""
    from pyspark.sql import Window
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    w = Window.partitionBy()
    cw = counts.select(label, (F.sum("_nc").over(w) /
                               (F.count(F.lit(1)).over(w) * F.col("_nc"))).alias(out))
    return df.join(materialize(cw, "class-weights"), label)


class NotConverged(RuntimeError):
    """The solver stopped at its iteration cap."""


#: weight of a levelling row, as a share of all weight
LEVEL_SHARE = 1e-18


def _levelling_rows(data: DataFrame, features: str, label: str, weights: list[str]) -> DataFrame:
    """Rows of no weight that give every column the same spread.

    Spark's solver works on columns divided by their standard deviation, which turns the
    penalty on the plain coefficients into lambda / std^2: rare terms get a penalty a
    million times that of common ones and L-BFGS takes thousands of steps. With equal
    spreads the solver's scaling is one factor for all columns, the Hessian stays the
    well-conditioned X'DX + lambda I, and coefficients need no scaling back.

    Per weighting: +v and -v, once with each label, so that mean, intercept and (at 1e-18
    of the weight) loss and gradient stay what they are, to about 1e-9."""
    spark = data.sparkSession
    stats = data.agg(*[F.struct(Summarizer.variance(F.col(features), F.col(w)).alias("v"), F.sum(w).alias("w")).alias(w)
                       for w in weights]).first()                # one pass, one value per column
    rows = []
    for w in weights:
        spread = stats[w]["v"].toArray()
        lever = np.sqrt((spread.max(initial=0.0) - spread) / (4 * LEVEL_SHARE))
        for sign in (1.0, -1.0):
            for y in (0, 1):
                mine = [LEVEL_SHARE * stats[w]["w"] if x == w else 0.0 for x in weights]
                rows.append((Vectors.dense(sign * lever), y, *mine))
    schema = StructType([StructField(features, VectorUDT()), StructField(label, IntegerType())]
                        + [StructField(w, DoubleType()) for w in weights])
    return spark.createDataFrame(rows, schema).coalesce(1).withColumn(label, F.col(label).cast(data.schema[label].dataType))


def fit_lrs(train: DataFrame, balanced: list[bool], features: str = "features", label: str = "label",
            C: float = 1.0, max_iter: int = 1000, tol: float = 1e-6) -> list:
    """M9 for several class weightings of the same rows: they are read, cached and measured
    once, and the fits run side by side over the cached vectors. Returns one fitted Spark
    ML model per entry of ``balanced`` (``model.summary.totalIterations`` says how many steps it
    took); stopping at ``max_iter`` is an error, not a result.

    Rows keep the partitions they come with (a written table: sized by bytes); every L-BFGS
    iteration is one distributed aggregation.
    """
    from multiprocessing.pool import ThreadPool

    from pyspark import StorageLevel, inheritable_thread_target
    spark = train.sparkSession
    data = balanced_weights(train.select(features, label), label, "w_balanced") if any(balanced) else train
    weights = ["w_balanced" if b else "w_plain" for b in balanced]
    used = sorted(set(weights))
    data = data.withColumn("w_plain", F.lit(1.0)).select(features, label, *used).persist(StorageLevel.MEMORY_AND_DISK)
    # not cached: the solver keeps its own blocks of these rows
    level = data.unionByName(_levelling_rows(data, features, label, used))
    try:
        # sum of balanced weights equals the row count, as does the unweighted sum
        n = data.count()

        def one(weight: str):
            lr = LogisticRegression(featuresCol=features, labelCol=label, weightCol=weight, family="binomial",
                                    regParam=1.0 / (C * n), elasticNetParam=0.0,
                                    standardization=False, maxIter=max_iter, tol=tol)
            return lr.fit(level)

        with ThreadPool(len(used)) as pool:
            models = dict(zip(used, pool.map(inheritable_thread_target(spark)(one), used)))
    finally:
        data.unpersist()
    for model in models.values():
        if model.summary.totalIterations >= max_iter:
            raise NotConverged(f"no optimum after {max_iter} iterations")
    return [models[w] for w in weights]


def fit_lr(train: DataFrame, features: str = "features", label: str = "label",
           balanced: bool = True, C: float = 1.0, max_iter: int = 1000, tol: float = 1e-6):
    """M9: one weighting (see ``fit_lrs``)."""
    return fit_lrs(train, [balanced], features, label, C, max_iter, tol)[0]


def score(model, df: DataFrame, id_col: str = "review_id", label: str = "label",
          run_name: str = "model") -> DataFrame:
    """(model, id, prob_neg, label) - the scored-table shape."""
    p = model.transform(df)
    return p.select(F.lit(run_name).alias("model"), F.col(id_col).alias("id"),
                    vector_to_array("probability")[0].alias("prob_neg"), F.col(label))


def run_metrics(scored: DataFrame) -> DataFrame:
    """A15 per run name: accuracy, macro F1, ROC AUC, negative precision/recall."""
    return EV.metric_bundle(scored).withColumnRenamed("model", "run_name")


def run_record(spark, run_name: str, params: dict, metrics_row: dict, report: str = "",
               started: float | None = None) -> DataFrame:
    """One row of the run log (params and metrics as maps)."""
    now = time.time()
    rec = [(run_name, {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics_row.items() if v is not None}, report,
            float(started or now), float(now))]
    return spark.createDataFrame(
        rec, "run_name string, params map<string,string>, metrics map<string,double>, "
             "report string, started double, ended double")


def append_runs(runs: DataFrame, path: str) -> None:
    """S12 sink: append to the run log table."""
    runs.write.mode("append").parquet(path)


def with_delta(results: DataFrame, base: str, metric: str = "macro_f1") -> DataFrame:
    """Each run's metric minus the base run's (window over the runs
    table, one row per run)."""
    from pyspark.sql import Window
    base_val = F.max(F.when(F.col("run_name") == base, F.col(metric))).over(Window.partitionBy())
    return results.withColumn(f"{metric}_delta", F.col(metric) - base_val)
