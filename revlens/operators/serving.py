"""The serving path as one saved artifact, a Spark ML ``PipelineModel``.

Stages: features of raw text (the fitted transformer), a classifier, the verdict. All of
them are written by ``model.save(path)`` and come back by ``PipelineModel.load(path)`` in
any session that can import this module, so transformer and classifier can't drift apart.

Two classifiers fit in: the fitted logistic regression on the dense features, or a table of
term coefficients (``TermScorer``), which is a join and a sum over the long TF-IDF table and
needs no solver.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import store as ST
from revlens.operators import tfidf as TF

ID, TEXT, FEATURES = "request_id", "text", "fv"


class _Writer(MLWriter):
    """Metadata as every ML stage has it, the stage's tables beside it."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sc)
        self.stage.save_tables(f"{path}/tables")


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sc)
        stage = self.kind.load_tables(self.sparkSession, f"{path}/tables")
        stage._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(stage, meta)
        return stage


class _TableStage(Transformer, MLWritable, MLReadable):
    """A stage that keeps its fitted state in tables."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


def _cleaned(requests: DataFrame) -> DataFrame:
    return requests.withColumn("text_light_clean", T.light_clean(TEXT)).withColumn("text_heavy_clean", T.heavy_clean(TEXT))


class ReviewFeatures(_TableStage):
    """Raw text to the lightly cleaned text and the store's dense features."""

    def __init__(self, fitted: ST.Transformer):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        feats = ST.transform(self.fitted, _cleaned(dataset), id_col=ID)
        return feats.withColumn(FEATURES, array_to_vector("features")).drop("features", "text_heavy_clean")

    def save_tables(self, path: str) -> None:
        ST.save_transformer(self.fitted, path)

    @classmethod
    def load_tables(cls, spark, path: str) -> ReviewFeatures:
        return cls(ST.load_transformer(spark, path))


class TermScorer(_TableStage):
    """Raw text to P(positive) by a table of term coefficients: the margin is the sum of weight *
    coefficient over the long TF-IDF table, a text without a known term has the intercept's."""

    def __init__(self, tfidf: TF.TfidfModel, coefficients: DataFrame, intercept: float):
        super().__init__()
        self.tfidf, self.coefficients, self.intercept = tfidf, coefficients, intercept

    def _transform(self, dataset: DataFrame) -> DataFrame:
        docs = _cleaned(dataset)
        weights = TF.transform(self.tfidf, docs, id_col=ID)
        # one row per vocabulary term; the table's real size decides about a broadcast
        margin = weights.join(self.coefficients, "term").groupBy(F.col(ID).alias("_id")).agg(
            F.sum(F.col("weight") * F.col("coefficient")).alias("_m"))
        z = F.coalesce(F.col("_m"), F.lit(0.0)) + self.intercept
        return (docs.drop("text_heavy_clean").join(margin, F.col(ID) == F.col("_id"), "left")
                .withColumn("p_positive", 1 / (1 + F.exp(-z))).drop("_id", "_m"))

    def save_tables(self, path: str) -> None:
        m = self.tfidf
        m.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
        self.coefficients.write.mode("overwrite").parquet(f"{path}/coefficients")
        row = [(m.n_docs, m.ngram_max, m.sublinear, m.max_features, float(self.intercept))]
        m.vocab.sparkSession.createDataFrame(
            row, "n_docs long, ngram_max int, sublinear boolean, max_features int, intercept double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load_tables(cls, spark, path: str) -> TermScorer:
        s = spark.read.parquet(f"{path}/settings").first()
        tfidf = TF.TfidfModel(spark.read.parquet(f"{path}/vocab"), s["n_docs"], s["ngram_max"], s["sublinear"], s["max_features"])
        return cls(tfidf, spark.read.parquet(f"{path}/coefficients"), s["intercept"])


class Verdict(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """label name and confidence from P(positive)."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = F.col("p_positive") if "p_positive" in dataset.columns else vector_to_array("probability")[1]
        return dataset.select(ID, TEXT, "text_light_clean", T.decode_label((p > 0.5).cast("int")).alias("label"),
                              T.confidence(p).alias("confidence"), p.alias("p_positive"))


def serving_model(tr: ST.Transformer, lr_model) -> PipelineModel:
    """Transformer and classifier as one artifact."""
    return PipelineModel([ReviewFeatures(tr), lr_model.copy({lr_model.featuresCol: FEATURES}), Verdict()])


def term_model(tfidf: TF.TfidfModel, coefficients: DataFrame, intercept: float = 0.0) -> PipelineModel:
    """The same path with coefficients (term, coefficient) that are given."""
    return PipelineModel([TermScorer(tfidf, coefficients, intercept), Verdict()])


def release(model: PipelineModel) -> None:
    """Drop what served batches left behind; what is made of them must have been written."""
    for stage in model.stages:
        if isinstance(stage, ReviewFeatures):
            stage.fitted.svd.release()


def serve(model: PipelineModel, requests: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """Raw text in; label, confidence and the lightly cleaned text out. ``id_col`` must be
    unique: two texts under one id would be counted as one document."""
    twice = requests.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    if twice:
        raise ValueError(f"{id_col} names more than one request")
    out = model.transform(requests.select(F.col(id_col).alias(ID), F.col(text_col).alias(TEXT)))
    return out.select(F.col(ID).alias(id_col), F.col(TEXT).alias(text_col), "text_light_clean", "label", "confidence", "p_positive")
