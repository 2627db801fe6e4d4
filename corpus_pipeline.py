"""Corpus pipeline: language ID, line dedup, near-duplicate removal, benchmark
decontamination and source mixing over ``documents``.

Each stage is (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and
read again as the next stage's docs. All but the last return the columns of their
input; the last returns one row per copy with ``copy`` (1, 2) added.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import decontamination, language_id, line_dedup, mixing, ngram_join
from revlens.llm.common import maybe_member, membership, packed, read
from revlens import session
from revlens.session import drop_tables, materialize


def _rows(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


_SCRATCH: list = []


def _stage(fn):
    """A stage starts by deleting the tables its predecessor worked with: the
    predecessor's result is written by then (that is how stages are chained)."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(_SCRATCH)
        start = len(session._WRITTEN)
        out = fn(spark, docs, sf_dir)
        _SCRATCH[:] = session._WRITTEN[start:]
        return out
    return run_stage


@_stage
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compression margin settles; null and empty texts, and texts
    without a letter, have none and go."""
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    return _rows(language_id.predict(docs, model).where(~F.col("language.rejected")))


@_stage
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its site's boilerplate lines; ``n_chars`` follows the text. Null and
    empty texts and rows without a source stay as they are."""
    got = line_dedup.dedup_lines(docs, host="source")
    row = F.col("_row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(kind))
                            .otherwise(F.col("_row.n_chars")))
    return got.select(row.alias("_row")).select("_row.*")


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group (five-word shingles, similarity 0.8): that of the smallest id,
    ties by the hash of id and text, one of a set of rows with equal id and text; and
    every row without a word, equal rows once."""
    groups = materialize(ngram_join.link(docs.select("doc_id", "text"), n=5, percent=80), "row-groups")
    per_row = groups.groupBy("row").agg(F.first("doc").alias("doc"), F.first("group").alias("group"),
                                        (F.count(F.lit(1)) > 1).alias("again"))
    best = per_row.where("group is not null").groupBy("group").agg(
        F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row", "again")).alias("b"))
    keep = materialize(best.select("b.row", "b.again", F.lit(False).alias("empty")).unionByName(
        per_row.where("group is null").select("row", "again", F.lit(True).alias("empty"))), "kept-rows")
    rows = packed(docs).withColumn("_h", F.xxhash64(F.col("_row.doc_id").cast("long"), F.col("_row.text")))
    once = rows.join(keep.where("not again"), F.col("_h") == F.col("row"), "left_semi")
    # repeated rows are few: only they are brought together
    many = keep.where("again")
    many = maybe_member(rows, "_h", membership(many, "row")).where("_maybe").join(many, F.col("_h") == F.col("row"))
    whole = F.xxhash64("_row")
    many = many.groupBy("_h", F.when(F.col("empty"), whole).alias("_w")).agg(F.min_by("_row", whole).alias("_row"))
    return _rows(once.select("_row").unionByName(many.select("_row")))


@_stage
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark. Null and empty texts
    stand in none and stay."""
    return _rows(decontamination.report(docs, read(spark, sf_dir, "benchmark"), slop=None).where(~F.col("contaminated")))


@_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its rounded rate says; null and empty texts have no
    words to take and get no copy."""
    got = mixing.mix(docs).where("copies > 0")
    return got.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")) \
        .select("_row.*", F.col("copy"))


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: the language stage's decisions (compressed sizes) can't be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
