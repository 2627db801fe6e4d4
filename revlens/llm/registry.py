"""Queries of the operators and of the pipeline, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import (class_lm, decontamination, fill_middle, html_extract, language_id, license_scan, line_dedup, mixing,
                         ngram_join, quality_fm, quality_rules, url_rules, vector_codes)
from revlens.llm.common import read
from revlens.llm.oracle import ORACLE
from revlens.session import materialize


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~language_id.held_out()))
    got = language_id.predict(docs.select("doc_id", "text"), model)
    return got.select("_row.doc_id", language_id.held_out("_row.doc_id").alias("held_out"),
                      F.col("language.lang").alias("lang_pred"),
                      F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality_rules.passes("base")).alias("base_failed"),
                       quality_rules.passes("v1").alias("kept"), F.col("failed").alias("rule_bits"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("_row.doc_id", F.get("found", F.lit(0)).alias("license"), F.array_join("found", ",").alias("licenses"),
                       F.size("blocks").cast("long").alias("n_blocks"),
                       F.size(F.filter("blocks", lambda b: b["match"]["confirmed"])).cast("long").alias("n_confirmed"),
                       F.array_max(F.transform("blocks", lambda b: b["match"]["gain"])).alias("best_gain"))


def op4_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = docs.select("doc_id", quality_fm.features(F.col("text"), {"n_chars": F.length("text")}).alias("features"))
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label"))
    labelled = rows.where(~language_id.held_out("doc_id", 3, 1)).join(labels, F.col("doc_id") == F.col("label_id"))
    model = quality_fm.fit(labelled.select("doc_id", "label", "features"))
    got = quality_fm.score(rows, model)
    return got.select("_row.doc_id", language_id.held_out("_row.doc_id", 3, 1).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_extract.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select("_row.page_id", "_row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), carry=["doc_id"])
    return rows.select("_row.doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select("_row.doc_id", "_row.source", "text", "n_lines", "n_dropped")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    labels = read(spark, sf_dir, "labels")
    # the last number of a page's path is the document its article was taken from
    doc = F.regexp_extract(url_rules.path_of(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1).try_cast("long")
    bad = labels.select(F.col("doc_id").alias("label_id"),
                        ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    mined = url_rules.mine(pages.withColumn("d", doc).join(bad, F.col("d") == F.col("label_id")).select("url", "bad"))
    rows = url_rules.judge(pages, mined)
    return rows.select("_row.page_id", "host", "path", "rule", "verdict")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ngram_join.link(read(spark, sf_dir, "documents").select("doc_id", "text"), n=3, percent=90)
    return got.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontamination.report(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                  read(spark, sf_dir, "benchmark"))
    return rows.select("_row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated", "n_near")


def op11_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = language_id.held_out("doc_id", 7, 2)
    model = class_lm.fit(docs.where(~held))
    got = class_lm.score(docs, model)
    return got.select("doc_id", held.alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.words.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vector_codes.fit(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    rows = vector_codes.errors_by(materialize(vector_codes.encode(model), "vector-codes"))
    return rows.select("_row.vec_id", "code", "error", "label_error", F.lit(model.sha256).alias("codebooks_sha256"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.transform(read(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    text = fill_middle.restore(F.col("output"), F.col("form"))
    return rows.select("_row.doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(text.cast("binary"), 256).alias("restored_sha256"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_quality_rules, op3_license_scan, op4_quality_fm, op5_html_extract, op6_entropy_mix,
        op7_line_dedup, op8_url_rules, op9_ngram_join, op10_decontamination, op11_class_lm,
        op12_vector_codes, op13_fill_middle)
}


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


REGISTRY["pipeline"] = _pipeline

__all__ = ["ORACLE", "REGISTRY"]
