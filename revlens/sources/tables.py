"""Driver tables and the review-shaped views derived from them.

The driver's parquet tables are read with ``spark.read.parquet`` so that
Catalyst prunes columns and pushes filters into the scan. The views below turn
them into the shapes the review pipeline consumes (FIXTURES.md section 3); each
is a lazy DataFrame whose work grows with the underlying tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _props_k(props: Column) -> Column:
    # first run of digits in the JSON props string
    return F.regexp_extract(props, "([0-9]+)", 1).try_cast("int")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as raw reviews: review_key, review_text, rating."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    q, t = F.col("quality"), F.col("toxic")
    rating = (F.when((q == 1) & (t == 0), 5).when((q == 1) & (t == 1), 3)
              .when((q == 0) & (t == 0), 2).when((q == 0) & (t == 1), 1))
    return (d.join(lab, "doc_id", "left")
            .select(F.col("doc_id").alias("review_key"),
                    F.col("text").alias("review_text"),
                    rating.alias("rating")))


def dirty_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with nulls, blanks, punctuation-only text, HTML and bad ratings."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    i = F.col("doc_id")
    text = (F.when(i % 89 == 0, F.lit(None).cast("string"))
            .when(i % 83 == 0, F.lit("   "))
            .when(i % 71 == 0, F.lit("!!! ???"))
            .when(i % 5 == 0, F.concat(F.lit("<br />"), F.col("text"), F.lit(" <b>x</b>")))
            .otherwise(F.col("text")))
    rating = (F.when(i % 97 == 0, F.lit(None).cast("int"))
              .when(i % 79 == 0, F.lit(7))
              .otherwise((1 + i % 5).cast("int")))
    return d.select(i.alias("review_key"), text.alias("review_text"), rating.alias("rating"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns of conversations as prediction requests: request_id, text."""
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    k = F.col("conv_id") + F.col("turn")
    text = (F.when(k % 23 == 0, F.lit(None).cast("string"))
            .when(k % 19 == 0, F.lit("!!!???"))
            .when(k % 17 == 0, F.lit("<br /><br />"))
            .when(k % 13 == 0, F.repeat(F.col("text"), 200))
            .otherwise(F.col("text")))
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"),
                    text.alias("text"))


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a served-prediction log."""
    e = table(spark, sf_dir, "events")
    k = _props_k(F.col("props"))
    divisor = F.when(F.col("event_type").isin("view", "signup"), 500).otherwise(250)
    return e.select(
        F.col("event_id").alias("id"), "ts", F.col("event_type").alias("model"),
        F.when(k < 84, "positive").otherwise("negative").alias("label"),
        F.round(1 - F.least(F.col("value"), F.lit(125.0)) / divisor, 4).alias("confidence"),
        k.alias("word_count"), F.col("value").alias("latency_ms"))


def labelled_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored rows with known truth, tagged baseline / drifted."""
    e = table(spark, sf_dir, "events")
    k = _props_k(F.col("props"))
    cut = F.expr("TIMESTAMP_NTZ '2024-01-25 00:00:00'")
    return e.select(
        F.col("event_id").alias("id"),
        F.when(F.col("ts").cast("timestamp_ntz") < cut, "baseline")
        .otherwise("drifted").alias("batch"),
        F.col("event_type").alias("drift_type"),
        F.when(k < 84, 1).otherwise(0).alias("pred"),
        (F.col("user_id") % 2).cast("int").alias("truth"),
        F.when(k % 29 == 0, F.lit(None).cast("double"))
        .otherwise(F.round(1 - F.least(F.col("value"), F.lit(125.0)) / 250, 4))
        .alias("confidence"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models' P(negative) on the same rows, with the true label."""
    e = table(spark, sf_dir, "events")
    k = _props_k(F.col("props"))
    label = F.when(F.col("value") + k > 120, 0).otherwise(1)
    a = e.select(F.col("event_id").alias("id"), F.lit("a").alias("model"),
                 F.round(F.least(F.col("value"), F.lit(500.0)) / 500, 4).alias("prob_neg"),
                 label.alias("label"))
    b = e.select(F.col("event_id").alias("id"), F.lit("b").alias("model"),
                 (k / F.lit(100.0)).alias("prob_neg"), label.alias("label"))
    return a.unionByName(b)
