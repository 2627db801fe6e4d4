"""Sources: S1 CSV ingest, S2/S3 pruned parquet reads, S4 JSON-lines log,
S5 manifest read, S14 cached score table, S15 split fallback."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.operators import quality as Q
from revlens.session import materialize

# ---------------------------------------------------------------------------
# Strings a CSV reader in the reference's stack treats as missing.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")
# ---------------------------------------------------------------------------

LOG_SCHEMA = ("id long, timestamp string, model string, text string, label string, "
              "confidence double, word_count int, latency_ms double, text_light_clean string")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _complete(spark: SparkSession, path: str) -> bool:
    """A table folder whose write was committed (its marker file is there)."""
    return _exists(spark, f"{path}/_SUCCESS")


def ingest_csv(spark: SparkSession, path: str, text_col: str, rating_col: str,
               key: str = "review_key") -> DataFrame:
    """CSV with header (quoted newlines, doubled quotes) to review_text, rating and
    an order key for keep-first dedup; NA tokens become NULL.

    The key orders rows by file name, then by position in the file: files are ranked by
    path, and within a task Spark's running id follows the file (a multi-line file is
    read by one task), so its low bits are the position. The CSV is parsed once: rows and running
    ids are written, and the files are ranked from that table."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"no CSV input at {path}")
    raw = (spark.read.option("header", True).option("multiLine", True)
           .option("escape", '"').option("quote", '"').csv(path))
    Q.require_columns(raw, (text_col, rating_col))

    def na(c):
        return F.when(F.col(c).isin(list(NA_TOKENS)), None).otherwise(F.col(c))

    out = raw.select(na(text_col).alias("review_text"),
                     na(rating_col).try_cast("double").alias("rating"),
                     F.col("_metadata.file_path").alias("_file"),
                     F.monotonically_increasing_id().alias("_at"))
    out = materialize(out, "csv-rows")
    # one row per file, written, so that its real size decides about a broadcast
    files = out.groupBy("_file").agg(F.min("_at").alias("_start"))
    ranked = materialize(files.withColumn("_no", F.row_number().over(Window.orderBy("_file")) - 1), "csv-files")
    both = out.join(ranked.withColumnRenamed("_file", "_f"), F.col("_file") == F.col("_f"))
    place = F.col("_no").cast("long") * F.lit(1 << 40) + (F.col("_at") - F.col("_start"))
    return both.select("review_text", "rating", place.alias(key))


def read_columns(spark: SparkSession, path: str, cols: list[str], required: list[str] | None = None) -> DataFrame:
    """Column subset of a parquet table (pruned in the scan), NULLs in
    ``required`` dropped."""
    df = spark.read.parquet(path).select(*cols)
    return df.dropna(subset=required) if required else df


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The JSON-lines prediction log; a missing log is an error."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"prediction log {path} does not exist")
    df = spark.read.schema(LOG_SCHEMA).json(path)
    # ISO-8601 with offset -> an instant (id is optional: NULL when not logged)
    return df.withColumn("ts", F.to_timestamp("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The store manifest (one JSON document) as a dict."""
    row = spark.read.option("multiLine", True).json(path).first()
    return row.asDict(recursive=True)


def cached_scores(spark: SparkSession, folder: str, config: dict, compute) -> DataFrame:
    """The score table of ``config`` (any JSON-able settings, the input's fingerprint among
    them; its hash names the folder). A complete one is reused, by any session that sees the
    folder; else it is computed, written aside and moved into place when the write is
    committed, so a reader never finds half a table and of two writers the first wins."""
    digest = hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:24]
    path = f"{folder.rstrip('/')}/scores-{digest}"
    if not _complete(spark, path):
        aside = f"{folder.rstrip('/')}/writing-{digest}-{uuid.uuid4().hex}"
        compute().write.parquet(aside)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        src, dst = hadoop.Path(aside), hadoop.Path(path)
        fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if _exists(spark, path) and not _complete(spark, path):
            fs.delete(dst, True)             # left by a write that never finished
        if _complete(spark, path) or not fs.rename(src, dst):
            fs.delete(src, True)
    return spark.read.parquet(path)


def split_with_fallback(spark: SparkSession, store_path: str, recompute) -> DataFrame:
    """Copy (review_id, split) from a complete store, else recompute."""
    if _complete(spark, store_path):
        return spark.read.parquet(store_path).select("review_id", "split")
    return recompute()


def labelled_rows(spark: SparkSession, rows, batch: str = "inline") -> DataFrame:
    """(text, truth) pairs as a labelled batch (id, text, truth, batch): either
    caller-supplied Python pairs or a DataFrame (id, text, truth)."""
    if isinstance(rows, DataFrame):
        df = rows.select(F.col("id").cast("long").alias("id"), "text", F.col("truth").cast("int").alias("truth"))
    else:
        df = spark.createDataFrame([(i, t, int(y)) for i, (t, y) in enumerate(rows)],
                                   "id long, text string, truth int")
    return df.withColumn("batch", F.lit(batch))
