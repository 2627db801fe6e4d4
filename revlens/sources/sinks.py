"""Sinks: S6 cleaned table, S7 parquet, S8 JSON report / manifest, S9 log append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_cleaned(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The cleaned table (parquet by default; CSV with a header on request)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        # RFC 4180 quoting; keep surrounding whitespace (Spark trims it by default)
        (w.option("header", True).option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
    else:
        w.parquet(path)


def write_json_one(df: DataFrame, path: str) -> None:
    """A one-row report / manifest as a single JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_log(log: DataFrame, path: str, mode: str = "append") -> None:
    """Prediction rows as JSON lines with an ISO-8601 UTC timestamp
    (``mode="overwrite"`` for a per-batch folder that a retry may rewrite)."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
    if log.schema["ts"].dataType.typeName() == "timestamp_ntz":
        utc = F.col("ts")                                  # already UTC wall-clock time
    else:
        utc = F.to_utc_timestamp(F.col("ts"), F.current_timezone())
    out = log.withColumn("timestamp", F.date_format(utc, fmt))
    out.drop("ts").write.mode(mode).json(path)
