"""Order-insensitive dataset fingerprints.

content_hash = sum over rows of the first 60 bits of md5(canonical row text),
as DECIMAL(38,0), plus the row count. The canonical text of a row is the md5 of every
field ("-" for NULL) joined by commas, so neither NULLs nor separators inside a field
can make two different rows alike. A sum is independent of row order and
partitioning and aggregates map-side; equal fingerprints show a rerun produced
the same rows (the reference proves reproducibility by file md5). md5 is used
(rather than xxhash64) so an independent SQL engine computes the same value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def row_hash(cols: list[str]):
    fields = [F.coalesce(F.md5(F.col(c).cast("string")), F.lit("-")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(",", *fields)), 1, 15), 16, 10).cast("decimal(38,0)")


def content_hash(df: DataFrame, cols: list[str], group_cols: list[str] | None = None) -> DataFrame:
    """(group..., n_rows, content_hash) - one row per group (or one row)."""
    g = df.groupBy(*(group_cols or []))
    return g.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(row_hash(cols)).cast("decimal(38,0)").alias("content_hash"))


def file_bytes(df: DataFrame) -> DataFrame:
    """Total bytes of the files behind a file-based DataFrame (from metadata)."""
    return (df.select(F.col("_metadata.file_path").alias("path"),
                      F.col("_metadata.file_size").alias("size"))
            .distinct().agg(F.sum("size").alias("n_bytes"), F.count(F.lit(1)).alias("n_files")))
