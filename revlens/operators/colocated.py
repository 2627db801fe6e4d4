"""Co-located stage tables: ids, split and features bucketed by row id, so that J1, J3 and
every later join on the id read matching buckets side by side and shuffle nothing.

A plain written table loses its partitioning; a bucketed one keeps it in the catalog. All
tables of a store use the same number of buckets (a parameter: about one per 128 MB of the
widest table). Rows are dealt to their bucket before the write, so a bucket is one file.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame

from revlens import session

BUCKETS = 8


def write_bucketed(df: DataFrame, name: str, key: str = "review_id", buckets: int = BUCKETS) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``key`` under the checkpoint folder, read back."""
    spark = df.sparkSession
    token = uuid.uuid4().hex
    path = session.scratch_path(spark, f"{name}-{token}")
    table = f"revlens_{name.replace('-', '_')}_{token}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
     .option("path", path).saveAsTable(table))
    session._WRITTEN.append((spark, path))
    return spark.table(table)


def join_all(tables: list[DataFrame], key: str = "review_id") -> DataFrame:
    """Inner join of bucketed tables on their key."""
    return functools.reduce(lambda a, b: a.join(b, key), tables)
