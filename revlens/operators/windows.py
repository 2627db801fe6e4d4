"""Ordered row numbering and running totals that never funnel a whole group
through one task, by one path at every size.

A plain ``row_number().over(Window.partitionBy(label).orderBy(x))`` sends every
row of a label to one reducer; with a binary label that is half the table in a
single task. Instead the rows are range-partitioned by (group, order):

1. ``repartitionByRange(group, order)`` and write the rows with their partition
   number (narrow rows: callers pass ids and keys, not texts);
2. count rows (or sum values) per (partition, group): about one row per
   partition plus one per group, turned into offsets by a window over that table;
3. number rows (or add up) inside each (partition, group) and add the offset.

Partitions are sized by Spark (adaptive execution joins small ones), so the same
plan serves ten rows and ten billion; a hot group spreads over many partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import materialize

PART = "_range_part"


def _ranged(df: DataFrame, group_cols: list[str], order_cols: list[Column]) -> DataFrame:
    # the number is fixed by the write: every later step sees the same partitions
    by = [F.col(c) for c in group_cols] + order_cols
    return materialize(df.repartitionByRange(*by).withColumn(PART, F.spark_partition_id()), "ranged")


def _with_offsets(ranged: DataFrame, group_cols: list[str], value_cols: dict[str, Column]) -> DataFrame:
    """``ranged`` plus ``_off_<name>``: totals of the group's earlier partitions."""
    sums = ranged.groupBy(PART, *group_cols).agg(*[e.alias(n) for n, e in value_cols.items()])
    before = Window.partitionBy(*group_cols).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    keys = [PART, *group_cols]
    offs = sums.select(*[F.col(c).alias(f"_key_{i}") for i, c in enumerate(keys)],
                       *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_off_{n}") for n in value_cols])
    cond = F.lit(True)
    for i, c in enumerate(keys):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_key_{i}"))
    return ranged.join(offs, cond).drop(*[f"_key_{i}" for i in range(len(keys))])


def row_numbers(df: DataFrame, group_cols: list[str], order_cols: list[Column],
                out: str = "rank") -> DataFrame:
    """1-based row number within ``group_cols`` by ``order_cols`` (must make a total order)."""
    tagged = _with_offsets(_ranged(df, group_cols, order_cols), group_cols, {"n": F.count(F.lit(1))})
    inside = Window.partitionBy(PART, *group_cols).orderBy(*order_cols)
    return (tagged.withColumn(out, F.col("_off_n") + F.row_number().over(inside))
            .drop(PART, "_off_n"))


def running_sums(df: DataFrame, group_cols: list[str], order_cols: list[Column],
                 value_cols: list[str], suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``value_cols`` within ``group_cols`` along
    ``order_cols`` (a total order over the rows of ``df``)."""
    tagged = _with_offsets(_ranged(df, group_cols, order_cols), group_cols,
                           {v: F.sum(v) for v in value_cols})
    inside = (Window.partitionBy(PART, *group_cols).orderBy(*order_cols)
              .rowsBetween(Window.unboundedPreceding, 0))
    return tagged.select(*df.columns, *[(F.col(f"_off_{v}") + F.sum(v).over(inside)).alias(v + suffix)
                                        for v in value_cols])


def numbered(df: DataFrame, key: str, out: str = "review_id") -> DataFrame:
    """``df`` (narrow: key and what must travel with it) plus ids 0..n-1 in ``key`` order."""
    return row_numbers(df, [], [F.col(key)], out="_rn").withColumn(out, (F.col("_rn") - 1).cast("bigint")).drop("_rn")


def dense_ids(df: DataFrame, key: str, out: str = "review_id") -> DataFrame:
    """Ids 0..n-1 in ``key`` order (``key`` unique): (key, id) is made on the key
    alone and joined back once, so no wide column is ranged or sorted."""
    ids = numbered(df.select(key), key, out).withColumnRenamed(key, "_id_key")
    return df.join(ids, df[key] == ids["_id_key"]).drop("_id_key")
