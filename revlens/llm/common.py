"""Shared pieces of the training-data operators: word rules, packing, components.

Nothing here keeps rows on the driver; the only values that reach it are single
counters (row counts, convergence sums) or objects of a stated fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import arrow_rows, drop_written, materialize  # noqa: F401 (arrow_rows: for the operators)

# Fixed values of the word rules (Java and RE2 spelling are the same).
SPACES = r"[\x20\x09-\x0D]+"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: rows and bytes on disk up to which a written side table may be broadcast; beyond
#: either the same join shuffles
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only; every other character stays. ``lower`` does the same, and faster, on
    texts without an upper- or title-case character outside A-Z (nor one that the regex
    engine's Unicode tables don't know yet)."""
    other = text.rlike(r"[\p{IsUppercase}\p{Lt}\p{Cn}&&[^A-Z]]")
    return F.when(other, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words(text: Column, separators: str = SPACES) -> Column:
    """Array of words between the separators; empty for a null text."""
    return F.coalesce(F.array_remove(F.split(text, separators), F.lit("")),
                      F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it in ``body`` (a lambda binding),
    so that an expression used inside a higher-order function isn't repeated."""
    return F.transform(F.array(value), body).getItem(0)


def packed(df: DataFrame, name: str = "_row") -> DataFrame:
    """The whole input row as one struct, so that added columns can't clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def hash_share(h: Column, rows: Column | int, wanted: int) -> Column:
    """True for the rows whose hash ``h`` is in the lowest part that holds ``wanted`` of
    ``rows`` rows (generously: 8 standard deviations more, all rows if there are few),
    so that picking the smallest hashes touches about ``wanted`` rows, not all."""
    part = F.pmod(h, F.lit(1 << 31)) / float(1 << 31)
    return part * rows < wanted + 8 * wanted ** 0.5 + 16


def written_bytes(df: DataFrame) -> int:
    """Size of the files a frame over written tables reads."""
    spark = df.sparkSession
    conf, total = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for name in df.inputFiles():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast hint for a *written* table of at most BROADCAST_ROWS rows and
    BROADCAST_BYTES bytes; beyond that the frame is returned as it is and the join shuffles."""
    if written_bytes(df) > BROADCAST_BYTES:
        return df
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


#: bits of the membership table (2^23: 131,072 rows whatever the number of keys)
MEMBER_BITS = 23


def membership(keys: DataFrame, key: str) -> DataFrame:
    """A bit table of the keys' hashes: of fixed size, so it can always be broadcast.
    A set bit says "maybe"; beyond its capacity it only says so too often."""
    bit = F.pmod(F.xxhash64(key), F.lit(1 << MEMBER_BITS))
    rows = keys.select(bit.alias("bit")).selectExpr("bit div 64 AS slot", "shiftleft(1L, cast(bit % 64 AS int)) AS b")
    return materialize(rows.groupBy("slot").agg(F.bit_or("b").alias("bits")), "members")


def maybe_member(df: DataFrame, key: str, members: DataFrame, out: str = "_maybe") -> DataFrame:
    """``df`` plus a flag that is true for every row whose key is in the table (and for a
    few others), so that wide rows can be dropped or set aside before a shuffle."""
    tagged = df.withColumn("_bit", F.pmod(F.xxhash64(key), F.lit(1 << MEMBER_BITS)))
    both = tagged.join(F.broadcast(members), F.expr("_bit div 64 = slot"), "left")
    hit = F.expr("coalesce((bits & shiftleft(1L, cast(_bit % 64 AS int))) != 0, false)")
    return both.withColumn(out, hit).drop("_bit", "slot", "bits")


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of the nodes of ``links`` (a, b: long), component = smallest
    node id reachable. Alternating large-star / small-star steps: every step is a group
    minimum (combined on the map side), written, and a join of the edges with that table: it is
    broadcast while it is small; beyond that both sides of the join are plain shuffles, so
    adaptive execution splits the edges of a hub among tasks. No group is gathered in one
    place, and each round is written under the checkpoint folder."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                                     F.least("a", "b").alias("v")).distinct(), name)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name + "-low")
        # a hub that is the least of its neighbours keeps its edges: they need no join
        large = (edges.join(first.where("m < u"), edges["v"] == first["u"], "left")
                 .select(edges["u"], F.coalesce("m", edges["v"]).alias("v")).where("u <> v").distinct())
        large = materialize(large, name + "-large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), name + "-low")
        small = large.join(low, "u")
        step = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        before, edges = edges, materialize(step, name)
        for table in (before, first, large, low):
            drop_written(table)
        mark = edges.agg(F.count(F.lit(1)).alias("n"),
                         F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))
