"""Line dedup by site-relative frequency.

For every host the share of its pages that hold a line is measured; lines above the
boilerplate ratio are dropped from all pages of that host. A page is a *different
text* of the host, so copies of one page count once and don't turn their own content
into boilerplate.

Built-in functions only. Counting works on 64-bit line hashes, deduplicated per page
inside its row; (host, line) counts combine on the map side, so a host with a third
of all rows or a line on every page is no hot task. A host has at most (lines per
page) / ratio boilerplate lines, which travel to its pages as one array.

Defined cases: lines are split at \\n and compared exactly; lines without a word are
neither counted nor dropped; a null host has no site and nothing is dropped; hosts
with fewer than ``min_pages`` different pages give no verdict; null texts stay null;
dropping every line leaves an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import let, packed
from revlens.session import materialize

RATIO = 0.10
MIN_PAGES = 10


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines, n_pages): hashes of the lines on more than ``ratio`` of the pages."""
    lines = F.array_distinct(F.transform(
        F.filter(F.split(F.col("t"), "\n"), _has_word), lambda x: F.xxhash64(x)))
    pages = (docs.select(F.col(host).alias("host"), F.col(text).alias("t"))
             .where("host is not null and t is not null")
             .select("host", F.xxhash64("t").alias("page"), lines.alias("lines"))
             .dropDuplicates(["host", "page"]))
    pages = materialize(pages, "page-lines")
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    counts = (pages.select("host", F.explode("lines").alias("line"))
              .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")))
    # a line must be on more than ratio * min_pages pages of any host that counts
    often = counts.where(F.col("n") > ratio * min_pages).join(totals, "host")
    return (often.where((F.col("n_pages") >= min_pages) & (F.col("n") > ratio * F.col("n_pages")))
            .groupBy("host").agg(F.collect_list("line").alias("lines"), F.max("n_pages").alias("n_pages")))


def strip(docs: DataFrame, found: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """(_row, text, n_lines, n_dropped): the cleaned text beside the input row."""
    found = materialize(found, "boilerplate")
    rows = packed(docs).withColumn("_h", F.col("_row")[host])
    both = rows.join(found.select(F.col("host").alias("_h"), F.col("lines").alias("_b")), "_h", "left")
    split = F.split(F.col("_row")[text], "\n")

    def keep(ls):
        kept = F.filter(ls, lambda x: ~(_has_word(x) & F.array_contains("_b", F.xxhash64(x))))
        return let(kept, lambda k: F.struct(F.array_join(k, "\n").alias("text"),
                                            F.size(ls).cast("long").alias("n_lines"),
                                            (F.size(ls) - F.size(k)).cast("long").alias("n_dropped")))

    whole = F.struct(F.col("_row")[text].alias("text"),
                     F.coalesce(F.size(split).cast("long"), F.lit(0).cast("long")).alias("n_lines"),
                     F.lit(0).cast("long").alias("n_dropped"))
    got = F.when(F.col("_b").isNull() | F.col("_row")[text].isNull(), whole).otherwise(let(split, keep))
    out = both.select("_row", got.alias("_o"))
    return out.select("_row", "_o.text", F.greatest("_o.n_lines", F.lit(0).cast("long")).alias("n_lines"),
                      "_o.n_dropped")


def dedup_lines(docs: DataFrame, host: str = "source", text: str = "text",
                ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    return strip(docs, boilerplate(docs, host, text, ratio, min_pages), host, text)
