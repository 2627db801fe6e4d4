"""N-gram Jaccard join: all links of similar documents, as connected groups.

Documents are sets of word shingles (64-bit hashes). Shingles are ordered rare first
by a frequency table over the whole corpus, and each document offers only its prefix:
the shingles of which two similar documents must share at least one. The table counts
hash slots; it has about as many as there are documents, within bounds (TABLE_BITS): a
slot's count is the shingle's own plus the average load of a slot, so frequent shingles
stand out at any size, while the order among shingles rarer than that load's spread (its
square root) is arbitrary and their candidate lists may be that long.

1. Documents with the same set collapse into one class (128-bit set digest).
2. Round one pairs every class with a few centres per prefix shingle and verifies:
   this joins large groups of near copies with links in proportion to their size.
3. Round two lists the remaining candidates: pairs of classes that share a prefix
   shingle and are still in different groups. Together the rounds test every
   candidate pair that could add a link between groups, so no group is missed.

In the join a candidate passes the length filter, the positional filter and the suffix
filter: both sets are split by hash into SIGNATURE_BITS parts, and parts of different
parity differ in one shingle at least, so the number of such parts bounds the
difference of the sets from below (family members that are just too different end
there, as numbers beside each other, without a row or a text). Verification takes the
exact overlap from the texts, once per distinct pair. The frequency table and the
choice of centres decide speed only: any order gives the same groups.

Defined cases: a document with fewer words than a shingle is one shingle (all its
words); without words or text it has an empty set and links with nothing; rows are
grouped by their texts, also those that share an id; a null id never names a group
unless all its ids are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import SPACES, arrow_rows, ascii_lower, connected_components, maybe_member, membership, words
from revlens.session import drop_written, materialize

#: bounds of the frequency table's size (2^18 to 2^22 longs: 2 to 32 MB)
TABLE_BITS = (18, 22)
SIGNATURE_BITS = 256
SIGNATURE = ("s0", "s1", "s2", "s3")
#: round one: centres per prefix shingle
CENTRES = 8
#: documents (or pairs) whose shingle lists are in a Python worker at a time
BATCH = 500


def shingles(text: Column, n: int) -> Column:
    """Hashes of the word n-grams, repeats included; one hash of all words if fewer."""
    def grams(w):
        return F.when(F.size(w) >= n, F.transform(
            F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[w[i + k] for k in range(n)]))
        ).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    return F.transform(F.array(words(ascii_lower(text), SPACES)), grams).getItem(0)


def _lists(column) -> Iterator[np.ndarray]:
    """Distinct sorted values of each list of an Arrow list column."""
    values = column.values.to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:]):
        yield np.unique(values[a:b])


def _slot(values: np.ndarray, size: int) -> np.ndarray:
    """Slots of the hashes in a table of ``size`` (a power of two)."""
    return (values.view(np.uint64) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def frequency_table(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """Documents per hash slot. A task adds its own documents up first; what reaches
    the driver is the table of bounded size."""
    size = 1 << min(max(docs.count().bit_length(), TABLE_BITS[0]), TABLE_BITS[1])

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for values in _lists(batch.column(0)):
                np.add.at(total, _slot(values, size), 1)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["slot", "n"])

    found = (docs.select(shingles(F.col(text), n).alias("g")).mapInArrow(count, "slot long, n long")
             .groupBy("slot").agg(F.sum("n").alias("n")))
    got = found.toArrow()
    out = np.zeros(size, np.int64)
    out[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    return out


def need(a, b, percent: int):
    """Smallest overlap of two sets of sizes a, b with 100 * overlap >= percent * union."""
    return -((-percent * (a + b)) // (100 + percent))


def prefixes(docs: DataFrame, table: np.ndarray, text: str, key: str, n: int, percent: int) -> DataFrame:
    """(doc, row, n, set, s0..s3, prefix): id, hash of id and text, set size, set digest,
    parity signature and rarest shingles (in order) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def build(batches):
        freq = shared.value
        for batch in batches:
            sizes, digests, heads = [], [], []
            parity = np.zeros((len(batch), SIGNATURE_BITS), np.uint8)
            for at, values in enumerate(_lists(batch.column(1))):
                m = len(values)
                sizes.append(m)
                parity[at] = np.bincount(values & (SIGNATURE_BITS - 1), minlength=SIGNATURE_BITS) & 1
                if not m:
                    digests.append(None)
                    heads.append(None)
                    continue
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                keep = m - -(-percent * m // 100) + 1
                order = np.argsort(freq[_slot(values, len(freq))], kind="stable")[:keep]
                heads.append(values[order])
            bits = np.packbits(parity, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 *[pa.array(np.ascontiguousarray(bits[:, k])) for k in range(len(SIGNATURE))],
                 pa.array(heads, pa.list_(pa.int64()))], names=["doc", "row", "n", "set", *SIGNATURE, "prefix"])

    return docs.select(F.col(key).cast("long").alias("doc"), shingles(F.col(text), n).alias("g"),
                       _row_hash(key, text).alias("row")) \
        .mapInArrow(build, "doc long, row long, n long, set binary, "
                    + "".join(f"{c} long, " for c in SIGNATURE) + "prefix array<long>")


def _row_hash(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key).cast("long"), F.col(text))


def _passes(percent: int) -> Column:
    """Length, positional and suffix filters on the sides a and b of one shared shingle."""
    na, nb, ia, ib = (F.col(c) for c in ("a.n", "b.n", "a.i", "b.i"))
    short, long_ = F.least(na, nb), F.greatest(na, nb)
    overlap = F.least(na - ia, nb - ib)   # the shared shingle and what may follow it
    least = F.expr(f"({percent} * (a.n + b.n) + {99 + percent}) div {100 + percent}")
    apart = F.lit(0)
    for c in SIGNATURE:
        apart = apart + F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}")))
    return (100 * short >= percent * long_) & (overlap >= least) & (apart <= na + nb - 2 * least)


def verify(pairs: DataFrame, docs: DataFrame, text: str, key: str, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, each computed once, as a written table. Only
    texts of candidate documents are kept, one row per id and text, until it is written."""
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "pair-ids")
    texts = docs.select(_row_hash(key, text).alias("row"), F.col(text).alias("t"))
    # a fixed-size bit table drops nearly all other texts before the shuffle
    texts = maybe_member(texts, "row", membership(ids, "row")).where("_maybe").select("row", "t") \
        .join(ids, "row", "left_semi")
    texts = materialize(texts.groupBy("row").agg(F.first("t").alias("t")), "pair-texts")
    both = (pairs.join(texts.select(F.col("row").alias("a"), F.col("t").alias("ta")), "a")
            .join(texts.select(F.col("row").alias("b"), F.col("t").alias("tb")), "b"))

    def compare(batches):
        for batch in batches:
            ok = []
            for x, y in zip(_lists(batch.column(2)), _lists(batch.column(3))):
                least = need(len(x), len(y), percent)
                ok.append(len(np.intersect1d(x, y, assume_unique=True)) >= least)
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    links = materialize(both.select("a", "b", shingles(F.col("ta"), n).alias("x"), shingles(F.col("tb"), n).alias("y"))
                        .mapInArrow(compare, "a long, b long"), "links")
    drop_written(ids)
    drop_written(texts)
    return links


def _pairs(left: DataFrame, right: DataFrame, percent: int, more: Column | None = None) -> DataFrame:
    cond = _passes(percent) & (F.col("a.row") != F.col("b.row"))
    if more is not None:
        cond = cond & more
    joined = left.alias("a").join(right.alias("b"), (F.col("a.token") == F.col("b.token")) & cond)
    return joined.select(F.least("a.row", "b.row").alias("a"),
                         F.greatest("a.row", "b.row").alias("b")).distinct()


def link(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = 5,
         percent: int = 80) -> DataFrame:
    """(doc, n_shingles, component, row, group) of every row; documents whose shingle sets have
    100 * overlap >= percent * union are linked, component = smallest id of the group; row is
    the hash of id and text, group the smallest one of a group's (null without a shingle)."""
    with arrow_rows(docs.sparkSession, BATCH):       # every step with Python is executed in here
        return _link(docs, text, key, n, percent)


def _link(docs: DataFrame, text: str, key: str, n: int, percent: int) -> DataFrame:
    wide = materialize(prefixes(docs, frequency_table(docs, text, n), text, key, n, percent), "sets")
    base = materialize(wide.select("doc", "row", "n", "set"), "set-names")
    # a class is all rows with one set; the smallest row hash stands for it
    classes = materialize(wide.where("n > 0").groupBy("set").agg(
        F.min("row").alias("row"), F.min("doc").alias("rep"), F.first("n").alias("n"),
        *[F.first(c).alias(c) for c in SIGNATURE], F.first("prefix").alias("prefix")), "classes")
    drop_written(wide)     # the prefixes live on in the classes
    post = classes.select("row", F.posexplode("prefix").alias("i", "token"))
    # the rank limit is applied in every task before the shuffle, so a hot shingle sends a few rows
    by_hash = Window.partitionBy("token").orderBy(F.xxhash64("row", "token"), "row")
    ranked = post.withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= CENTRES)
    # shingles of one class only, nearly all of them, aren't written
    centres = materialize(ranked.withColumn("of", F.max("k").over(Window.partitionBy("token")))
                          .where("of > 1").drop("of"), "centres")
    common = centres.where("k = 2").select("token")
    details = classes.select("row", "n", *SIGNATURE)
    shared = materialize(post.join(common, "token", "left_semi").join(details, "row"), "postings")
    middle = materialize(centres.drop("k").join(details, "row"), "centres")
    drop_written(centres)

    first = materialize(_pairs(shared, middle, percent), "pairs")
    drop_written(middle)
    links = verify(first, docs, text, key, n, percent)
    comp = materialize(connected_components(links), "groups")

    grouped = materialize(shared.join(comp, shared["row"] == comp["node"], "left").select(
        *shared.columns, F.coalesce("component", "row").alias("comp")), "grouped")
    drop_written(shared)
    counts = grouped.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = counts.groupBy("token").agg(F.max(F.struct("k", "comp"))["comp"].alias("main"),
                                        F.count(F.lit(1)).alias("groups")).where("groups > 1")
    rest = materialize(grouped.join(mixed.select("token", "main"), "token"), "rest")
    drop_written(grouped)
    # one side: classes outside the token's main group; a pair of two such classes once
    across = (F.col("a.comp") != F.col("b.comp")) & (
        (F.col("b.comp") == F.col("b.main")) | (F.col("a.row") < F.col("b.row")))
    second = _pairs(rest.where("comp <> main"), rest, percent, across).join(first, ["a", "b"], "left_anti")
    second = materialize(second, "pairs")
    drop_written(rest)
    more = verify(second, docs, text, key, n, percent)
    comp = connected_components(links.unionByName(more))

    nodes = classes.select("set", "row", "rep").join(
        comp, F.col("row") == F.col("node"), "left").select(
        "set", "rep", F.coalesce("component", "row").alias("component"))
    nodes = materialize(nodes, "class-groups")
    smallest = nodes.groupBy("component").agg(F.min("rep").alias("smallest"))
    named = materialize(nodes.join(smallest, "component").select(
        "set", "smallest", F.col("component").alias("group")), "class-names")
    return (base.join(named, "set", "left")
            .select("doc", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc").alias("component"),
                    "row", "group"))
