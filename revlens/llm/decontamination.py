"""Benchmark decontamination with a distributed positional inverted index.

1. ``document_frequency``: how often every benchmark term occurs in the corpus.
2. ``rare_terms``: each window of an item is represented by its rarest terms. A
   window with a term that never occurs can't match and needs none.
3. ``postings``: (doc, term, position) of those terms, written as a table: the index.
4. ``intersect``: positions minus item offsets give alignments (doc, item, shift);
   an alignment survives when the lists of all rare terms of a window meet in it.
5. ``phrase_hits``: survivors are compared word by word with the document's own
   words (exact).
6. ``proximity_hits``: windows whose rarest terms all stand within SLOP words of a document, in
   any order, found by one sort of the index by document and position.

Built-in functions only. Term and position lists are keyed by (doc, item, shift), so
a passage found in a third of all documents is spread like its documents; side tables
from the benchmark are broadcast only after their rows were counted, else shuffled.

Defined cases: null text has no word (nothing hit, not contaminated); items without
words are ignored; an item under 13 words is one window; items with equal id are
listed once, a null item id is listed as the empty string; documents with equal or
null ids are judged row by row, but for proximity: there rows of one id are one document, and
rows without an id are not searched (no match).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import NON_WORD, ascii_lower, let, maybe_member, membership, packed, small_side, words
from revlens.session import materialize

WINDOW = 13
RARE = 3
SLOP = 20


def match_words(text: Column) -> Column:
    return words(ascii_lower(text), NON_WORD)


def benchmark_items(benchmark: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    """(item, item_id, words, hashes), one row per different (id, words), written."""
    rows = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item_id"),
                            match_words(F.col(text)).alias("words")).where(F.size("words") > 0).distinct()
    return materialize(rows.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words",
                                   F.transform("words", lambda w: F.xxhash64(w)).alias("hashes")),
                       "bench-items")


def _tokens(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc"), F.posexplode(
        F.transform(match_words(F.col(text)), lambda w: F.xxhash64(w))).alias("pos", "term"))


def document_frequency(docs: DataFrame, items: DataFrame, text: str = "text",
                       key: str = "doc_id") -> DataFrame:
    """(term, df): occurrences in the corpus of every term of the items."""
    terms = materialize(items.select(F.explode("hashes").alias("term")).distinct(), "bench-terms")
    found = (_tokens(docs, text, key).select("term").join(small_side(terms), "term")
             .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    return materialize(found, "bench-df")


def rare_terms(items: DataFrame, df: DataFrame, window: int = WINDOW, k: int = RARE) -> DataFrame:
    """(item, start, offset, term): the ``k`` rarest terms of every window that can occur."""
    size = F.size("hashes")
    spans = items.select("item", "hashes", F.least(F.lit(window), size).alias("len"), F.explode(
        F.sequence(F.lit(0), F.greatest(size - window, F.lit(0)))).alias("start"))
    terms = spans.select("item", "start", "len", F.posexplode(
        F.slice("hashes", F.col("start") + 1, F.col("len"))).alias("at", "term"))
    known = terms.join(df, "term")
    span = Window.partitionBy("item", "start")
    # one slot per different term: a repeated word adds nothing to an intersection
    one = (known.groupBy("item", "start", "len", "term", "df")
           .agg(F.count(F.lit(1)).alias("times"), F.min("at").alias("at")))
    return (one.withColumn("present", F.sum("times").over(span))
            .where(F.col("present") == F.col("len"))
            .withColumn("rank", F.row_number().over(span.orderBy("df", "at")))
            .where(F.col("rank") <= k)
            .select("item", "start", (F.col("start") + F.col("at")).alias("offset"), "term"))


def postings(docs: DataFrame, rare: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The written index: (doc, pos, term) of the terms in ``rare``."""
    terms = materialize(rare.select("term").distinct(), "rare-terms")
    return materialize(_tokens(docs, text, key).join(small_side(terms), "term"), "postings")


def intersect(index: DataFrame, rare: DataFrame) -> DataFrame:
    """(doc, item, shift) where all rare terms of at least one window meet; shift is
    the position of the item's first word in the document (may be negative)."""
    slots = materialize(rare.select("term", "item", "offset").distinct(), "slots")
    spans = materialize(rare.groupBy("item", "start").agg(F.sort_array(F.collect_set("offset")).alias("s"))
                        .groupBy("item").agg(F.collect_set("s").alias("spans")), "spans")
    aligned = (index.join(small_side(slots), "term")
               .groupBy("doc", "item", (F.col("pos") - F.col("offset")).alias("shift"))
               .agg(F.collect_set("offset").alias("got")))
    whole = F.exists("spans", lambda s: F.size(F.array_except(s, F.col("got"))) == 0)
    return aligned.join(small_side(spans), "item").where(whole).select("doc", "item", "shift")


def proximity_hits(index: DataFrame, rare: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc, item, first, last): spans of fewer than ``slop`` words that hold all rare terms of one of the
    item's windows, in any order; one row per end of such a span, with its latest beginning.

    Windows with the same rare terms are one set. Positions are kept only where as many different
    terms stand around them as the smallest set of their term needs; what is left meets the
    sets, and a running maximum per term gives the latest place of each before every position."""
    sets = rare.groupBy("item", "start").agg(F.array_sort(F.collect_set("term")).alias("terms")) \
        .select("item", "terms").distinct()
    sets = materialize(sets.select("item", F.xxhash64("terms").alias("set"), F.size("terms").alias("size"),
                                   F.posexplode("terms").alias("k", "term")), "near-sets")
    need = materialize(sets.groupBy("term").agg(F.min("size").alias("need")), "near-needs")
    around = Window.partitionBy("doc").orderBy("pos").rangeBetween(-(slop - 1), slop - 1)
    dense = (index.where("doc is not null").select("doc", "pos", "term").join(small_side(need), "term")
             .withColumn("around", F.size(F.collect_set("term").over(around))).where("around >= need"))
    most = sets.agg(F.max("size")).first()[0] or 0
    at = materialize(dense.select("doc", "pos", "term"), "near-places").join(small_side(sets), "term")
    before = Window.partitionBy("doc", "item", "set").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    last = [F.when(F.col("size") > j, F.max(F.when(F.col("k") == j, F.col("pos"))).over(before)).otherwise(F.col("pos"))
            for j in range(most)]
    whole, first = F.lit(most > 0), F.col("pos")
    for seen in last:
        whole, first = whole & seen.isNotNull(), F.least(first, seen)
    spans = at.select("doc", "item", F.col("pos").alias("last"), F.when(whole, first).alias("first"))
    return spans.where(F.col("last") - F.col("first") < slop).select("doc", "item", "first", "last").distinct()


def _found(ws: Column, item: Column, shift: Column, window: int) -> Column:
    """Start offsets in the item of windows that stand at ``shift`` in the document."""
    same = F.transform(item, lambda w, o: (shift + o >= 0) & (shift + o < F.size(ws))
                       & (w == F.when((shift + o >= 0) & (shift + o < F.size(ws)), ws[shift + o])))
    size = F.least(F.lit(window), F.size(item))
    return let(same, lambda flags: F.filter(
        F.sequence(F.lit(0), F.size(item) - size),
        lambda s: F.forall(F.slice(flags, s + 1, size), lambda x: F.coalesce(x, F.lit(False)))))


def phrase_hits(docs: DataFrame, survivors: DataFrame, items: DataFrame, text: str = "text",
                key: str = "doc_id", window: int = WINDOW, near: DataFrame | None = None) -> DataFrame:
    """Every input row (struct ``_row``) with n_words, hits (array of item, first and
    end word position of each occurring window), checked against the row's own words, and n_near
    (items that ``near``, the proximity matches, has for its id)."""
    # places by item first: an item's words stand once beside them, however often it may occur
    places = survivors.groupBy("doc", "item").agg(F.collect_set("shift").alias("shifts"))
    cands = materialize(
        places.join(small_side(items.select("item", "item_id", "words")), "item")
        .groupBy("doc").agg(F.collect_list(F.struct("item_id", "words", "shifts")).alias("_c")), "candidates")
    if near is None:
        cands = cands.withColumn("_n", F.lit(0).cast("long"))
    else:
        of_doc = near.join(small_side(items.select("item", "item_id")), "item").groupBy(F.col("doc").alias("_nd")).agg(
            F.countDistinct("item_id").alias("_n"))
        cands = materialize(cands.join(of_doc, F.col("doc") == F.col("_nd"), "full_outer").select(
            F.coalesce("doc", "_nd").alias("doc"), "_c", F.coalesce("_n", F.lit(0).cast("long")).alias("_n")), "candidates")
    # most documents have no candidate: they are set aside by a fixed-size bit table
    # and only the others' texts travel to their candidates
    rows = maybe_member(packed(docs).withColumn("doc", F.col("_row")[key]), "doc", membership(cands, "doc"))
    rest = rows.where(~F.col("_maybe")).select("_row", F.size(match_words(F.col("_row")[text])).cast("long").alias("n_words"))
    both = rows.where("_maybe").join(cands.withColumnRenamed("doc", "_d"), F.col("doc").eqNullSafe(F.col("_d")), "left")
    both = both.select("_row", "_c", F.coalesce("_n", F.lit(0).cast("long")).alias("_n"), match_words(F.col("_row")[text]).alias("_w"))
    spans = F.flatten(F.transform("_c", lambda c: F.flatten(F.transform(c["shifts"], lambda shift: F.transform(
        _found(F.col("_w"), c["words"], shift, window),
        lambda s: F.struct(c["item_id"].alias("item_id"), (shift + s).alias("first"),
                           (shift + s + F.least(F.lit(window), F.size(c["words"]))).alias("end")))))))
    found = both.select("_row", F.col("_n").alias("n_near"), F.size("_w").cast("long").alias("n_words"),
                        F.when(F.col("_c").isNotNull(), F.array_distinct(spans)).alias("hits"))
    none = F.lit(None).cast(found.schema["hits"].dataType)
    # the one-row generator keeps filters on the result above the word comparison,
    # which they would otherwise repeat for each of its uses
    found = found.select("_row", "n_near", F.explode(F.array(F.struct("n_words", "hits"))).alias("_f")) \
        .select("_row", "n_near", "_f.n_words", "_f.hits")
    return found.unionByName(rest.withColumn("hits", none).withColumn("n_near", F.lit(0).cast("long")))


def report(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id",
           min_share: int = 20, window: int = WINDOW, slop: int | None = SLOP) -> DataFrame:
    """``phrase_hits`` of the whole corpus plus n_hit (words inside a window), items
    (ids, sorted as strings), contaminated (n_hit > 0 and min_share * n_hit >= n_words) and n_near (items
    with a proximity match; ``slop`` None: not searched)."""
    items = benchmark_items(benchmark)
    rare = materialize(rare_terms(items, document_frequency(docs, items, text, key), window), "rare")
    index = postings(docs, rare, text, key)
    near = None if slop is None else materialize(proximity_hits(index, rare, slop), "near")
    hits = phrase_hits(docs, intersect(index, rare), items, text, key, window, near)
    at = F.flatten(F.transform("hits", lambda h: F.sequence(h["first"], h["end"] - 1)))
    n_hit = F.coalesce(F.size(F.array_distinct(at)).cast("long"), F.lit(0).cast("long"))
    ids = F.coalesce(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"]))),
                     F.array().cast("array<string>"))
    return (hits.withColumn("n_hit", F.when(F.col("hits").isNull(), F.lit(0).cast("long")).otherwise(n_hit))
            .withColumn("items", ids)
            .withColumn("contaminated", (F.col("n_hit") > 0)
                        & (F.lit(min_share) * F.col("n_hit") >= F.col("n_words"))))
