"""TF-IDF on a long (doc, term, weight) table: A20, T2, T3, M1-M3, J7, F16, F18.

Shape of the plan:

* tokens and n-grams are array expressions; ``explode`` + ``groupBy(doc, term)``
  counts term frequencies. The documents are hash-partitioned by id once, and
  that partitioning satisfies both the (doc, term) grouping and the per-doc
  norm window, so neither adds an exchange. There are as many partitions as the texts
  need at TASK_CHARS each: a task's tables and sorts don't grow with the input;
* term statistics are one ``groupBy(term)`` with map-side partial
  aggregation, so a term present in every document is pre-summed per task; it is executed with
  as many shuffle partitions as the texts need, so a task's terms don't grow with the input;
* the vocabulary is capped with a top-k (``orderBy(...).limit(k)`` plans as a
  per-task partial top-k), so it is bounded by ``max_features`` rows, and only
  that bounded table is broadcast into the weight join;
* the L2 norm is a window by doc over the doc-partitioned weights.

Weight: tf * (ln((1 + n) / (1 + df)) + 1), tf optionally 1 + ln(tf), then L2
per document - the default smooth-idf TF-IDF.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import windows as W
from revlens.session import materialize, shuffle_partitions


TASK_CHARS = 4_000_000     # characters of text that one task counts


@dataclass
class TfidfModel:
    """A fitted vocabulary: ``vocab(term, idx, cf, df, idf)`` and settings."""
    vocab: DataFrame
    n_docs: int
    ngram_max: int
    sublinear: bool
    max_features: int | None


def text_parts(docs: DataFrame, text_col: str = "text_heavy_clean") -> int:
    """Partitions of at most about TASK_CHARS characters each (one pass over the text column)."""
    chars = docs.agg(F.sum(F.length(text_col).cast("long"))).first()[0] or 0
    return max(1, -(-chars // TASK_CHARS))


def term_counts(docs: DataFrame, id_col: str = "review_id",
                text_col: str = "text_heavy_clean", ngram_max: int = 1) -> DataFrame:
    """(id, term, tf) for every term occurrence in heavy-cleaned text.

    Documents are hash-partitioned by id first: that one exchange satisfies the
    (id, term) count and the later per-document norm window, which then need
    no exchange of their own.
    """
    # tokens are projected once; the generator then reuses the column instead of
    # re-splitting the text for every reference inside the n-gram expression
    return (docs.select(id_col, text_col).repartition(text_parts(docs, text_col), id_col)
            .select(id_col, T.tfidf_tokens(text_col).alias("_tok"))
            .select(id_col, F.explode(T.ngrams(F.col("_tok"), ngram_max)).alias("term"))
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def term_stats(counts: DataFrame) -> DataFrame:
    """Collection frequency and document frequency per term."""
    return counts.groupBy("term").agg(F.sum("tf").alias("cf"),
                                      F.count(F.lit(1)).alias("df"))


def written_stats(docs: DataFrame, id_col: str = "review_id", text_col: str = "text_heavy_clean", ngram_max: int = 1) -> DataFrame:
    """A20 of ``docs`` as a written table, counted in partitions by the text's size."""
    with shuffle_partitions(docs.sparkSession, text_parts(docs, text_col)):
        return materialize(term_stats(term_counts(docs, id_col, text_col, ngram_max)), "term-stats")


def cap_vocab(stats: DataFrame, max_features: int | None) -> DataFrame:
    """Top ``max_features`` terms by collection frequency (ties by term)."""
    if max_features is None:
        return stats
    return stats.orderBy(F.col("cf").desc(), F.col("term")).limit(max_features)


def fit(docs: DataFrame, id_col: str = "review_id", text_col: str = "text_heavy_clean",
        ngram_max: int = 1, sublinear: bool = False,
        max_features: int | None = 5000, counts: DataFrame | None = None) -> TfidfModel:
    """M1: learn vocabulary and idf from ``docs`` (train rows only for M5).

    Eager like an estimator: counts the fitting documents once. ``counts``: their written
    (id, term, tf) table, where several fits share one.
    """
    n = docs.count()
    stats = term_stats(term_counts(docs, id_col, text_col, ngram_max) if counts is None else counts)
    capped = cap_vocab(stats, max_features)
    # column index = alphabetical position after the cap: a capped table is numbered by
    # one window of at most max_features rows, an uncapped one over range partitions
    if max_features is not None:
        ranked = capped.withColumn("_rn", F.row_number().over(Window.orderBy("term")))
    else:
        ranked = W.row_numbers(capped, [], [F.col("term")], out="_rn")
    idf = F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0
    vocab = ranked.select("term", (F.col("_rn") - 1).cast("int").alias("idx"), "cf", "df", idf.alias("idf"))
    with shuffle_partitions(docs.sparkSession, text_parts(docs, text_col)):
        vocab = materialize(vocab, "vocab")   # written once; every transform reuses it
    return TfidfModel(vocab, n, ngram_max, sublinear, max_features)


def transform(model: TfidfModel, docs: DataFrame, id_col: str = "review_id",
              text_col: str = "text_heavy_clean", counts: DataFrame | None = None) -> DataFrame:
    """M2/M3 + J7: (id, term, idx, weight) for known terms, L2-normalised; ``counts`` as in ``fit``.

    Documents without a known term produce no rows here (zero vectors);
    ``to_vectors`` keeps them.
    """
    if counts is None:
        counts = term_counts(docs, id_col, text_col, model.ngram_max)
    vocab = model.vocab.select("term", "idx", "idf")
    if model.max_features is not None:
        # bounded by max_features rows: safe to broadcast
        vocab = F.broadcast(vocab)
    tf = F.col("tf").cast("double")
    tfw = (1.0 + F.log(tf)) if model.sublinear else tf
    raw = counts.join(vocab, "term", "inner").withColumn("_w", tfw * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", "idx", (F.col("_w") / norm).alias("weight"))


def fit_transform(docs: DataFrame, **kw) -> tuple[TfidfModel, DataFrame]:
    fit_kw = {k: v for k, v in kw.items() if k in ("ngram_max", "sublinear", "max_features")}
    io = {k: v for k, v in kw.items() if k in ("id_col", "text_col")}
    model = fit(docs, **io, **fit_kw)
    return model, transform(model, docs, **io)


def top_terms(weights: DataFrame, k: int = 8, id_col: str = "review_id") -> DataFrame:
    """The ``k`` heaviest terms of every document (ties by term)."""
    w = Window.partitionBy(id_col).orderBy(F.col("weight").desc(), F.col("term"))
    return (weights.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def vectorize(model: TfidfModel, docs: DataFrame, text_col: str = "text_heavy_clean",
              out: str = "features") -> DataFrame:
    """TF-IDF rows as sparse ml Vectors, computed in the JVM with Spark ML:
    counts over the fitted vocabulary (CountVectorizerModel; vocabulary and idf
    collected once, bounded by ``max_features``), idf scaling
    (ElementwiseProduct) and L2 normalisation (Normalizer). Index = the vocab
    ``idx``. Sublinear tf has no ML transformer: ``transform`` + ``to_vectors``
    build those vectors."""
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors
    if model.sublinear:
        raise ValueError("vectorize supports raw tf; use to_vectors for sublinear tf")
    if model.max_features is None:
        raise ValueError("vectorize holds the vocabulary on the driver: cap it (max_features) or use to_vectors")
    rows = model.vocab.select("idx", "term", "idf").orderBy("idx").collect()
    terms = [r["term"] for r in rows]
    idf = Vectors.dense([r["idf"] for r in rows])
    grams = docs.withColumn("_grams", T.ngrams(T.tfidf_tokens(text_col), model.ngram_max))
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol="_grams", outputCol="_tf")
    scaled = ElementwiseProduct(scalingVec=idf, inputCol="_tf", outputCol="_tfidf")
    norm = Normalizer(p=2.0, inputCol="_tfidf", outputCol=out)
    return norm.transform(scaled.transform(cv.transform(grams))).drop("_grams", "_tf", "_tfidf")


def to_vectors(weights: DataFrame, docs: DataFrame, size: int,
               id_col: str = "review_id") -> DataFrame:
    """Long table to one sparse ml Vector per document (any tf variant, also
    sublinear); documents with no known term become zero vectors (left join),
    so no row is lost. Built JVM-side through the vector's storage struct."""
    from revlens.operators.vectors import with_sparse_vectors
    per_doc = (weights.groupBy(id_col)
               .agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("_e")))
    # collect_list per document is bounded by that document's distinct terms
    return with_sparse_vectors(docs.join(per_doc, id_col, "left"), "_e", size)


# --- F18: word-level sequence encoding ------------------------------------------

PAD_ID, UNK_ID, CLS_ID, SEP_ID, FIRST_TERM_ID = 0, 1, 2, 3, 4


def sequence_encode(docs: DataFrame, vocab: DataFrame, max_length: int = 128,
                    batch_size: int = 64, id_col: str = "review_id",
                    text_col: str = "text_heavy_clean") -> DataFrame:
    """token ids cut at ``max_length`` (with CLS/SEP), padded to the longest
    row of each batch of ``batch_size`` consecutive ids, plus a 0/1 mask.

    Per-row work is bounded by ``max_length`` tokens; the vocabulary is a written
    table, so its real size decides whether the join broadcasts it.
    """
    keep = max_length - 2
    toks = T.tfidf_tokens(text_col)
    # one exchange: hash-partition by batch; the per-document grouping on
    # (batch, id) and the per-batch padding window both reuse it
    base = (docs.select(id_col, text_col)
            .withColumn("_batch", F.floor(F.col(id_col) / batch_size))
            .repartition("_batch")
            .select("_batch", id_col, F.size(toks).alias("n_tokens"),
                    F.slice(toks, 1, keep).alias("_t")))
    # posexplode_outer keeps documents without tokens (one row with NULL pos)
    ex = base.select("_batch", id_col, "n_tokens", F.posexplode_outer("_t").alias("pos", "term"))
    tid = F.coalesce(F.col("idx") + FIRST_TERM_ID, F.lit(UNK_ID))
    ids = ex.join(vocab.select("term", "idx"), "term", "left")
    enc = (ids.groupBy("_batch", id_col)
           .agg(F.max("n_tokens").alias("n_tokens"),
                F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(),
                                                   F.struct(F.col("pos"), tid.alias("tid")))))
                .alias("_s"))
           .withColumn("_ids", F.concat(F.array(F.lit(CLS_ID)),
                                        F.transform("_s", lambda x: x["tid"]),
                                        F.array(F.lit(SEP_ID))))
           .withColumn("_len", F.size("_ids")))
    pad_to = F.max("_len").over(Window.partitionBy("_batch"))
    return enc.select(
        id_col, "n_tokens", (F.col("n_tokens") > keep).cast("int").alias("truncated"),
        F.concat("_ids", F.array_repeat(F.lit(PAD_ID), pad_to - F.col("_len")))
        .alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.col("_len")),
                 F.array_repeat(F.lit(0), pad_to - F.col("_len"))).alias("attention_mask"))
