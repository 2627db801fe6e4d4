"""Leak-free feature store, manifest, saved transformer.

The transformer (TF-IDF vocabulary + SVD components) is fitted on training
rows only and applied to every row; the store keeps the split column, is
written partitioned by split (training reads prune the test partition) and
is described by a one-row manifest.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import svd as SVD
from revlens.operators import tfidf as TF
from revlens.session import materialize, shuffles_freed

META = ["review_id", "label", "text_length", "split"]


@dataclass
class Transformer:
    tfidf: TF.TfidfModel
    svd: SVD.SvdModel
    settings: dict


def fit_transformer(train: DataFrame, max_features: int = 20000, ngram_max: int = 2,
                    sublinear: bool = True, k: int = 600, seed: int = 42) -> Transformer:
    """M5: fit TF-IDF and SVD on the training rows."""
    tf = TF.fit(train, ngram_max=ngram_max, sublinear=sublinear, max_features=max_features)
    n_terms = tf.vocab.count()
    svd = SVD.fit(SVD.doc_arrays(TF.transform(tf, train)), n_terms, k)
    return Transformer(tf, svd, _settings(max_features, ngram_max, sublinear, svd, seed))


def _settings(max_features: int, ngram_max: int, sublinear: bool, svd: SVD.SvdModel, seed: int) -> dict:
    return {"tfidf_max_features": max_features, "tfidf_ngram_range": [1, ngram_max],
            "tfidf_sublinear_tf": sublinear, "svd_dims": int(svd.components.shape[1]),
            "random_state": seed}


def transform(tr: Transformer, docs: DataFrame, id_col: str = "review_id") -> DataFrame:
    """Features for any rows holding ``text_heavy_clean`` (M12 reuses it).
    J3: the metadata columns and the feature array are put side by side by an
    equi-join on the row id, not by position; features are float32 (F14)."""
    arrays = SVD.doc_arrays(TF.transform(tr.tfidf, docs, id_col=id_col), id_col)
    return SVD.project(tr.svd, docs, arrays, id_col=id_col)


def build_store(docs: DataFrame, max_features: int = 20000, ngram_max: int = 2, sublinear: bool = True,
                k: int = 600, seed: int = 42) -> tuple[DataFrame, Transformer]:
    """M6: review_id, label, text_length (words of the raw text), split, k floats.

    Texts are tokenised twice only: for the vocabulary (train rows) and for the TF-IDF
    arrays of all rows, which are written once and serve the SVD and the projection."""
    train = docs.filter(F.col("split") == "train")
    tf = TF.fit(train, ngram_max=ngram_max, sublinear=sublinear, max_features=max_features)
    arrays = materialize(SVD.doc_arrays(TF.transform(tf, docs)), "tfidf-arrays")
    fit_rows = arrays.join(train.select("review_id"), "review_id", "left_semi").select("idx", "val")
    svd = SVD.fit(fit_rows, tf.vocab.count(), k, seed=seed)
    svd.tables.append(arrays)
    tr = Transformer(tf, svd, _settings(max_features, ngram_max, sublinear, svd, seed))
    meta = docs.select("review_id", "label", T.word_count("review_text").alias("text_length"), "split")
    return SVD.project(svd, meta, arrays).select(*META, "features"), tr


def build_nested(docs: DataFrame, configs: dict[str, dict], seed: int = 42) -> dict[str, DataFrame]:
    """The stores of several settings from shared factors. Texts are tokenised once (the written
    term counts of the largest n-gram range); settings that differ in weighting share a vocabulary;
    settings that differ in dimensions share one range finder, whose leading components are the
    smaller store. A store is a view of the written projection of its group."""
    train = docs.filter(F.col("split") == "train")
    meta = docs.select("review_id", "label", T.word_count("review_text").alias("text_length"), "split")
    counts: dict[int, tuple[DataFrame, DataFrame]] = {}
    vocabs: dict[tuple, TF.TfidfModel] = {}
    wide: dict[tuple, DataFrame] = {}
    groups: dict[tuple, int] = {}
    for c in configs.values():
        key = (c["ngram_max"], c["max_features"], c["sublinear"])
        groups[key] = max(groups.get(key, 0), c["k"])
    for (ngram_max, max_features, sublinear), k in groups.items():
        if ngram_max not in counts:
            every = materialize(TF.term_counts(docs, ngram_max=ngram_max), "term-counts")
            counts[ngram_max] = every, every.join(train.select("review_id"), "review_id", "left_semi")
        every, fitted = counts[ngram_max]
        if (ngram_max, max_features) not in vocabs:
            vocabs[ngram_max, max_features] = TF.fit(train, ngram_max=ngram_max, max_features=max_features, counts=fitted)
        tf = replace(vocabs[ngram_max, max_features], sublinear=sublinear)
        arrays = materialize(SVD.doc_arrays(TF.transform(tf, docs, counts=every)), "tfidf-arrays")
        fit_rows = arrays.join(train.select("review_id"), "review_id", "left_semi").select("idx", "val")
        svd = SVD.fit(fit_rows, tf.vocab.count(), k, seed=seed)
        svd.tables.append(arrays)
        wide[ngram_max, max_features, sublinear] = materialize(
            SVD.project(svd, meta, arrays).select(*META, "features"), "nested-store", partition_by="split")
        svd.release()
    return {name: wide[c["ngram_max"], c["max_features"], c["sublinear"]].select(
        *META, F.slice("features", 1, c["k"]).alias("features")) for name, c in configs.items()}


def manifest(spark, store: DataFrame, tr: Transformer, split_source: str = "stratified_split") -> DataFrame:
    """M7: one-row manifest; ``rows`` counts per split come from the store."""
    k = tr.settings["svd_dims"]
    rows = store.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    m = rows.agg(F.map_from_entries(F.collect_list(F.struct("split", "n"))).alias("rows"))
    s = tr.settings
    return m.select(
        F.array(*[F.lit(f"f_{i}") for i in range(k)]).alias("feature_columns"),
        F.lit(k).alias("n_features"), F.array(*[F.lit(c) for c in META]).alias("metadata_columns"),
        F.lit(s["tfidf_max_features"]).alias("tfidf_max_features"),
        F.array(*[F.lit(x) for x in s["tfidf_ngram_range"]]).alias("tfidf_ngram_range"),
        F.lit(s["tfidf_sublinear_tf"]).alias("tfidf_sublinear_tf"), F.lit(k).alias("svd_dims"),
        F.lit("rows of the train split").alias("fitted_on"),
        F.lit(split_source).alias("split_source"), F.lit(s["random_state"]).alias("random_state"),
        "rows")


def conformance(store: DataFrame, man: DataFrame) -> DataFrame:
    """M7 check: every feature array has n_features entries and the per-split
    row counts equal the manifest's; one row of (check, ok)."""
    m = man.select("n_features", "rows").first()      # the manifest is one row
    k, rows = m["n_features"], m["rows"] or {}
    expected = F.create_map(*[x for kv in rows.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    sizes = store.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                       F.min(F.size("features")).alias("lo"),
                                       F.max(F.size("features")).alias("hi"))
    return sizes.agg(
        F.bool_and((F.col("lo") == k) & (F.col("hi") == k)).alias("sizes_ok"),
        (F.bool_and(F.coalesce(F.try_element_at(expected, F.col("split")) == F.col("n"), F.lit(False)))
         & (F.count(F.lit(1)) == len(rows))).alias("rows_ok"))


def wide(store: DataFrame, k: int) -> DataFrame:
    """Compatibility view with one float column per dimension (f_0 .. f_{k-1})."""
    return store.select(*META, *[F.col("features")[i].alias(f"f_{i}") for i in range(k)])


def write_store(store: DataFrame, path: str) -> None:
    """Snappy parquet, sorted by id inside each file, partitioned by split (the
    partition column leads the order: the writer keeps an order that starts with it)."""
    with shuffles_freed(store.sparkSession):
        (store.sortWithinPartitions("split", "review_id").write.mode("overwrite")
         .option("compression", "snappy").partitionBy("split").parquet(path))


def save_transformer(tr: Transformer, path: str) -> None:
    """Vocabulary and components as parquet tables plus a settings file."""
    spark = tr.tfidf.vocab.sparkSession
    tr.tfidf.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    v = tr.svd.components
    for at in range(0, max(1, len(v)), SVD.BLOCK_TERMS):      # the driver holds one block beside the matrix
        rows = v[at:at + SVD.BLOCK_TERMS]
        block = pa.table({"term_idx": pa.array(np.arange(at, at + len(rows)), pa.int32()),
                          "v": pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * v.shape[1], rows.reshape(-1))})
        spark.createDataFrame(block, "term_idx int, v array<double>").coalesce(1).write \
            .mode("append" if at else "overwrite").parquet(f"{path}/components")
    meta = dict(tr.settings, n_docs=tr.tfidf.n_docs, n_terms=tr.svd.n_terms,
                singular_values=tr.svd.singular_values.tolist())
    spark.createDataFrame([(json.dumps(meta),)], "settings string").write.mode("overwrite") \
        .text(f"{path}/settings")


def load_transformer(spark, path: str) -> Transformer:
    """Reload what ``save_transformer`` wrote."""
    meta = json.loads(spark.read.text(f"{path}/settings").first()[0])
    vocab = spark.read.parquet(f"{path}/vocab")
    comps = spark.read.parquet(f"{path}/components").toArrow()
    v = np.empty((len(comps), len(meta["singular_values"])))
    for rows in comps.to_batches():
        v[rows.column("term_idx").to_numpy()] = rows.column("v").flatten().to_numpy().reshape(len(rows), -1)
    tf = TF.TfidfModel(vocab, meta["n_docs"], meta["tfidf_ngram_range"][1],
                       meta["tfidf_sublinear_tf"], meta["tfidf_max_features"])
    svd = SVD.SvdModel(v, np.array(meta["singular_values"]), meta["n_terms"])
    settings = {k: meta[k] for k in ("tfidf_max_features", "tfidf_ngram_range",
                                     "tfidf_sublinear_tf", "svd_dims", "random_state")}
    return Transformer(tf, svd, settings)
