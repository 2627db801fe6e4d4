"""Quality gates, validation report, clean-and-label and the attrition ledger.

Operators P1-P9 and A1-A8. Every function maps DataFrame -> DataFrame except
the gates, which run one bounded action and raise.

Physical shape: equal texts meet by a 128-bit digest. Every row is reduced to its
digest, its key and a few numbers and flags; those are hash-aggregated (map side
first, so a text that holds a third of all rows is one row per task). No text is
sorted or shuffled by the report, the ledger or duplicate counting; clean-and-label
writes keys and digests once, finds the keys of *repeated* texts there, and drops them from
the rows: that table of numbers is broadcast while it is small, otherwise each text is
shuffled once by its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.session import materialize

REQUIRED = ("review_text", "rating")


class DataValidationError(Exception):
    """A critical validation rule failed."""


# --- gates -----------------------------------------------------------------

def require_columns(df: DataFrame, required=REQUIRED) -> None:
    """Fail listing the missing columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise DataValidationError(
            f"input lacks {', '.join(missing)} (it has {', '.join(df.columns)})")


def require_min_rows(df: DataFrame, min_rows: int = 100) -> None:
    """At least ``min_rows`` rows. Reads no more than ``min_rows`` rows."""
    n = df.limit(min_rows).count()
    if n < min_rows:
        raise DataValidationError(f"{n} input rows are fewer than the required {min_rows}")


# --- label rule --------------------------------------------------------------

def label_sentiment(df: DataFrame, rating: str = "rating") -> DataFrame:
    """P5 + P6: drop 3-star rows, label = rating >= 4."""
    return (df.filter(F.col(rating) != 3)
            .withColumn("label", (F.col(rating) >= 4).cast("int")))


# --- clean and label (P8) -----------------------------------------------------

def text_digest(text="review_text"):
    """128 bits that stand for a text (NULL stays NULL)."""
    return F.unhex(F.md5(F.col(text)))


def first_per_text(df: DataFrame, key: str = "review_key") -> DataFrame:
    """Keep the row of smallest ``key`` (unique) of every distinct review_text.

    One pass of the texts gives (key, digest), written; the rows that lose are found there and
    written as keys, so the rows meet a table of numbers (its real size decides how) and no
    text is hashed twice or compared."""
    digests = materialize(df.select(F.col(key).alias("_key"), text_digest().alias("_digest")), "text-digests")
    repeated = (digests.groupBy("_digest").agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("_n"))
                .where("_n > 1").select(F.col("_digest").alias("_d"), "_first"))
    losers = digests.join(repeated, F.col("_digest").eqNullSafe(F.col("_d"))).where("_key <> _first").select("_key")
    return df.join(materialize(losers, "repeated-texts"), F.col(key) == F.col("_key"), "left_anti").select(*df.columns)


def clean_and_label(df: DataFrame, key: str = "review_key") -> DataFrame:
    """P3, P4, W2, P5, P6, F5, F6, P7 in the reference's order.

    Output: key, review_text, rating, label, text_heavy_clean, text_light_clean.
    """
    kept = (df.dropna(subset=["review_text", "rating"])            # P3
            .filter(~T.is_blank("review_text")))                   # P4
    first = first_per_text(kept.select(key, "review_text", "rating"), key)   # W2
    labelled = label_sentiment(first)                               # P5, P6
    # The token array is produced by a one-row generator so that the P7 filter
    # on it is not substituted back into (and re-run by) the projection.
    toks = labelled.select("*", F.explode(F.array(T.heavy_tokens("review_text"))).alias("_tok"))
    return (toks.filter(F.size("_tok") > 0)                                   # P7
            .select(key, "review_text", "rating", "label",
                    F.array_join("_tok", " ").alias("text_heavy_clean"),     # F5
                    T.light_clean("review_text").alias("text_light_clean")))  # F6


# --- per-text pre-aggregation shared by report and ledger ---------------------

def _per_text(df: DataFrame, key: str, heavy: bool = False) -> DataFrame:
    """One narrow row per distinct review_text (NULL is one group): counts, the first
    key of usable rows, and the text's own numbers. Longs only, so it hash-aggregates."""
    r, t, words = F.col("rating"), F.col("review_text"), F.col("words")
    # words are counted once per row; a text without one is blank
    counted = df.select(
        F.col(key).alias("_k"), text_digest().alias("_digest"), r, t.isNull().alias("_none"),
        T.word_count("review_text").alias("words"),
        *([(~T.has_heavy_token("review_text")).cast("int").alias("heavy_empty")] if heavy else []))
    none = F.col("_none")
    rows = counted.select(
        "_k", "_digest", "rating", "words", none.cast("int").alias("no_text"),
        (~none & (words == 0)).cast("int").alias("blank"), (~none & (words > 0) & r.isNotNull()).alias("usable"),
        *(["heavy_empty"] if heavy else []))
    r = F.col("rating")
    return rows.groupBy("_digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(r.isNull()).alias("n_null_rating"),
        F.count_if(r.isNotNull() & ~r.between(1, 5)).alias("n_invalid"),
        F.count_if(r >= 4).alias("n_pos"), F.count_if(r <= 2).alias("n_neg"),
        F.max("no_text").alias("no_text"), F.max("blank").alias("blank"), F.max("words").alias("words"),
        F.count_if((F.col("no_text") == 1) | r.isNull()).alias("n_null"),
        F.count_if((F.col("no_text") == 0) & r.isNotNull() & (F.col("blank") == 1)).alias("n_blank"),
        F.min(F.when(F.col("usable"), F.col("_k"))).alias("first_key"),
        F.min(F.when(F.col("usable") & (r == 3), F.col("_k"))).alias("first_neutral"),
        *([F.max("heavy_empty").alias("heavy_empty")] if heavy else []))


def validation_report(df: DataFrame, key: str = "review_key") -> DataFrame:
    """A1-A6 as one flat row.

    duplicate_rows = rows beyond the first per text (NULL one value);
    empty_text_rows ignores NULL text; word length of NULL text is 0.
    """
    g = _per_text(df, key)
    wc, n = F.col("words"), F.col("n")
    total = F.sum("n")
    pos, neg = F.sum("n_pos"), F.sum("n_neg")
    return g.agg(
        total.alias("total_rows"),
        F.sum(F.when(F.col("no_text") == 1, n).otherwise(0)).alias("null_text_rows"),
        F.sum("n_null_rating").alias("null_rating_rows"),
        (total - F.count(F.lit(1))).alias("duplicate_rows"),
        F.sum(F.when(F.col("blank") == 1, n).otherwise(0)).alias("empty_text_rows"),
        F.sum("n_invalid").alias("invalid_rating_values"),
        pos.alias("positive"), neg.alias("negative"),
        (total - pos - neg).alias("neutral_dropped"),
        F.min(wc).alias("length_min"), F.max(wc).alias("length_max"),
        F.round(F.sum(wc * n) / total, 6).alias("length_mean"),
    )


def validation_report_nested(df: DataFrame, key: str = "review_key") -> DataFrame:
    """The report in its published nested shape (S8 writes it as JSON)."""
    flat = validation_report(df, key)
    return flat.select(
        "total_rows", "null_text_rows", "null_rating_rows", "duplicate_rows",
        "empty_text_rows", "invalid_rating_values",
        F.struct(F.col("positive"), F.col("negative"),
                 F.col("neutral_dropped")).alias("class_balance"),
        F.struct(F.col("length_min").alias("min"), F.col("length_max").alias("max"),
                 F.bround("length_mean", 1).alias("mean")).alias("review_length_stats"))


def gate(df: DataFrame, min_rows: int = 100) -> None:
    """P2 then P1; raises DataValidationError."""
    require_min_rows(df, min_rows)
    require_columns(df)


def validate(df: DataFrame, min_rows: int = 100, key: str = "review_key") -> dict:
    """The gates, then the report as a dict."""
    gate(df, min_rows)
    return validation_report_nested(df, key).first().asDict(recursive=True)


# --- attrition ledger (P9) ----------------------------------------------------

LEDGER_STEPS = ("input", "null_text_or_rating", "blank_text", "duplicate_text",
                "neutral_rating", "empty_after_clean")


def attrition_ledger(df: DataFrame, key: str = "review_key") -> DataFrame:
    """Rows removed and remaining after each cleaning step, in order."""
    g = _per_text(df, key, heavy=True)
    has_first = F.col("first_key").isNotNull()
    # the first usable row is neutral when it is also the first neutral one
    neutral = has_first & F.coalesce(F.col("first_neutral") == F.col("first_key"), F.lit(False))
    s = g.agg(
        F.sum("n").alias("total"),
        F.sum("n_null").alias("r1"),
        F.sum("n_blank").alias("r2"),
        (F.sum("n") - F.sum("n_null") - F.sum("n_blank")
         - F.count_if(has_first)).alias("r3"),
        F.count_if(neutral).alias("r4"),
        F.count_if(has_first & ~neutral & (F.col("heavy_empty") == 1)).alias("r5"),
    )
    rows = []
    before = F.col("total")
    for i, step in enumerate(LEDGER_STEPS):
        removed = F.lit(0).cast("bigint") if i == 0 else F.col(f"r{i}")
        after = before - removed
        share = F.round(F.when(before > 0, removed / before), 6)
        rows.append(F.struct(F.lit(i).alias("step_no"), F.lit(step).alias("step"),
                             before.alias("rows_before"), removed.alias("rows_removed"),
                             after.alias("rows_remaining"), share.alias("share_removed")))
        before = after
    return s.select(F.inline(F.array(*rows)))


# --- class shares (A8) -----------------------------------------------------------

def class_shares(cleaned: DataFrame) -> DataFrame:
    """Per label rows, share, imbalance ratio and always-majority accuracy."""
    counts = cleaned.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # the window runs over the already aggregated label table (two rows)
    from pyspark.sql import Window
    w = Window.partitionBy()
    total = F.sum("n").over(w)
    return counts.select(
        "label", "n",
        F.round(F.col("n") / total, 6).alias("share"),
        F.round(F.max("n").over(w) / F.min("n").over(w), 6).alias("imbalance_ratio"),
        F.round(F.max("n").over(w) / total, 6).alias("majority_accuracy"))


def extend_training(cleaned: DataFrame, new_rows: DataFrame, key: str = "review_key") -> DataFrame:
    """Add newly labelled rows to the cleaned table and clean the union
    again (first occurrence of a text still wins)."""
    base = cleaned.select(key, "review_text", "rating")
    return clean_and_label(base.unionByName(new_rows.select(key, "review_text", "rating")), key)


# --- incremental extension (U3) ------------------------------------------------------

def write_cleaned_store(cleaned: DataFrame, path: str, batch: int = 0) -> None:
    """A batch of cleaned rows and, beside it, the digests of their texts (16 bytes a row)."""
    cleaned.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")
    rows = cleaned.sparkSession.read.parquet(f"{path}/rows/batch={batch}")
    rows.select(text_digest().alias("digest")).write.mode("overwrite").parquet(f"{path}/digests/batch={batch}")


def extend_store(spark, path: str, new_rows: DataFrame, batch: int, key: str = "review_key") -> DataFrame:
    """U3 without cleaning everything again: rows whose text no earlier batch holds are cleaned and
    written as batch ``batch`` (a retry writes the same folder again); returns them.

    Earlier rows are not read: only their digest index is, and only keys and digests of the
    new rows meet it. Keys of new rows follow those of the store, so an earlier text wins."""
    known = spark.read.parquet(f"{path}/digests").where(F.col("batch") < batch).select("digest")
    tagged = new_rows.where("review_text is not null").select(F.col(key).alias("_key"), text_digest().alias("digest"))
    old = materialize(tagged.join(known, "digest", "left_semi").select("_key"), "known-keys")
    fresh = new_rows.join(old, F.col(key) == F.col("_key"), "left_anti").select(key, "review_text", "rating")
    write_cleaned_store(clean_and_label(fresh, key), path, batch)
    return spark.read.parquet(f"{path}/rows/batch={batch}")
