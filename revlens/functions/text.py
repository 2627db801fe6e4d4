"""Scalar text functions as Spark Column expressions (F1-F11, F16, F18 helpers).

Everything here is a built-in expression tree, so it runs inside whole-stage
codegen with no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Stopword set used by the heavy cleaner (39 words, natural order).
STOPWORDS = (
    "a", "an", "the", "is", "are", "was", "were", "be", "been", "being",
    "and", "or", "but", "if", "of", "at", "by", "for", "with", "about",
    "to", "from", "in", "on", "it", "this", "that", "these", "those",
    "i", "you", "he", "she", "we", "they", "them", "his", "her", "its",
)
# Request limits and label names of the prediction service.
MAX_REQUEST_CHARS = 5000
LABEL_NAMES = {0: "negative", 1: "positive"}
# ---------------------------------------------------------------------------

# The set of characters Python's str.split()/strip()/re "\s" treat as
# whitespace, spelled for Java regex (Spark) and RE2 (DuckDB oracles). In Java,
# \s covers tab, newline, vertical tab, form feed, return and space, and \p{Z}
# every Unicode space / line / paragraph separator; together with \x1C-\x1F
# and \x85 that is exactly Python's set (checked over all code points), and it
# matches about three times faster than listing the separators one by one.
_WS_JAVA = r"\s\p{Z}\x1C-\x1F\x85"
_WS_RE2 = (r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
           r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")

WS_RUN = f"[{_WS_JAVA}]+"
TAG = r"<[^>]+>"
NON_ALNUM = f"[^a-z0-9{_WS_JAVA}]"
NON_WS = f"[^{_WS_JAVA}]"
NON_WS_RUN = NON_WS + "+"

# RE2 spellings, for SQL written against DuckDB.
WS_RUN_RE2 = f"[{_WS_RE2}]+"
NON_ALNUM_RE2 = f"[^a-z0-9{_WS_RE2}]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_html(col) -> Column:
    """every ``<...>`` tag (may span lines) becomes one space."""
    return F.regexp_replace(_c(col), TAG, " ")


def collapse_ws(col) -> Column:
    """Unicode whitespace runs to one space, then trimmed."""
    return F.trim(F.regexp_replace(_c(col), WS_RUN, " "))


def light_clean(col) -> Column:
    """tags out, whitespace collapsed; case, punctuation, stopwords kept."""
    return collapse_ws(strip_html(col))


def _alnum_tokens(col) -> Column:
    # lower -> tags to space -> split on runs of anything but [a-z0-9]. Equal to
    # replacing [^a-z0-9\s] by spaces, collapsing whitespace and splitting, in
    # two regex passes instead of four.
    return F.split(strip_html(F.lower(_c(col))), "[^a-z0-9]+")


def basic_clean(col) -> Column:
    """lower, tags out, non [a-z0-9] to space, collapse."""
    return F.array_join(F.filter(_alnum_tokens(col), lambda t: t != F.lit("")), " ")


def heavy_tokens(col) -> Column:
    """Tokens of the heavy cleaner (F2 lower, F1 tags, F3 non-alphanumerics,
    F4 whitespace) minus stopwords (J4)."""
    return F.filter(_alnum_tokens(col),
                    lambda t: (t != F.lit("")) & ~t.isin(list(STOPWORDS)))


def has_heavy_token(col) -> Column:
    """Does the heavy cleaner leave a token? Stops at the first one (NULL stays NULL)."""
    alone = rf"(?<![a-z0-9])(?!(?:{'|'.join(STOPWORDS)})(?![a-z0-9]))[a-z0-9]"
    return strip_html(F.lower(_c(col))).rlike(alone)


def heavy_clean(col) -> Column:
    """the TF-IDF input text."""
    return F.array_join(heavy_tokens(col), " ")


def words(col) -> Column:
    """Python ``str.split()`` on Unicode whitespace, as an array."""
    return F.filter(F.split(_c(col), WS_RUN), lambda t: t != F.lit(""))


def word_count(col) -> Column:
    """``len(str(t).split())``; NULL text counts 0."""
    return F.regexp_count(F.coalesce(_c(col), F.lit("")), F.lit(NON_WS_RUN))


def is_blank(col) -> Column:
    """``str.strip() == ''`` on non-null text (NULL stays NULL); stops at the
    first non-whitespace character."""
    return ~_c(col).rlike(NON_WS)


def has_alnum(col) -> Column:
    """F8: at least one ASCII letter or digit."""
    return _c(col).rlike("[A-Za-z0-9]")


def tfidf_tokens(col) -> Column:
    """F16: default TF-IDF tokenizer on heavy text: words of >= 2 characters."""
    return F.filter(F.split(_c(col), " "), lambda t: F.length(t) >= 2)


def bigrams(tokens: Column) -> Column:
    """F16: adjacent pairs joined by a space; empty for fewer than two tokens."""
    return F.when(
        F.size(tokens) >= 2,
        F.zip_with(F.slice(tokens, 1, F.size(tokens) - 1),
                   F.slice(tokens, 2, F.size(tokens) - 1),
                   lambda a, b: F.concat_ws(" ", a, b)),
    ).otherwise(F.array().cast("array<string>"))


def ngrams(tokens: Column, n_max: int) -> Column:
    """Unigrams, then bigrams, and so on up to ``n_max`` words, joined by spaces."""
    def of(n):
        if n == 2:
            return bigrams(tokens)
        grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1),
                            lambda i: F.array_join(F.slice(tokens, i, n), " "))
        return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(tokens, *[of(n) for n in range(2, n_max + 1)]) if n_max > 1 else tokens


def decode_label(col) -> Column:
    """class index to name."""
    return F.when(_c(col) == 1, F.lit(LABEL_NAMES[1])).when(
        _c(col) == 0, F.lit(LABEL_NAMES[0]))


def confidence(prob_positive) -> Column:
    """probability of the predicted class, rounded to 4 places."""
    p = _c(prob_positive)
    return F.round(F.greatest(p, 1 - p), 4)


def register_sql_functions(spark) -> None:
    """Expose the cleaners to SQL users as temporary SQL functions."""
    ws, tag, non = WS_RUN.replace("\\", "\\\\"), TAG, NON_ALNUM.replace("\\", "\\\\")
    stop = ", ".join(f"'{w}'" for w in STOPWORDS)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION light_clean(t STRING) RETURNS STRING "
        f"RETURN trim(regexp_replace(regexp_replace(t, '{tag}', ' '), '{ws}', ' '))")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION heavy_clean(t STRING) RETURNS STRING "
        "RETURN array_join(filter(split(trim(regexp_replace(regexp_replace("
        f"regexp_replace(lower(t), '{tag}', ' '), '{non}', ' '), '{ws}', ' ')), ' '), "
        f"x -> x != '' AND NOT array_contains(array({stop}), x)), ' ')")
