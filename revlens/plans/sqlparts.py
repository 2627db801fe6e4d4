"""SQL fragments for the independent DuckDB oracles.

These rebuild the same views and text expressions in plain SQL (RE2 regex
spelling, DuckDB lambda syntax) so each Spark query can be checked against a
second engine on the same parquet tables.
"""

from __future__ import annotations

from revlens.functions.text import NON_ALNUM_RE2, STOPWORDS, TAG, WS_RUN_RE2

WS = WS_RUN_RE2
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)


def light(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace({x}, '{TAG}', ' ', 'g'), "
            f"'{WS}', ' ', 'g'))")


def basic(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(lower({x}), '{TAG}', ' ', 'g'), "
            f"'{NON_ALNUM_RE2}', ' ', 'g'), '{WS}', ' ', 'g'))")


def heavy_tokens(x: str) -> str:
    return (f"list_filter(string_split({basic(x)}, ' '), "
            f"lambda t: t <> '' AND NOT list_contains([{_STOP}], t))")


def heavy(x: str) -> str:
    return f"array_to_string({heavy_tokens(x)}, ' ')"


def blank(x: str) -> str:
    return f"(regexp_replace({x}, '{WS}', '', 'g') = '')"


def word_count(x: str) -> str:
    return (f"CAST(len(list_filter(regexp_split_to_array(coalesce({x}, ''), '{WS}'), "
            f"lambda t: t <> '')) AS INTEGER)")


def tfidf_tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: length(t) >= 2)"


K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

VIEWS = {
    "reviews": """reviews AS (
  SELECT d.doc_id AS review_key, d.text AS review_text,
    CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 5 WHEN l.quality = 1 AND l.toxic = 1 THEN 3
         WHEN l.quality = 0 AND l.toxic = 0 THEN 2 WHEN l.quality = 0 AND l.toxic = 1 THEN 1 END AS rating
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "dirty_reviews": """dirty_reviews AS (
  SELECT doc_id AS review_key,
    CASE WHEN doc_id % 89 = 0 THEN NULL WHEN doc_id % 83 = 0 THEN '   ' WHEN doc_id % 71 = 0 THEN '!!! ???'
         WHEN doc_id % 5 = 0 THEN concat('<br />', text, ' <b>x</b>') ELSE text END AS review_text,
    CASE WHEN doc_id % 97 = 0 THEN NULL WHEN doc_id % 79 = 0 THEN 7 ELSE CAST(1 + doc_id % 5 AS INTEGER) END AS rating
  FROM documents)""",
    "requests": """requests AS (
  SELECT conv_id * 1000 + turn AS request_id,
    CASE WHEN (conv_id + turn) % 23 = 0 THEN NULL WHEN (conv_id + turn) % 19 = 0 THEN '!!!???'
         WHEN (conv_id + turn) % 17 = 0 THEN '<br /><br />' WHEN (conv_id + turn) % 13 = 0 THEN repeat(text, 200)
         ELSE text END AS text
  FROM conversations WHERE role = 'user')""",
    "prediction_log": f"""prediction_log AS (
  SELECT event_id AS id, ts, event_type AS model,
    CASE WHEN {K} < 84 THEN 'positive' ELSE 'negative' END AS label,
    round(1 - least(value, 125) / CASE WHEN event_type IN ('view', 'signup') THEN 500 ELSE 250 END, 4) AS confidence,
    {K} AS word_count, value AS latency_ms
  FROM events)""",
    "labelled_batch": f"""labelled_batch AS (
  SELECT event_id AS id, CASE WHEN ts < TIMESTAMP '2024-01-25 00:00:00' THEN 'baseline' ELSE 'drifted' END AS batch,
    event_type AS drift_type,
    CASE WHEN {K} < 84 THEN 1 ELSE 0 END AS pred, CAST(user_id % 2 AS INT) AS truth,
    CASE WHEN {K} % 29 = 0 THEN NULL ELSE round(1 - least(value, 125) / 250, 4) END AS confidence
  FROM events)""",
    "scored": f"""scored AS (
  SELECT event_id AS id, 'a' AS model, round(least(value, 500) / 500, 4) AS prob_neg,
    CASE WHEN value + {K} > 120 THEN 0 ELSE 1 END AS label FROM events
  UNION ALL
  SELECT event_id, 'b', {K} / 100.0::DOUBLE,
    CASE WHEN value + {K} > 120 THEN 0 ELSE 1 END FROM events)""",
}


def cleaned_body(source: str, name: str = "cleaned") -> str:
    """clean_and_label over the CTE or view ``source``, as CTE text (no WITH)."""
    return f"""{name}_kept AS (
  SELECT * FROM {source}
  WHERE review_text IS NOT NULL AND rating IS NOT NULL AND NOT {blank('review_text')}),
{name}_first AS (
  SELECT review_key, review_text, rating FROM (
    SELECT *, row_number() OVER (PARTITION BY review_text ORDER BY review_key) AS rn
    FROM {name}_kept) WHERE rn = 1),
{name} AS (
  SELECT review_key, review_text, rating, CAST(rating >= 4 AS INTEGER) AS label,
    {heavy('review_text')} AS text_heavy_clean, {light('review_text')} AS text_light_clean
  FROM {name}_first WHERE rating <> 3 AND NOT {blank(heavy('review_text'))})"""


def cleaned_cte(source: str = "reviews", name: str = "cleaned") -> str:
    """A review view and clean_and_label over it, as CTE text (no WITH)."""
    return f"""{VIEWS[source]},
{cleaned_body(source, name)}"""


def split_cte(source: str = "reviews") -> str:
    """cleaned -> ided -> split (stratified, md5 order), as CTE text."""
    return f"""{cleaned_cte(source)},
ided AS (SELECT *, CAST(row_number() OVER (ORDER BY review_key) - 1 AS BIGINT) AS review_id FROM cleaned),
lc AS (SELECT label, count(*) AS c FROM ided GROUP BY label),
q0 AS (SELECT label, c, sum(c) OVER () AS n FROM lc),
q1 AS (SELECT *, n - CAST(ceil(0.2::DOUBLE * n) AS BIGINT) AS n_train FROM q0),
q2 AS (SELECT *, (n_train * c) // n AS fl, n_train * c - ((n_train * c) // n) * n AS rem FROM q1),
q3 AS (SELECT label, c, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
                                   <= n_train - sum(fl) OVER () THEN 1 ELSE 0 END AS train_q FROM q2),
quota AS (SELECT label, c - train_q AS test_quota FROM q3),
ranked AS (SELECT review_id, label, row_number() OVER (
             PARTITION BY label ORDER BY md5(concat('42', ':', CAST(review_id AS VARCHAR))), review_id) AS rk
           FROM ided),
split AS (SELECT r.review_id, CASE WHEN rk <= test_quota THEN 'test' ELSE 'train' END AS split
          FROM ranked r JOIN quota q ON r.label = q.label)"""


def docs_cte() -> str:
    """split + the cleaned rows with their split (docs) and train rows."""
    return f"""{split_cte()},
docs AS (SELECT i.*, s.split FROM ided i JOIN split s ON i.review_id = s.review_id),
train AS (SELECT * FROM docs WHERE split = 'train')"""


def grams(x: str, ngram_max: int) -> str:
    toks = tfidf_tokens(x)
    if ngram_max == 1:
        return toks
    return (f"list_concat({toks}, list_transform(range(1, len({toks})), "
            f"lambda i: {toks}[i] || ' ' || {toks}[i + 1]))")


def counts_cte(name: str, src: str, ngram_max: int) -> str:
    return f"""{name} AS (
  SELECT review_id, term, count(*) AS tf FROM (
    SELECT review_id, unnest({grams('text_heavy_clean', ngram_max)}) AS term FROM {src})
  GROUP BY review_id, term)"""


def tfidf_cte(ngram_max: int, max_features: int, sublinear: bool) -> str:
    """docs/train -> vocab(term, idx, cf, df, idf) -> weights(review_id, term, weight)."""
    tfw = "(1 + ln(c.tf))" if sublinear else "c.tf"
    return f"""{docs_cte()},
{counts_cte('train_counts', 'train', ngram_max)},
{counts_cte('all_counts', 'docs', ngram_max)},
stats AS (SELECT term, sum(tf) AS cf, count(*) AS df FROM train_counts GROUP BY term),
capped AS (SELECT * FROM stats ORDER BY cf DESC, term LIMIT {max_features}),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, CAST(cf AS BIGINT) AS cf, df,
            ln((1.0 + (SELECT count(*) FROM train)) / (1.0 + df)) + 1.0 AS idf FROM capped),
raw AS (SELECT c.review_id, c.term, v.idx, {tfw} * v.idf AS w FROM all_counts c JOIN vocab v ON c.term = v.term),
weights AS (SELECT review_id, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY review_id)) AS weight FROM raw)"""
