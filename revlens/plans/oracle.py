"""DuckDB oracle SQL for the named queries (same column names as the Spark side)."""

from __future__ import annotations

from revlens.plans import sqlparts as S
from revlens.sources.ingest import NA_TOKENS

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# --- data quality and cleaning ---------------------------------------------------

oracle("clean_and_label", f"""
WITH {S.cleaned_cte('reviews')}
SELECT * FROM cleaned""")

oracle("clean_and_label_dirty", f"""
WITH {S.cleaned_cte('dirty_reviews')}
SELECT * FROM cleaned""")

oracle("light_clean_pages", f"""
SELECT page_id, {S.light('html')} AS text_light_clean, {S.word_count(S.light('html'))} AS word_count
FROM pages""")

oracle("heavy_clean_docs", f"""
SELECT doc_id, {S.heavy('text')} AS text_heavy_clean FROM documents""")


def _validation(view: str) -> str:
    wc = S.word_count("review_text")
    return f"""
WITH {S.VIEWS[view]}
SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE review_text IS NULL) AS null_text_rows,
  count(*) FILTER (WHERE rating IS NULL) AS null_rating_rows,
  count(*) - count(DISTINCT review_text) - max(CASE WHEN review_text IS NULL THEN 1 ELSE 0 END) AS duplicate_rows,
  count(*) FILTER (WHERE review_text IS NOT NULL AND {S.blank('review_text')}) AS empty_text_rows,
  count(*) FILTER (WHERE rating IS NOT NULL AND NOT (rating BETWEEN 1 AND 5)) AS invalid_rating_values,
  count(*) FILTER (WHERE rating >= 4) AS positive,
  count(*) FILTER (WHERE rating <= 2) AS negative,
  count(*) - count(*) FILTER (WHERE rating >= 4) - count(*) FILTER (WHERE rating <= 2) AS neutral_dropped,
  min({wc}) AS length_min, max({wc}) AS length_max,
  round(avg({wc}), 6) AS length_mean
FROM {view}"""


oracle("validation_report", _validation("dirty_reviews"))
oracle("validation_report_reviews", _validation("reviews"))

oracle("attrition_ledger", f"""
WITH {S.VIEWS['dirty_reviews']},
tagged AS (
  SELECT *, CASE WHEN review_text IS NULL OR rating IS NULL THEN 1
                 WHEN {S.blank('review_text')} THEN 2 ELSE 0 END AS early
  FROM dirty_reviews),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY review_text ORDER BY review_key) AS rn
                 FROM tagged WHERE early = 0) WHERE rn = 1),
c AS (
  SELECT (SELECT count(*) FROM tagged) AS total,
         (SELECT count(*) FROM tagged WHERE early = 1) AS r1,
         (SELECT count(*) FROM tagged WHERE early = 2) AS r2,
         (SELECT count(*) FROM tagged WHERE early = 0) - (SELECT count(*) FROM firsts) AS r3,
         (SELECT count(*) FROM firsts WHERE rating = 3) AS r4,
         (SELECT count(*) FROM firsts WHERE rating <> 3 AND {S.blank(S.heavy('review_text'))}) AS r5),
steps AS (
  SELECT 0 AS step_no, 'input' AS step, 0 AS removed FROM c
  UNION ALL SELECT 1, 'null_text_or_rating', r1 FROM c
  UNION ALL SELECT 2, 'blank_text', r2 FROM c
  UNION ALL SELECT 3, 'duplicate_text', r3 FROM c
  UNION ALL SELECT 4, 'neutral_rating', r4 FROM c
  UNION ALL SELECT 5, 'empty_after_clean', r5 FROM c),
run AS (
  SELECT s.step_no, s.step, CAST(s.removed AS BIGINT) AS rows_removed,
    CAST(c.total - sum(s.removed) OVER (ORDER BY s.step_no) + s.removed AS BIGINT) AS rows_before
  FROM steps s, c)
SELECT step_no, step, rows_before, rows_removed, rows_before - rows_removed AS rows_remaining,
  round(CASE WHEN rows_before > 0 THEN rows_removed / rows_before END, 6) AS share_removed
FROM run""")

oracle("class_shares", f"""
WITH {S.cleaned_cte('reviews')},
counts AS (SELECT label, count(*) AS n FROM cleaned GROUP BY label)
SELECT label, n, round(n / sum(n) OVER (), 6) AS share,
  round(max(n) OVER () / min(n) OVER (), 6) AS imbalance_ratio,
  round(max(n) OVER () / sum(n) OVER (), 6) AS majority_accuracy
FROM counts""")

oracle("dedup_first", """
SELECT doc_id, source, n_copies FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn,
         count(*) OVER (PARTITION BY text) AS n_copies
  FROM documents) WHERE rn = 1""")


# --- ids, split, samples ---------------------------------------------------------

oracle("row_ids", f"""
WITH {S.cleaned_cte('reviews')}
SELECT review_key, CAST(row_number() OVER (ORDER BY review_key) - 1 AS BIGINT) AS review_id FROM cleaned""")

oracle("stratified_split", f"""
WITH {S.split_cte()}
SELECT review_id, split FROM split""")

oracle("split_counts", f"""
WITH {S.split_cte()}
SELECT s.split, i.label, count(*) AS n FROM ided i JOIN split s ON i.review_id = s.review_id
GROUP BY s.split, i.label""")

oracle("split_leak", f"""
WITH {S.split_cte()},
j AS (SELECT i.review_id, i.review_text, s.split FROM ided i JOIN split s ON i.review_id = s.review_id)
SELECT 'train_rows' AS "check", CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS value FROM split
UNION ALL SELECT 'test_rows', CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) FROM split
UNION ALL SELECT 'unmatched_ids', CAST(count(*) AS BIGINT) FROM ided i FULL OUTER JOIN split s
  ON i.review_id = s.review_id WHERE i.review_id IS NULL OR s.review_id IS NULL
UNION ALL SELECT 'overlap_ids', CAST(count(*) AS BIGINT) FROM (
  SELECT review_id FROM split GROUP BY review_id HAVING count(DISTINCT split) > 1)
UNION ALL SELECT 'leaked_test_rows', CAST(count(*) AS BIGINT) FROM j
  WHERE split = 'test' AND review_text IN (SELECT review_text FROM j WHERE split = 'train')""")

oracle("stratified_sample", f"""
WITH {S.split_cte()},
pool AS (SELECT i.review_id, i.label FROM ided i JOIN split s ON i.review_id = s.review_id WHERE s.split = 'train'),
pc AS (SELECT label, count(*) AS c FROM pool GROUP BY label),
pq AS (SELECT label, CAST(round_even(100 * c / sum(c) OVER (), 0) AS BIGINT) AS quota FROM pc),
pr AS (SELECT review_id, label, row_number() OVER (
         PARTITION BY label ORDER BY md5(concat('42', ':', CAST(review_id AS VARCHAR))), review_id) AS rk FROM pool)
SELECT pr.review_id, pr.label FROM pr JOIN pq ON pr.label = pq.label WHERE rk <= quota""")

oracle("simple_sample", f"""
WITH {S.split_cte()}
SELECT i.review_id, i.label FROM ided i JOIN split s ON i.review_id = s.review_id WHERE s.split = 'test'
ORDER BY md5(concat('42', ':', CAST(i.review_id AS VARCHAR))), i.review_id LIMIT 200""")


# --- TF-IDF -----------------------------------------------------------------------

oracle("term_stats", f"""
WITH {S.docs_cte()},
{S.counts_cte('train_counts', 'train', 2)}
SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM train_counts GROUP BY term""")

oracle("vocab_topn", f"""
WITH {S.tfidf_cte(1, 5000, False)}
SELECT term, idx, cf, df, round(idf, 6) AS idf FROM vocab""")

oracle("tfidf_plain", f"""
WITH {S.tfidf_cte(1, 5000, False)}
SELECT review_id, term, round(weight, 6) AS weight FROM weights""")

oracle("tfidf_bigram", f"""
WITH {S.tfidf_cte(2, 20000, False)}
SELECT review_id, term, round(weight, 6) AS weight FROM weights""")

oracle("tfidf_sublinear", f"""
WITH {S.tfidf_cte(2, 20000, True)}
SELECT review_id, term, round(weight, 6) AS weight FROM weights""")

oracle("top_terms_per_doc", f"""
WITH {S.tfidf_cte(1, 5000, False)},
r AS (SELECT review_id, term, weight,
        CAST(row_number() OVER (PARTITION BY review_id ORDER BY weight DESC, term) AS INTEGER) AS rank FROM weights)
SELECT review_id, rank, term, round(weight, 6) AS weight FROM r WHERE rank <= 8""")

oracle("sequence_encode", f"""
WITH {S.tfidf_cte(1, 5000, False)},
toks AS (SELECT review_id, {S.tfidf_tokens('text_heavy_clean')} AS t FROM docs),
base AS (SELECT review_id, CAST(len(t) AS INTEGER) AS n_tokens, t[1:126] AS t FROM toks),
ex AS (SELECT review_id, unnest(t) AS term, unnest(range(len(t))) AS pos FROM base),
ids AS (SELECT e.review_id, e.pos, coalesce(v.idx + 4, 1) AS tid FROM ex e LEFT JOIN vocab v ON e.term = v.term),
seqs AS (SELECT review_id, list(tid ORDER BY pos) AS s FROM ids GROUP BY review_id),
enc AS (SELECT b.review_id, b.n_tokens, list_concat([2], coalesce(s.s, []), [3]) AS s
        FROM base b LEFT JOIN seqs s ON b.review_id = s.review_id),
lens AS (SELECT *, len(s) AS l, max(len(s)) OVER (PARTITION BY review_id // 64) AS m FROM enc)
SELECT review_id, n_tokens, CAST(n_tokens > 126 AS INTEGER) AS truncated,
  array_to_string(list_concat(s, list_transform(range(m - l), lambda i: 0)), ' ') AS input_ids,
  array_to_string(list_concat(list_transform(range(l), lambda i: 1), list_transform(range(m - l), lambda i: 0)), ' ') AS attention_mask
FROM lens""")


# --- evaluation ---------------------------------------------------------------------

_BUNDLE = """
conf AS (
  SELECT model, count(*) AS n,
    count(*) FILTER (WHERE prob_neg > 0.5 AND label = 0) AS caught,
    count(*) FILTER (WHERE NOT (prob_neg > 0.5) AND label = 0) AS missed,
    count(*) FILTER (WHERE prob_neg > 0.5 AND label = 1) AS false_alarms,
    count(*) FILTER (WHERE NOT (prob_neg > 0.5) AND label = 1) AS true_positives
  FROM scored GROUP BY model),
m0 AS (
  SELECT *,
    CASE WHEN caught + false_alarms <> 0 THEN caught / (caught + false_alarms) ELSE 0 END AS p0,
    CASE WHEN caught + missed <> 0 THEN caught / (caught + missed) ELSE 0 END AS r0,
    CASE WHEN true_positives + missed <> 0 THEN true_positives / (true_positives + missed) ELSE 0 END AS p1,
    CASE WHEN true_positives + false_alarms <> 0 THEN true_positives / (true_positives + false_alarms) ELSE 0 END AS r1
  FROM conf),
m AS (
  SELECT *,
    CASE WHEN p0 + r0 <> 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0,
    CASE WHEN p1 + r1 <> 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1,
    (caught + true_positives) / n AS accuracy
  FROM m0),
g AS (SELECT model, prob_neg AS score, count(*) AS n_rows,
        count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg
      FROM scored GROUP BY model, prob_neg),
auc AS (
  SELECT model, sum(n_neg * (below + n_pos * 0.5)) / (sum(n_pos) * sum(n_neg)) AS roc_auc FROM (
    SELECT *, coalesce(sum(n_pos) OVER (PARTITION BY model ORDER BY score
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
  GROUP BY model),
bundle AS (
  SELECT m.model, m.n, m.accuracy, (f0 + f1) / 2 AS macro_f1, a.roc_auc,
    p0 AS negative_precision, r0 AS negative_recall
  FROM m JOIN auc a ON m.model = a.model),
curve AS (
  SELECT model, score AS threshold,
    CAST(sum(n_rows) OVER w AS BIGINT) AS flagged, CAST(sum(n_neg) OVER w AS BIGINT) AS hits,
    CAST(sum(n_neg) OVER (PARTITION BY model) AS BIGINT) AS positives
  FROM g WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
targets AS (SELECT * FROM (VALUES (0.80), (0.85), (0.90), (0.9094), (0.93), (0.95)) v(target)),
matched AS (
  SELECT * FROM (
    SELECT c.*, t.target, row_number() OVER (PARTITION BY c.model, t.target ORDER BY c.threshold DESC) AS rn
    FROM curve c JOIN targets t ON c.positives > 0 AND c.hits >= t.target * c.positives) WHERE rn = 1),
runs AS (
  SELECT b.*, f.fp AS test_fingerprint FROM bundle b JOIN (
    SELECT model, sum(CAST(CAST('0x' || substr(md5(md5(CAST(id AS VARCHAR))), 1, 15) AS BIGINT) AS DECIMAL(38,0))) AS fp
    FROM scored GROUP BY model) f ON b.model = f.model)"""

_CONF = f"{S.VIEWS['scored']},{_BUNDLE}"

R6 = lambda *cs: ", ".join(f"round({c}, 6) AS {c}" for c in cs)

oracle("confusion", f"""
WITH {_CONF}
SELECT model, n, caught, missed, false_alarms, true_positives FROM conf""")

oracle("metric_bundle", f"""
WITH {_CONF}
SELECT model, n, {R6('accuracy', 'macro_f1', 'roc_auc', 'negative_precision', 'negative_recall')} FROM bundle""")

oracle("classification_report", f"""
WITH {_CONF}
SELECT model, 'negative' AS row_name, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1,
  CAST(caught + missed AS BIGINT) AS support FROM m
UNION ALL SELECT model, 'positive', round(p1, 6), round(r1, 6), round(f1, 6),
  CAST(true_positives + false_alarms AS BIGINT) FROM m
UNION ALL SELECT model, 'accuracy', NULL, NULL, round(accuracy, 6), n FROM m
UNION ALL SELECT model, 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM m
UNION ALL SELECT model, 'weighted avg',
  round((p0 * (caught + missed) + p1 * (true_positives + false_alarms)) / n, 6),
  round((r0 * (caught + missed) + r1 * (true_positives + false_alarms)) / n, 6),
  round((f0 * (caught + missed) + f1 * (true_positives + false_alarms)) / n, 6), n FROM m""")

oracle("roc_auc", f"""
WITH {_CONF}
SELECT model, round(roc_auc, 6) AS roc_auc FROM auc""")

oracle("pr_curve", f"""
WITH {_CONF}
SELECT model, threshold, flagged, hits, positives, round(hits / flagged, 6) AS precision,
  round(hits / positives, 6) AS recall FROM curve""")

oracle("precision_at_recall", f"""
WITH {_CONF}
SELECT model, CAST(target AS DOUBLE) AS target, threshold, round(hits / flagged, 6) AS precision,
  round(hits / positives, 6) AS recall FROM matched""")

oracle("false_alarms", f"""
WITH {_CONF}
SELECT model, CAST(target AS DOUBLE) AS target, hits AS caught, flagged - hits AS false_alarms FROM matched""")

oracle("leaderboard", f"""
WITH {_CONF}
SELECT model AS run_name, CAST(rank() OVER (ORDER BY macro_f1 DESC) AS INTEGER) AS rank,
  {R6('accuracy', 'macro_f1', 'roc_auc', 'negative_precision', 'negative_recall')} FROM runs""")

oracle("best_run", f"""
WITH {_CONF}
SELECT model AS best_run, round(macro_f1, 6) AS macro_f1 FROM runs ORDER BY runs.macro_f1 DESC, model LIMIT 1""")

oracle("promotion_gate", f"""
WITH {_CONF}
SELECT 'b' AS candidate, 'a' AS incumbent, round(c.macro_f1, 6) AS cand_f1, round(i.macro_f1, 6) AS inc_f1,
  c.test_fingerprint = i.test_fingerprint AS same_test_rows,
  c.test_fingerprint = i.test_fingerprint AND c.macro_f1 > i.macro_f1 AS promote
FROM runs c JOIN runs i ON c.model = 'b' AND i.model = 'a'""")


def _fp(cols: list[str]) -> str:
    txt = "concat_ws(',', " + ", ".join(f"coalesce(md5(CAST({c} AS VARCHAR)), '-')" for c in cols) + ")"
    return (f"count(*) AS n_rows, CAST(sum(CAST(CAST('0x' || substr(md5({txt}), 1, 15) AS BIGINT) "
            f"AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS content_hash")


oracle("dataset_fingerprint", f"""
WITH {S.cleaned_cte('reviews')}
SELECT 'documents' AS dataset, {_fp(['doc_id', 'text', 'lang', 'source', 'n_chars'])} FROM documents
UNION ALL
SELECT 'cleaned_reviews', {_fp(['review_key', 'review_text', 'rating', 'label', 'text_heavy_clean', 'text_light_clean'])}
FROM cleaned""")


# --- monitoring and drift --------------------------------------------------------

_SIG = f"""{S.VIEWS['prediction_log']},
win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts DESC, id DESC) AS rn
                       FROM prediction_log) WHERE rn <= 100),
sig AS (
  SELECT model, count(*) AS predictions, avg(confidence) AS mean_confidence,
    count(*) FILTER (WHERE confidence < 0.8) / count(*) AS low_confidence_rate,
    count(*) FILTER (WHERE label = 'positive') / count(*) AS positive_share,
    quantile_cont(word_count, 0.5) AS median_word_count,
    list_sort(list(latency_ms))[CAST(least(floor(count(*) * 0.95), count(*) - 1) AS BIGINT) + 1] AS p95_latency_ms
  FROM win GROUP BY model)"""

oracle("monitor_signals", f"""
WITH {_SIG}
SELECT model, predictions, {R6('mean_confidence', 'low_confidence_rate', 'positive_share',
                              'median_word_count', 'p95_latency_ms')} FROM sig""")

oracle("health_checks", f"""
WITH {_SIG},
h AS (
  SELECT model, 'low confidence rate' AS "check", low_confidence_rate AS value, 0.25::DOUBLE AS "limit",
    low_confidence_rate <= 0.25 AS ok FROM sig
  UNION ALL SELECT model, 'mean confidence', mean_confidence, 0.90::DOUBLE, mean_confidence >= 0.90 FROM sig
  UNION ALL SELECT model, 'positive share', positive_share, 0.15::DOUBLE,
    abs(positive_share - 0.843::DOUBLE) <= 0.15::DOUBLE FROM sig
  UNION ALL SELECT model, 'p95 latency', p95_latency_ms, 200.0::DOUBLE, p95_latency_ms <= 200.0 FROM sig)
SELECT model, "check", round(value, 6) AS value, "limit", ok, CASE WHEN ok THEN 'OK' ELSE 'ALERT' END AS state
FROM h""")

oracle("retrain_trigger", f"""
WITH {_SIG}
SELECT model, predictions, round(low_confidence_rate, 6) AS low_confidence_rate,
  predictions >= 100 AND low_confidence_rate > 0.25 AS retrain,
  CASE WHEN predictions < 100 THEN 'too early: ' || predictions || ' of 100 predictions seen'
       WHEN low_confidence_rate > 0.25 THEN 'retrain: low-confidence rate ' || printf('%.1f%%', low_confidence_rate * 100)
            || ' exceeds 25%'
       ELSE 'keep: low-confidence rate ' || printf('%.1f%%', low_confidence_rate * 100) || ' does not exceed 25%'
  END AS reason
FROM sig""")

oracle("hard_examples", f"""
WITH {_SIG}
SELECT model, id, ts, confidence FROM win WHERE confidence < 0.8""")

_DRIFT_AGGS = """count(*) AS n, count(confidence) AS scored, count(*) - count(confidence) AS rejected,
    CASE WHEN count(confidence) > 0 THEN count(*) FILTER (WHERE confidence IS NOT NULL AND pred = truth)
         / count(confidence) END AS accuracy,
    avg(confidence) AS mean_confidence,
    CASE WHEN count(confidence) > 0 THEN count(*) FILTER (WHERE confidence < 0.8) / count(confidence) END
      AS low_confidence_rate"""

oracle("drift_metrics", f"""
WITH {S.VIEWS['labelled_batch']}
SELECT batch, drift_type, CASE WHEN GROUPING(drift_type) = 0 THEN 'batch_type' ELSE 'batch' END AS level,
  n, scored, rejected, {R6('accuracy', 'mean_confidence', 'low_confidence_rate')}
FROM (SELECT batch, drift_type, {_DRIFT_AGGS}, GROUPING(drift_type) AS g
      FROM labelled_batch GROUP BY GROUPING SETS ((batch), (batch, drift_type))) x
GROUP BY ALL""".replace("GROUPING(drift_type) = 0", "g = 0"))

oracle("drift_delta", f"""
WITH {S.VIEWS['labelled_batch']},
b AS (SELECT batch, {_DRIFT_AGGS} FROM labelled_batch GROUP BY batch),
l AS (SELECT batch, 'accuracy' AS metric, accuracy AS value FROM b
      UNION ALL SELECT batch, 'mean_confidence', mean_confidence FROM b
      UNION ALL SELECT batch, 'low_confidence_rate', low_confidence_rate FROM b),
p AS (SELECT metric, max(value) FILTER (WHERE batch = 'baseline') AS baseline,
        max(value) FILTER (WHERE batch = 'drifted') AS drifted FROM l GROUP BY metric)
SELECT metric, round(baseline, 6) AS baseline, round(drifted, 6) AS drifted,
  round(drifted - baseline, 6) AS change FROM p""")

oracle("misclassified", f"""
WITH {S.VIEWS['labelled_batch']}
SELECT id, batch, drift_type, confidence, pred, truth FROM labelled_batch
WHERE confidence IS NOT NULL AND pred <> truth""")

oracle("request_validation", f"""
WITH {S.VIEWS['requests']},
r AS (
  SELECT request_id, {S.light('text')} AS lt,
    CASE WHEN text IS NULL THEN 'Input should be a valid string'
         WHEN length(text) > 5000 THEN 'String should have at most 5000 characters'
         WHEN NOT regexp_matches({S.light('text')}, '[A-Za-z0-9]') THEN 'text must contain at least one letter or digit'
    END AS reject_reason
  FROM requests)
SELECT request_id, reject_reason IS NULL AS accepted, reject_reason,
  CASE WHEN reject_reason IS NULL THEN lt END AS text_light_clean,
  CASE WHEN reject_reason IS NULL THEN {S.word_count('lt')} END AS word_count
FROM r""")

# the streamed count window must end where the batch twin does
ORACLE["monitor_stream"] = ORACLE["monitor_signals"]

# CSV round trip of the reviews: the report must not change
ORACLE["csv_roundtrip_report"] = ORACLE["validation_report_reviews"]
# JSON-lines log round trip: the signals must not change
ORACLE["log_roundtrip_signals"] = ORACLE["monitor_signals"]
# gates pass on the driver tables, so the report is the plain one
ORACLE["gated_validation_report"] = ORACLE["validation_report_reviews"]


# --- sources, caches, gates ----------------------------------------------------------

oracle("pruned_reread", "SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL")
oracle("column_subset", "SELECT event_id, event_type, value FROM events")
oracle("sql_clean_docs", f"""
SELECT doc_id, {S.light('text')} AS text_light_clean, {S.heavy('text')} AS text_heavy_clean FROM documents""")
oracle("labelled_rows", f"""
WITH {S.split_cte()}
SELECT i.review_id AS id, i.review_text AS text, i.label AS truth, 'test' AS batch
FROM ided i JOIN split s ON i.review_id = s.review_id WHERE s.split = 'test'""")
oracle("transformer_vocab", f"""
WITH {S.tfidf_cte(2, 20000, True)}
SELECT term, idx, cf, df, round(idf, 6) AS idf FROM vocab""")
oracle("run_log", f"""
WITH {_CONF}
SELECT model AS run_name, {R6('accuracy', 'macro_f1', 'roc_auc', 'negative_precision', 'negative_recall')} FROM bundle""")
ORACLE["cached_score_metrics"] = ORACLE["metric_bundle"]
ORACLE["split_fallback"] = ORACLE["stratified_split"]
oracle("expected_counts", f"""
WITH {S.split_cte()}
SELECT split, count(*) AS n FROM split GROUP BY split""")
oracle("extended_training", f"""
WITH {S.cleaned_cte('reviews', 'base')},
{S.VIEWS['dirty_reviews']},
extended AS (SELECT review_key, review_text, rating FROM base
             UNION ALL SELECT review_key + 1000000000, review_text, rating FROM dirty_reviews),
{S.cleaned_body('extended', 'cleaned')}
SELECT * FROM cleaned""")
# the increment must end where cleaning everything again ends
ORACLE["extended_store"] = ORACLE["extended_training"]
oracle("colocated_join", f"""
WITH {S.tfidf_cte(2, 20000, True)},
t AS (SELECT review_id, count(*) AS n_terms, round(sum(weight), 6) AS weight FROM weights GROUP BY review_id)
SELECT d.review_id, d.label, d.split, t.n_terms, t.weight FROM docs d JOIN t ON d.review_id = t.review_id""")
oracle("csv_keep_first", f"""
WITH kept AS (SELECT doc_id, text FROM documents WHERE text NOT IN ({", ".join(f"'{t}'" for t in NA_TOKENS)})),
rows_of AS (SELECT 0 AS f, doc_id, text, 5 AS rating FROM kept WHERE doc_id IN (SELECT doc_id FROM labels)
            UNION ALL SELECT 1, doc_id, text, 1 FROM kept),
firsts AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY f, doc_id) AS rn FROM rows_of)
SELECT md5(text) AS digest, CAST(rating AS DOUBLE) AS rating FROM firsts WHERE rn = 1""")
oracle("nullable_fingerprint", f"""
WITH {S.VIEWS['dirty_reviews']},
swapped AS (SELECT review_text AS a, CAST(NULL AS VARCHAR) AS b FROM dirty_reviews
            UNION ALL SELECT NULL, review_text FROM dirty_reviews)
SELECT 'as given' AS side, {_fp(['a', 'b'])} FROM swapped
UNION ALL SELECT 'first', {_fp(['a', 'b'])} FROM swapped WHERE a IS NOT NULL
UNION ALL SELECT 'second', {_fp(['a', 'b'])} FROM swapped WHERE b IS NOT NULL""")
oracle("stored_order", f"""
WITH {S.split_cte()}
SELECT split, count(*) AS n, 0::BIGINT AS out_of_order FROM split GROUP BY split""")

# --- model half: what SQL knows without the solver ---------------------------------------

oracle("class_weights", f"""
WITH {S.docs_cte()},
c AS (SELECT label, count(*) AS n FROM train GROUP BY label)
SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM c""")
_DIMS = "CAST(least(600, (SELECT count(*) FROM vocab)) AS INTEGER)"
oracle("store_shape", f"""
WITH {S.tfidf_cte(2, 20000, True)}
SELECT review_id, label, {S.word_count('review_text')} AS text_length, split, {_DIMS} AS n_features FROM docs""")
oracle("store_manifest", f"""
WITH {S.tfidf_cte(2, 20000, True)}
SELECT {_DIMS} AS n_features, {_DIMS} AS n_names, 20000 AS tfidf_max_features, true AS tfidf_sublinear_tf,
  42 AS random_state, (SELECT count(*) FROM docs WHERE split = 'train') AS train_rows,
  (SELECT count(*) FROM docs WHERE split = 'test') AS test_rows""")
oracle("store_conformance", "SELECT true AS sizes_ok, true AS rows_ok")
oracle("svd_energy", """
SELECT max(len(embedding)) AS dims, round(sqrt(sum(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x)))), 4)
  AS frobenius, 0 AS off_unit FROM embeddings""")
oracle("lr_optimum", f"""
WITH {S.docs_cte()}
SELECT count(*) AS n_train, 0.5::DOUBLE AS weighted_mean FROM train""")
oracle("serving_parity", f"""
WITH {S.split_cte()}
SELECT count(*) AS n_test, count(*) AS n_equal FROM split WHERE split = 'test'""")
oracle("scoring_verdicts", f"""
WITH {S.VIEWS['requests']},
r AS (SELECT request_id, CASE WHEN text IS NULL THEN 'Input should be a valid string'
         WHEN length(text) > 5000 THEN 'String should have at most 5000 characters'
         WHEN NOT regexp_matches({S.light('text')}, '[A-Za-z0-9]') THEN 'text must contain at least one letter or digit'
    END AS reject_reason FROM requests)
SELECT request_id, reject_reason IS NULL AS accepted, reject_reason FROM r""")
oracle("drift_counts", f"""
WITH {S.split_cte()},
test AS (SELECT i.review_id, i.review_text FROM ided i JOIN split s ON i.review_id = s.review_id WHERE s.split = 'test'),
b AS (SELECT 'baseline' AS batch, review_text AS t FROM (
        SELECT * FROM test ORDER BY md5(concat('42', ':', CAST(review_id AS VARCHAR))), review_id LIMIT 200)
      UNION ALL SELECT 'drifted', concat('<br />', review_text, ' <b>x</b>') FROM test),
v AS (SELECT batch, length(t) <= 5000 AND regexp_matches({S.light('t')}, '[A-Za-z0-9]') AS ok FROM b)
SELECT batch, count(*) AS n, count(*) FILTER (WHERE ok) AS scored, count(*) FILTER (WHERE NOT ok) AS rejected
FROM v GROUP BY batch""")

# --- model half without a solver: given coefficients through the serving artifact --------

_FIXED = f"""{S.tfidf_cte(1, 5000, False)},
margin AS (SELECT review_id, sum(weight * (((idx * 37) % 101 - 50) / 10.0::DOUBLE)) AS m FROM weights GROUP BY review_id),
fixed AS (SELECT d.review_id, d.review_text, d.label, 1 / (1 + exp(-(coalesce(g.m, 0) + 0.25::DOUBLE))) AS p
          FROM docs d LEFT JOIN margin g ON d.review_id = g.review_id WHERE d.split = 'test')"""
oracle("fixed_scores", f"""
WITH {_FIXED},
scored AS (SELECT review_id AS id, 'fixed' AS model, round(1 - p, 9) AS prob_neg, label FROM fixed),{_BUNDLE}
SELECT model AS run_name, n, {R6('accuracy', 'macro_f1', 'roc_auc', 'negative_precision', 'negative_recall')} FROM bundle""")
oracle("fixed_drift", f"""
WITH {_FIXED},
sent AS (SELECT 'baseline' AS batch, review_text AS t, p, label FROM (
           SELECT * FROM fixed ORDER BY md5(concat('42', ':', CAST(review_id AS VARCHAR))), review_id LIMIT 200)
         UNION ALL SELECT 'drifted', concat('<br />', review_text, ' <b>x</b>'), p, label FROM fixed),
judged AS (SELECT batch, label AS truth, CAST(p > 0.5 AS INTEGER) AS pred,
             CASE WHEN length(t) <= 5000 AND regexp_matches({S.light('t')}, '[A-Za-z0-9]') THEN round(greatest(p, 1 - p), 4) END AS confidence
           FROM sent),
d AS (SELECT batch, {_DRIFT_AGGS} FROM judged GROUP BY batch),
l AS (SELECT batch, unnest(['accuracy', 'mean_confidence', 'low_confidence_rate']) AS metric,
        unnest([accuracy, mean_confidence, low_confidence_rate]) AS value FROM d),
w AS (SELECT metric, max(value) FILTER (WHERE batch = 'baseline') AS baseline,
        max(value) FILTER (WHERE batch = 'drifted') AS drifted FROM l GROUP BY metric)
SELECT metric, round(baseline, 6) AS baseline, round(drifted, 6) AS drifted, round(drifted - baseline, 6) AS change FROM w""")
oracle("store_types", f"""
WITH {S.split_cte()}
SELECT 'array<float>' AS feature_type, count(*) AS n, 0::BIGINT AS off_columns FROM split""")
oracle("log_clock", f"""
WITH {S.VIEWS['requests']}
SELECT count(*) AS n, count(*) AS in_utc, count(*) AS in_time FROM requests""")
oracle("controlled_counts", f"""
WITH {S.docs_cte()},
t AS (SELECT count(*) AS n FROM docs WHERE split = 'test')
SELECT unnest(['balanced', 'unweighted']) AS run_name, n, 2::BIGINT AS n_runs, true AS ranked FROM t""")
oracle("ablation_counts", f"""
WITH {S.split_cte()}
SELECT unnest(['base', 'sublinear', 'dims-600', 'terms-50k', 'penalty-quarter']) AS run_name, n, true AS delta_ok
FROM (SELECT count(*) AS n FROM split WHERE split = 'test')""")
oracle("svd_truncated", """
WITH s AS (SELECT pow(0.5::DOUBLE, c_nationkey) * sqrt(count(*)) AS v FROM customer GROUP BY c_nationkey)
SELECT CAST(row_number() OVER (ORDER BY v DESC) AS INTEGER) AS rank, round(v, 6) AS singular_value
FROM (SELECT v FROM s ORDER BY v DESC LIMIT 8)""")
