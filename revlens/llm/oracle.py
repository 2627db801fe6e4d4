"""DuckDB twins of the training-data queries that SQL can express.

Written independently of the operators: plain n-gram tables, all-pairs overlaps and a
recursive closure, exact strings instead of hashes. The rest (compressed sizes, fitted
models, Newton iterations, mined rules, page alignment) is tested against brute force.
"""

from __future__ import annotations

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x20\x09-\x0D]+"
_TERMS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM
      (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE c > 1) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS u FROM
      (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '{_WORDS}') GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(l.n, 0) AS n_lines,
             coalesce(l.n - l.u, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper
      FROM d LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
b AS (SELECT *, (n_words < 50) AS f0, (100 * n_repeat_words > 50 * n_words) AS f1,
             (100 * n_symbols > 30 * n_words) AS f2, (100 * n_dup_lines > 30 * n_lines) AS f3,
             (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 14 * n_words)) AS f4,
             (100 * n_upper > 30 * word_chars) AS f5 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f0 OR f1) AS base_failed,
       NOT (f0 OR f1 OR f2 OR f5) AS kept,
       f0::BIGINT + 2 * f1::BIGINT + 4 * f2::BIGINT + 8 * f3::BIGINT + 16 * f4::BIGINT + 32 * f5::BIGINT AS rule_bits
FROM b
"""

_LINES = r"""
WITH p AS (SELECT DISTINCT source, text FROM documents WHERE source IS NOT NULL AND text IS NOT NULL),
tot AS (SELECT source, count(*) AS n_pages FROM p GROUP BY source),
c AS (SELECT source, line, count(*) AS n FROM
      (SELECT DISTINCT source, text, unnest(string_split(text, chr(10))) AS line FROM p)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY source, line),
b AS (SELECT source, line FROM c JOIN tot USING (source) WHERE n_pages >= 10 AND n > 0.1::DOUBLE * n_pages),
x AS (SELECT doc_id, source, i, u[i] AS line FROM
      (SELECT doc_id, source, string_split(text, chr(10)) AS u,
              unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
k AS (SELECT x.doc_id, count(*) AS n_lines, count(b.line) AS n_dropped,
             coalesce(string_agg(x.line, chr(10) ORDER BY i) FILTER (WHERE b.line IS NULL), '') AS t
      FROM x LEFT JOIN b ON x.source = b.source AND x.line = b.line GROUP BY x.doc_id)
SELECT d.doc_id, d.source, k.t AS text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN k USING (doc_id)
"""

_JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_WORDS}') AS w
                     FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) >= 3
               THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, t.b FROM reach JOIN both_ways t ON reach.b = t.a),
least_id AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""

_DECON = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_TERMS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_TERMS}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, z, array_to_string(w[i:i + z - 1], ' ') AS g FROM
        (SELECT item_id, w, least(13, len(w)) AS z, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
         FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT z FROM win),
dw AS (SELECT doc_id, i, z, array_to_string(w[i:i + z - 1], ' ') AS g FROM
       (SELECT doc_id, w, z, unnest(range(1, len(w) - z + 2)) AS i FROM d, sizes)),
hit AS (SELECT dw.doc_id, dw.i, dw.z, win.item_id FROM dw JOIN win ON dw.g = win.g AND dw.z = win.z),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + z)) AS p FROM hit)
        GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n, string_agg(t, ',' ORDER BY t) AS t
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS t FROM hit) GROUP BY doc_id),
tok AS (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS p FROM d),
cf AS (SELECT t, count(*) AS c FROM tok WHERE t IN (SELECT unnest(w) FROM b) GROUP BY t),
bw AS (SELECT item_id, w, z, i, unnest(w[i:i + z - 1]) AS t, unnest(range(z)) AS o FROM
       (SELECT item_id, w, least(13, len(w)) AS z, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
wt AS (SELECT item_id, w, z, i, t, min(o) AS o, count(*) AS k, min(c) AS c FROM bw JOIN cf USING (t) GROUP BY item_id, w, z, i, t),
rk AS (SELECT *, sum(k) OVER s AS present, row_number() OVER (s ORDER BY c, o) AS r FROM wt
       WINDOW s AS (PARTITION BY item_id, w, i)),
sets AS (SELECT DISTINCT item_id, l[1] AS t1, l[least(2, len(l))] AS t2, l[least(3, len(l))] AS t3 FROM
         (SELECT item_id, list(t ORDER BY t) AS l FROM
          (SELECT item_id, w, i, t, r FROM rk
           QUALIFY sum(k) OVER (PARTITION BY item_id, w, i) = z) WHERE r <= 3 GROUP BY item_id, w, i)),
place AS (SELECT doc_id, t, p FROM tok WHERE t IN (SELECT t1 FROM sets UNION SELECT t2 FROM sets UNION SELECT t3 FROM sets)),
near AS (SELECT x.doc_id, count(DISTINCT s.item_id) AS n FROM sets s JOIN place x ON x.t = s.t1
         JOIN place y ON y.doc_id = x.doc_id AND y.t = s.t2 AND abs(y.p - x.p) < 20
         JOIN place q ON q.doc_id = x.doc_id AND q.t = s.t3 AND abs(q.p - x.p) < 20 AND abs(q.p - y.p) < 20
         GROUP BY x.doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
       sha256(coalesce(ids.t, '')) AS items_sha256,
       coalesce(pos.n, 0) > 0 AND 20 * coalesce(pos.n, 0) >= len(w) AS contaminated, coalesce(near.n, 0) AS n_near
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id) LEFT JOIN near USING (doc_id)
"""

def _codes() -> str:
    """Four rounds of assignment and replacement, unrolled; distances as plain sums."""
    floor = "(s - ((s % n) + n) % n) // n"
    near = """SELECT vec_id, label, p, v, first(e ORDER BY far, e) AS e, min(far) AS far FROM
        (SELECT x.vec_id, x.label, x.p, x.v, b.e,
                list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far
         FROM x JOIN {book} b USING (p)) GROUP BY vec_id, label, p, v"""
    parts = """WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
x AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS v
                   FROM k, (SELECT unnest(range(4)) AS p)),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v
                    FROM x QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 256)"""
    for r in range(4):
        parts += f""",
a{r} AS MATERIALIZED ({near.format(book=f"b{r}")}),
u{r} AS (SELECT p, e, list({floor} ORDER BY i) AS v FROM
         (SELECT p, e, i, sum(v[i])::BIGINT AS s, count(*) AS n
          FROM (SELECT p, e, v, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY p, e, i) GROUP BY p, e),
b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(u{r}.v, b{r}.v) AS v FROM b{r} LEFT JOIN u{r} USING (p, e))"""
    return parts + f""",
f AS MATERIALIZED ({near.format(book="b4")}),
c AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(far)::BIGINT AS error
      FROM f GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM b4) AS codebooks_sha256
FROM c
"""


_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
                  regexp_extract_all(coalesce(text, ''), '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS u
           FROM documents),
g AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
                  THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, array_to_string(u[1:lo], '') AS a, array_to_string(u[lo + 1:hi], '') AS b,
             array_to_string(u[hi + 1:n], '') AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b
                        ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

ORACLE: dict[str, str] = {
    "op2_quality_rules": _QUALITY,
    "op7_line_dedup": _LINES,
    "op9_ngram_join": _JACCARD,
    "op10_decontamination": _DECON,
    "op12_vector_codes": _codes(),
    "op13_fill_middle": _MIDDLE,
}
