"""DuckDB SQL for the queries that SQL can express.

Personal data, toxicity, language and approximate neighbours rest on fitted models or on
chance, packing and token counts on a tokenizer, and the edit distance of DuckDB counts
bytes: those queries have none and are tested against plain versions.
"""

from __future__ import annotations

from tripstar.llm.line_quality import MENU_WORDS, NOTICES, SHORT_LINE
from tripstar.llm.mixing import SEED

_MENU = ", ".join(f"'{w}'" for w in MENU_WORDS)
_NOTICE = " OR ".join(f"contains(lower(trim(x)), '{p}')" for p in NOTICES)

OP2 = f"""
WITH d AS (
  SELECT doc_id, source, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, ([5, 2, 1])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight FROM s),
r AS (
  SELECT *, 2.0 * source_size / weight AS ratio,
    row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS k FROM w),
l AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * (SELECT sum(source_size) FROM s)
      - coalesce(sum(2 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM r),
f AS (SELECT share, k FROM l WHERE NOT 2 * source_size < weight * share ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size,
    CASE WHEN l.k < f.k THEN CAST(2 * source_size AS DOUBLE) ELSE CAST(weight * f.share AS DOUBLE) END AS target
  FROM l, f),
b AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS quota,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, least(quota, source_size) - before))
    + greatest(0, least(size, least(quota - source_size, source_size) - before)) AS BIGINT) AS taken
FROM b
"""

OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
i AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS k FROM m WHERE len(w) >= 3),
g AS (SELECT rid, k, count(*) OVER (PARTITION BY rid, w[k], w[k + 1], w[k + 2]) AS n FROM i),
c AS (SELECT rid, count(DISTINCT k) AS n FROM (
  SELECT rid, unnest([k, k + 1, k + 2]) AS k FROM g WHERE n > 1) GROUP BY rid),
p AS (
  SELECT m.*, coalesce(c.n, 0) AS n_repeat, list_filter(lines, lambda x:
      regexp_matches(x, '[.!?…:;]["''»”)\\]]*[\\x20\\x09-\\x0D]*\\z')
      AND NOT (length(x) - length(replace(x, '!!', ''))) / 2 * 20 > length(x)
      AND NOT (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g'))) * 20 > length(x)
      AND NOT (length(x) <= {SHORT_LINE} AND (
        length(x) - length(replace(x, '|', '')) >= 2 OR contains(lower(trim(x)), ' » ')
        OR lower(trim(x)) IN ({_MENU}) OR {_NOTICE}))) AS passed
  FROM m LEFT JOIN c USING (rid)),
v AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(n_repeat AS BIGINT) AS n_repeat_words,
    CAST(coalesce(CAST(length(array_to_string(passed, '')) AS DOUBLE)
      / nullif(length(array_to_string(lines, '')), 0), 0) AS DOUBLE) AS kept_share
  FROM p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND kept_share >= 0.5) AS kept, kept_share
FROM v
"""

OP8 = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS own
  FROM d),
n AS (SELECT doc_id, CAST(len(own) AS BIGINT) AS n FROM s),
x AS (SELECT doc_id, unnest(own) AS g FROM s),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
e AS (
  SELECT u, v FROM p JOIN n nu ON u = nu.doc_id JOIN n nv ON v = nv.doc_id
  WHERE 100 * c >= 90 * (nu.n + nv.n - c)),
twoway AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
reach AS (
  SELECT u AS a, v AS b FROM twoway
  UNION
  SELECT reach.a, twoway.v FROM reach JOIN twoway ON reach.b = twoway.u)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(reach.b), n.doc_id)) AS component_id
FROM n LEFT JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n
"""

OP11 = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
  s.other_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) <= 3
"""

_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP13 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') AS t FROM documents),
e AS (SELECT doc_id, CAST(len(t) AS BIGINT) AS n, t FROM d WHERE len(t) > 0),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM e),
i AS (
  SELECT item_id, term, count(*) AS qtf FROM (
    SELECT item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')) AS term FROM benchmark)
  GROUP BY item_id, term),
p AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM e)
  WHERE term IN (SELECT term FROM i) GROUP BY doc_id, n, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM p, c GROUP BY term, docs),
s AS (
  SELECT item_id, doc_id, CAST(sum(qtf * w
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM p JOIN w USING (term) JOIN i USING (term), c GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

CHECKS: dict[str, str] = {
    "op2_mix_sources": OP2,
    "op4_line_quality": OP4,
    "op8_ngram_jaccard_join": OP8,
    "op11_hard_negatives": OP11,
    "op13_lexical_search": OP13,
}
