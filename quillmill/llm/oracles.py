"""SQL for the corpus queries that SQL can express. Each states the result directly, by another way than the operator's."""

from __future__ import annotations

_WS = r"[^\x20\x09-\x0D]"

#: Host verdicts by the same shrinkage, on counts made by unnesting words and lines.
OP3 = rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WS}+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{_WS}')) AS l FROM w),
m AS (SELECT w.doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2, 10 * n_symbols > n_words AS f3, 10 * n_dup_lines > 3 * n_lines AS f4, word_chars < 2 * n_words OR word_chars > 20 * n_words AS f5 FROM m),
h AS (SELECT source, k, count(*)::DOUBLE AS n, sum(v::INT)::DOUBLE AS f FROM (SELECT source, unnest([1, 2, 3, 4, 5]) AS k, unnest([f1, f2, f3, f4, f5]) AS v FROM f) GROUP BY source, k),
t AS (SELECT k, count(*) AS hosts, sum(n) AS n, sum(n * n) AS n2, sum(f) AS f, sum(f * f / n) AS q, (sum(f) + 0.5::DOUBLE) / (sum(n) + 1) AS mean FROM h GROUP BY k),
b AS (SELECT k, mean, CASE WHEN n - n2 / n > 0 THEN greatest((q - 2 * mean * f + mean * mean * n - (hosts - 1) * mean * (1 - mean)) / (n - n2 / n), 0) ELSE 0 END AS btw FROM t),
p AS (SELECT k, mean, CASE WHEN btw > 0 THEN least(greatest(mean * (1 - mean) / btw - 1, 2), 1000) ELSE 1000 END AS size FROM b),
r AS (SELECT source, max((f + mean * size) / (n + size)) AS host_rate FROM h JOIN p USING (k) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed, NOT (f1 OR f2) AND host_rate <= 0.5 AS kept, round(host_rate, 9) AS host_rate
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source
"""

OP10 = r"""
WITH l AS (SELECT doc_id, i, x, translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(generate_series(1, len(s))) AS i, unnest(s) AS x FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
r AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (keeper IS NOT NULL AND keeper <> doc_id)::BIGINT AS n_dropped, sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM l LEFT JOIN r USING (k) GROUP BY doc_id
"""

ORACLES = {"op3_quality_rules": OP3, "op10_line_dedup": OP10}
