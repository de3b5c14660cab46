"""All queries of the library's own operators, and SQL that says what they should give without using them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.functions import cells as cell_functions
from quillmill.functions import text as text_functions
from quillmill.functions.detect import is_axis, is_collapsed, is_date_only, is_multi_space, is_spaced, spacing_badness
from quillmill.functions.regex import let
from quillmill.operators import audit, glyphs, markdown, pictures, quality, select, tables
from quillmill.plans import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_W = r"[\p{L}\p{N}_]"
_STRIP = "' ' || chr(9) || chr(10) || chr(13)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = views.duck(sql)
        return f

    return add


def _docs(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- quality, detectors ----------------------------------------------------------------------------


def _score(texts: str) -> str:
    """SQL for the report of texts (doc_id, text)."""
    return f"""
WITH d AS ({texts}), l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS x FROM d),
r AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, lower(x) AS y FROM l WHERE length(x) >= 6 AND NOT starts_with(x, '#') AND NOT starts_with(x, '<!-- image') AND NOT starts_with(x, '<!-- page break') GROUP BY doc_id, y HAVING count(*) >= 3) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n FROM l WHERE length(replace(x, ' ', '')) <= 4 AND regexp_matches(x, '\\p{{L}}') GROUP BY doc_id)
SELECT d.doc_id, greatest(100 - 5 * coalesce(s.n, 0) - 2 * coalesce(r.n, 0) - c.n, 0)::BIGINT AS score, coalesce(s.n, 0)::BIGINT AS short_line_count, coalesce(r.n, 0)::BIGINT AS repeated_line_count, c.n::BIGINT AS control_char_count
FROM d JOIN (SELECT doc_id, len(regexp_extract_all(text, '[\\x00-\\x08\\x0b-\\x1f]')) AS n FROM d) c USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN s USING (doc_id)
"""


@query(_score("SELECT doc_id, text FROM documents"))
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_docs(spark, sf_dir).select("doc_id", "text"))


_LINES = "SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


_SPACED = rf"""
WITH t AS (SELECT doc_id, line_no, line, regexp_extract_all(line, '{_W}+|\s+|[^\p{{L}}\p{{N}}_\s]+') AS k, regexp_extract_all(line, '\S+') AS w FROM ({_LINES})),
p AS (SELECT *, list_transform(generate_series(1, len(k)), lambda i: regexp_full_match(k[i], '{_W}')) AS one, list_transform(generate_series(1, len(k)), lambda i: regexp_full_match(k[i], '\s+')) AS gap,
  list_transform(generate_series(1, len(k)), lambda i: regexp_full_match(k[i], '\p{{L}}') AND k[i] NOT IN ('a', 'A', 'I', 'i', 'o', 'O')) AS rare,
  list_transform(generate_series(1, len(k)), lambda i: regexp_full_match(k[i], '{_W}{{2,}}')) AS word FROM t),
q AS (SELECT *, list_bool_or(list_transform(generate_series(1, len(k) - 6), lambda i: regexp_full_match(k[i], '\d') AND regexp_full_match(k[i + 2], '\d') AND regexp_full_match(k[i + 4], '\d') AND regexp_full_match(k[i + 6], '\d') AND gap[i + 1] AND gap[i + 3] AND gap[i + 5])) AS r1,
  regexp_matches(line, '\d[.,/]\s+\d|\d\s+[.,/]\s*\d') AS r2, list_bool_or(list_transform(generate_series(1, len(k) - 2), lambda i: one[i] AND one[i + 2] AND gap[i + 1] AND (rare[i] OR rare[i + 2]))) AS r3,
  list_filter(generate_series(1, len(k) - 4), lambda i: word[i] AND one[i + 2] AND word[i + 4] AND gap[i + 1] AND gap[i + 3]) AS mid,
  len(list_filter(w, lambda x: regexp_full_match(x, '[\p{{L}}\p{{N}}]'))) AS n1, len(list_filter(w, lambda x: regexp_full_match(x, '\p{{L}}') AND x NOT IN ('a', 'A', 'I', 'i', 'o', 'O'))) AS nr FROM p),
z AS (SELECT doc_id, line_no, line, coalesce(r1, false) OR r2 OR coalesce(r3, false) OR length(line) >= 6 AND (len(list_filter(mid, lambda i: rare[i + 2])) > 0 OR len(w) >= 4 AND (2 * n1 >= len(w) OR len(mid) > 0 AND (nr >= 2 OR n1 > 0 AND 2 * nr >= n1))) AS spaced FROM q)
"""


@query(_SPACED + r"""SELECT doc_id, count(*) FILTER (spaced)::BIGINT AS spaced, count(*) FILTER (regexp_matches(line, '\S[ \t][ \t]+\S'))::BIGINT AS multi_space, count(*)::BIGINT AS n FROM z GROUP BY doc_id""")
def spacing_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.transform(F.split("text", "\n"), lambda x: F.struct(is_spaced(x).alias("spaced"), is_multi_space(x).alias("multi_space")))
    n = lambda flag: F.size(F.filter("flags", lambda x: x[flag])).cast("long").alias(flag)
    return _docs(spark, sf_dir).select("doc_id", flags.alias("flags")).select("doc_id", n("spaced"), n("multi_space"), F.size("flags").cast("long").alias("n"))


_COLLAPSED = rf"""
WITH t AS (SELECT doc_id, line_no, line, list_transform(regexp_extract_all(line, '{_W}+'), lambda x: length(x)) AS n FROM ({_LINES}))
SELECT doc_id, line_no::BIGINT AS line_no, regexp_matches(line, '[\p{{L}}\p{{Nl}}\p{{No}}]{{20}}') OR regexp_matches(line, '[\p{{L}}\p{{Nl}}\p{{No}}]{{6}}\p{{Nd}}{{2,}}[\p{{L}}\p{{Nl}}\p{{No}}]{{2}}|\p{{Nd}}{{2}}[\p{{L}}\p{{Nl}}\p{{No}}]{{6}}')
  OR length(line) >= 60 AND len(n) >= 8 AND (list_avg(n) >= 9 OR len(list_filter(n, lambda x: x >= 18)) >= 2 OR length(line) > 120 AND length(line) - length(replace(line, ' ', '')) < 0.05 * length(line)) AS collapsed
FROM t
"""


@query(_COLLAPSED)
def collapsed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("doc_id", "line_no", is_collapsed(F.col("line")).alias("collapsed"))


@query(
    _SPACED
    + rf"""
, b AS (SELECT doc_id, line, spaced, list_transform(regexp_extract_all(line, '{_W}+'), lambda x: length(x)) AS n FROM z)
SELECT doc_id, round(sum(CASE WHEN len(n) = 0 THEN 0 ELSE greatest(list_sum(n)::DOUBLE / len(n) - 6, 0) + 1.5::DOUBLE * len(list_filter(n, lambda x: x >= 18)) + CASE WHEN regexp_matches(line, '[\p{{L}}\p{{Nl}}\p{{No}}]{{20}}') THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(line, '[\p{{L}}\p{{Nl}}\p{{No}}]{{6}}\p{{Nd}}{{2,}}[\p{{L}}\p{{Nl}}\p{{No}}]{{2}}|\p{{Nd}}{{2}}[\p{{L}}\p{{Nl}}\p{{No}}]{{6}}') THEN 3 ELSE 0 END + CASE WHEN spaced THEN 4 ELSE 0 END END), 6) AS badness FROM b GROUP BY doc_id
"""
)
def spacing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = F.transform(F.split("text", "\n"), spacing_badness)
    return _docs(spark, sf_dir).select("doc_id", F.round(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), 6).alias("badness"))


# --- texts -----------------------------------------------------------------------------------------


@query("SELECT doc_id, text || ' A/B' AS text FROM documents")
def whitespace_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.concat(F.replace(F.replace("text", F.lit(", "), F.lit(",  ")), F.lit(" de "), F.lit(" \t de ")), F.lit(" A B"))
    return _docs(spark, sf_dir).select("doc_id", text_functions.normalize_whitespace(noisy).alias("text"))


@query("SELECT doc_id, text FROM documents")
def ligature_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.replace(F.replace("text", F.lit("fi"), F.lit("ﬁ")), F.lit("ff"), F.lit("ﬀ"))
    return _docs(spark, sf_dir).select("doc_id", text_functions.normalize_ligatures(noisy).alias("text"))


@query(f"SELECT doc_id, CASE WHEN regexp_matches(good, '[^\\x00-\\x7făâîșțĂÂÎȘȚ]') OR length(good) < greatest(4, floor(length(broken) * 0.9::DOUBLE)) THEN broken ELSE good END AS text FROM ({views.BROKEN_TEXTS})")
def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts; one with a character that Windows-1252 lacks, or that makes no valid UTF-8, or that would lose a tenth of its length, stays broken."""
    return views.of(spark, sf_dir, views.BROKEN_TEXTS).select("doc_id", text_functions.normalize_mojibake(F.col("broken")).alias("text"))


# --- audits ----------------------------------------------------------------------------------------

_ENTRIES = rf"""
  SELECT doc_id, page_no, 't' AS kind, trim(replace(lower(x), 'ß', 'ss'), '_') AS x, side FROM (SELECT doc_id, page_no, side, unnest(regexp_extract_all(text, '{_W}+')) AS x FROM s)
  UNION ALL SELECT DISTINCT doc_id, page_no, 'n', CASE WHEN contains(y, ',') AND contains(y, '.') THEN CASE WHEN regexp_matches(y, ',[^.]*$') THEN replace(replace(y, '.', ''), ',', '.') ELSE replace(y, ',', '') END
      WHEN length(y) - length(replace(y, ',', '')) = 1 AND NOT contains(y, '.') THEN replace(replace(y, ',', '.'), ' ', '') ELSE replace(y, ' ', '') END || CASE WHEN ends_with(x, '%') THEN '%' ELSE '' END, side
    FROM (SELECT *, rtrim(x, '%') AS y FROM (SELECT doc_id, page_no, side, unnest(regexp_extract_all(text, '(?:^|[^\p{{L}}\p{{N}}_])([+-]?(?:\p{{Nd}}{{1,3}}(?:[ .]\p{{Nd}}{{3}})+|\p{{Nd}}+)(?:[.,]\p{{Nd}}+)?%?)', 1)) AS x FROM s))
  UNION ALL SELECT DISTINCT doc_id, page_no, 'd', x, side FROM (SELECT doc_id, page_no, side, unnest(regexp_extract_all(text, '(?:^|[^\p{{L}}\p{{N}}_])(\p{{Nd}}{{1,2}}[./-]\p{{Nd}}{{1,2}}[./-]\p{{Nd}}{{2,4}})(?:$|[^\p{{L}}\p{{N}}_])', 1)) AS x FROM s)
"""
_SHARES = """
  SELECT doc_id, page_no, coalesce(avg(hit) FILTER (kind = 't'), 1.0) AS token_coverage, coalesce(avg(hit) FILTER (kind = 'n'), 1.0) AS numeric_recall, coalesce(avg(hit) FILTER (kind = 'd'), 1.0) AS date_recall
  FROM (SELECT s.doc_id, s.page_no, e.kind, CASE WHEN c.x IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS hit FROM (SELECT DISTINCT doc_id, page_no FROM s WHERE side = 'r') s LEFT JOIN (SELECT * FROM e WHERE side = 'r') e USING (doc_id, page_no) LEFT JOIN (SELECT DISTINCT doc_id, page_no, kind, x FROM e WHERE side = 'c') c USING (doc_id, page_no, kind, x)) GROUP BY doc_id, page_no
"""


@query(f"""
WITH s AS (SELECT doc_id, 0 AS page_no, 'r' AS side, text || ' 1.234,5 and 12% on 31.12.2024' AS text FROM documents UNION ALL SELECT doc_id, 0, 'c', substr(text, 1, cast(floor(n_chars * 0.8) AS INT)) || ' 1234.5' FROM documents),
e AS ({_ENTRIES}) SELECT doc_id, token_coverage, numeric_recall, date_recall FROM ({_SHARES})
""")
def audit_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    return audit.recall(d.select("doc_id", F.concat("text", F.lit(" 1.234,5 and 12% on 31.12.2024")).alias("reference"), F.concat(F.expr("substr(text, 1, cast(floor(n_chars * 0.8) AS int))"), F.lit(" 1234.5")).alias("candidate")), "doc_id")


@query(f"""
WITH m AS (SELECT doc_id, CASE WHEN contains(markdown, '{views.BREAK}') THEN list_filter(list_transform(string_split(markdown, '{views.BREAK}'), lambda x: trim(x, {_STRIP})), lambda x: x <> '') ELSE [markdown] END AS p FROM ({views.RENDERED})),
r AS (SELECT doc_id, page_no, text, row_number() OVER (PARTITION BY doc_id ORDER BY page_no) AS k FROM ({views.PAGES})),
z AS (SELECT r.doc_id, r.page_no, r.text, coalesce(m.p[r.k], '') AS md FROM r JOIN m USING (doc_id)),
s AS (SELECT doc_id, page_no, 'r' AS side, text FROM z UNION ALL SELECT doc_id, page_no, 'c', md FROM z), e AS ({_ENTRIES})
SELECT doc_id, page_no, token_coverage, numeric_recall, date_recall, length(text)::BIGINT AS pdf_text_length, length(md)::BIGINT AS md_text_length FROM ({_SHARES}) JOIN z USING (doc_id, page_no) ORDER BY token_coverage, doc_id, page_no LIMIT 100
""")
def page_audit_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.worst_pages(audit.per_page(views.of(spark, sf_dir, views.PAGES), views.of(spark, sf_dir, views.RENDERED)), 100)


def _metrics_sql() -> str:
    structure = f"""SELECT doc_id, markdown, string_split(markdown, chr(10)) AS x FROM ({views.MD})"""
    return f"""
WITH s AS (SELECT doc_id, 0 AS page_no, 'r' AS side, text FROM documents UNION ALL SELECT doc_id, 0, 'c', markdown FROM ({views.MD})), e AS ({_ENTRIES}), a AS ({_SHARES}),
m AS (SELECT doc_id, length(markdown)::BIGINT AS md_text_length, len(list_filter(x, lambda y: starts_with(ltrim(y), '#')))::BIGINT AS heading_count_md,
  len(list_filter(generate_series(2, len(x)), lambda i: starts_with(trim(x[i]), '|') AND contains(x[i], '---') AND contains(x[i - 1], '|')))::BIGINT AS table_count_md FROM ({structure})),
i AS (SELECT l.doc_id, count(*) FILTER (l.line <> '')::BIGINT AS total_text_items, count(*) FILTER (regexp_matches(l.line, '\\S[ \\t][ \\t]+\\S'))::BIGINT AS multi_space_text_items, count(*) FILTER (l.line <> '' AND (l.spaced OR c.collapsed))::BIGINT AS spaced_text_items,
  count(*) FILTER (l.line_no = 0)::BIGINT AS heading_count_pdf FROM ({_SPACED} SELECT * FROM z) l JOIN ({_COLLAPSED}) c USING (doc_id, line_no) GROUP BY l.doc_id),
t AS (SELECT doc_id, count(*)::BIGINT AS table_count_pdf, sum(num_rows * num_cols)::BIGINT AS table_cells_pdf, count(*)::BIGINT AS total_table_cells FROM (SELECT *, num_cols = 2 AND num_rows >= 6 AND doc_id % 2 = 0 AS toc_like FROM ({views.CONTENTS})) WHERE NOT toc_like GROUP BY doc_id)
SELECT d.doc_id, token_coverage, numeric_recall, date_recall, coalesce(table_count_pdf, 0) AS table_count_pdf, table_count_md, coalesce(table_cells_pdf, 0) AS table_cells_pdf, heading_count_pdf, heading_count_md, length(d.text)::BIGINT AS pdf_text_length, md_text_length,
  0::BIGINT AS spaced_table_cells, coalesce(total_table_cells, 0) AS total_table_cells, spaced_text_items, multi_space_text_items, total_text_items
FROM documents d JOIN a USING (doc_id) JOIN m USING (doc_id) JOIN i USING (doc_id) LEFT JOIN t USING (doc_id)"""


@query(_metrics_sql())
def document_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics of each whole text, its lines as items, against a rendering with headings and tables."""
    docs = _docs(spark, sf_dir).select("doc_id", "text").join(views.of(spark, sf_dir, views.MD).select("doc_id", "markdown"), "doc_id")
    items = _lines(spark, sf_dir).select("doc_id", F.lit("text").alias("kind"), F.when(F.col("line_no") == 0, "section_header").otherwise("text").alias("label"), F.col("line").alias("text"))
    v = views.of(spark, sf_dir, views.CONTENTS)
    return audit.document_metrics(docs, items, v.drop("text"), v.select("doc_id", "table_no", F.lit(0).alias("cell_no"), "text"))


# --- Markdown --------------------------------------------------------------------------------------

_PARTS = f"string_split(markdown, '{views.BREAK}')"


@query(f"""
WITH l AS (SELECT doc_id, string_split(markdown, chr(10)) AS x FROM ({views.MD}))
SELECT doc_id, len(list_filter(x, lambda y: starts_with(ltrim(y), '#')))::BIGINT AS headings, len(list_filter(generate_series(2, len(x)), lambda i: starts_with(trim(x[i]), '|') AND contains(x[i], '---') AND contains(x[i - 1], '|')))::BIGINT AS tables,
  (SELECT len(list_filter({_PARTS}, lambda p: trim(p, {_STRIP}) <> '')) FROM ({views.MD}) m WHERE m.doc_id = l.doc_id)::BIGINT AS pages FROM l
""")
def md_structure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    md = views.of(spark, sf_dir, views.MD)
    pages = markdown.split_pages(md).groupBy("doc_id").agg(F.count("*").alias("pages"))
    return md.select("doc_id", markdown.heading_count(F.col("markdown")).alias("headings"), markdown.table_count(F.col("markdown")).alias("tables")).join(pages, "doc_id")


def _marked(head: str, tail: str) -> str:
    return f"""SELECT doc_id, array_to_string(list_transform(p, lambda x, i: '{head}' || i || '{tail}' || chr(10) || chr(10) || x), chr(10) || chr(10) || '{views.BREAK}' || chr(10) || chr(10)) AS markdown
FROM (SELECT doc_id, list_filter(list_transform({_PARTS}, lambda x: trim(x, {_STRIP})), lambda x: x <> '') AS p FROM ({views.MD}))"""


@query(_marked("**[Page ", "]**"))
def page_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.concat(F.lit("<!-- page: 7 -->"), F.replace("markdown", F.lit(views.BREAK), F.lit(f"**[Page 3]**{views.BREAK}[//]: # (page: 12)")))
    return views.of(spark, sf_dir, views.MD).select("doc_id", markdown.add_page_markers(old).alias("markdown"))


@query(_marked("[//]: # (page: ", ")"))
def page_markers_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.of(spark, sf_dir, views.MD).select("doc_id", markdown.add_page_markers(F.col("markdown"), visible=False).alias("markdown"))


_JOIN = f"chr(10) || chr(10) || '{views.BREAK}' || chr(10) || chr(10)"


_SPLIT = "string_split(regexp_replace(p, chr(10) || '$', ''), chr(10))"


@query(f"""
WITH m AS (SELECT doc_id, '## ' || source AS h, {_PARTS} AS parts FROM ({views.MD})),
o AS (SELECT *, list_transform(parts, lambda p: list_contains(string_split(p, chr(10)), h)) AS has FROM m),
t AS (SELECT *, len(parts) > 1 AND len(list_filter(has, lambda x: x)) >= greatest(3, floor(len(parts) * 0.3::DOUBLE + 0.999::DOUBLE)) AS often, list_position(has, true) AS first FROM o)
SELECT doc_id, array_to_string(list_transform(parts, lambda p, i: array_to_string(CASE WHEN often AND i <> first THEN list_filter({_SPLIT}, lambda x: x <> h) ELSE {_SPLIT} END, chr(10))), {_JOIN}) AS markdown FROM t
""")
def repeated_heading_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.reduce_noise(views.of(spark, sf_dir, views.MD).select("doc_id", "markdown"))


@query(rf"""
WITH p AS (SELECT doc_id, unnest({_PARTS}) AS x, generate_subscripts({_PARTS}, 1) AS i FROM ({views.MD})),
y AS (SELECT *, list_filter(list_transform(string_split(x, chr(10)), lambda l: trim(l, {_STRIP})), lambda l: l <> '') AS l FROM p),
e AS (SELECT *, list_filter(l, lambda z: z <> '<!-- image -->')[1] AS first, l[-1] AS last FROM y),
n AS (SELECT *, first_value(first IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM e),
o AS (SELECT *, coalesce(regexp_matches(last, '^#{{1,6}}\s+\S'), false) AND (nxt IS NULL OR regexp_matches(nxt, '^#{{1,6}}\s+\S') AND length(regexp_extract(nxt, '^#+')) <= length(regexp_extract(last, '^#+'))
    OR NOT starts_with(nxt, '#') AND NOT regexp_matches(nxt, '\d') AND length(nxt) <= 120 AND NOT regexp_matches(nxt, '[.!?;:]$') AND len(regexp_extract_all(nxt, '\S+')) >= 3 AND regexp_matches(regexp_extract(nxt, '\p{{L}}'), '\p{{Lu}}')) AS orphan FROM n)
SELECT doc_id, string_agg(CASE WHEN orphan THEN rtrim(regexp_replace(x, '[^\n]*\S[^\n]*\s*$', ''), {_STRIP}) ELSE x END, {_JOIN} ORDER BY i) AS markdown FROM o GROUP BY doc_id
""")
def orphan_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.remove_orphan_headings(views.of(spark, sf_dir, views.MD).select("doc_id", "markdown"))


@query(f"""
SELECT doc_id, array_to_string(list_transform({_PARTS}, lambda p: replace(array_to_string(list_filter(list_transform(regexp_split_to_array(p, '\\n\\n+'), lambda b: trim(b, {_STRIP})), lambda b: b <> ''), chr(10) || chr(10)),
  'ACTIVE CIRCULANTE' || chr(10) || chr(10) || 'RON ' || n_chars || ' MIL.' || chr(10) || chr(10) || '+' || doc_id % 90 || '%', 'ACTIVE CIRCULANTE RON ' || n_chars || ' MIL. +' || doc_id % 90 || '%')), {_JOIN}) AS markdown FROM ({views.MD})
""")
def kpi_block_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.of(spark, sf_dir, views.MD).select("doc_id", markdown.merge_kpi_blocks(F.col("markdown")).alias("markdown"))


_TICKS = "regexp_extract_all(x, '[A-Za-z0-9%]+')"
_WITH_DIGIT = f"len(list_filter({_TICKS}, lambda t: regexp_matches(t, '[0-9]')))"
#: Whether a stripped line x is of axis ticks.
_AXIS = rf"""(length(x) BETWEEN 1 AND 40 AND regexp_full_match(x, '[0-9A-Za-z%./+\-\s]+') AND len({_TICKS}) BETWEEN 1 AND 6 AND {_WITH_DIGIT} > 0
  AND (len(list_filter({_TICKS}, lambda t: NOT regexp_full_match(t, '(?i)[0-9]{{1,4}}%?|Q[1-4]|9L|L9|mil|RON|EUR|USD|LEI'))) = 0 OR {_WITH_DIGIT} >= len({_TICKS}) - 1 AND length(x) <= 20))"""


@query(f"""
WITH l AS (SELECT doc_id, i, unnest({_SPLIT}) AS line, generate_subscripts({_SPLIT}, 1) AS j FROM (SELECT doc_id, unnest({_PARTS}) AS p, generate_subscripts({_PARTS}, 1) AS i FROM ({views.MD}))),
k AS (SELECT doc_id, i, j, line, {_AXIS} AS axis FROM (SELECT *, trim(line, {_STRIP}) AS x FROM l)),
p AS (SELECT doc_id, i, coalesce(string_agg(line, chr(10) ORDER BY j) FILTER (NOT axis), '') AS p FROM k GROUP BY doc_id, i)
SELECT doc_id, string_agg(p, {_JOIN} ORDER BY i) AS markdown FROM p GROUP BY doc_id
""")
def axis_line_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.of(spark, sf_dir, views.MD).select("doc_id", markdown.remove_axis_lines(F.col("markdown")).alias("markdown"))


@query(None)
def markdown_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passes in their order."""
    return markdown.clean(views.of(spark, sf_dir, views.MD).select("doc_id", "markdown"), remove_images=True)


# --- cells and tables ------------------------------------------------------------------------------


@query(f"SELECT doc_id, cell_no, clean AS text FROM ({views.CELLS})")
def cell_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.clean_cells(views.of(spark, sf_dir, views.CELLS)).select("doc_id", "cell_no", "text")


@query(f"SELECT cell_no, clean AS text FROM ({views.HEADERS})")
def header_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.normalize_headers(views.of(spark, sf_dir, views.HEADERS).withColumn("r0", F.lit(0))).select("cell_no", "text")


@query(f"SELECT doc_id, sum(broken)::BIGINT AS suspect_cells FROM ({views.SUSPECTS}) GROUP BY doc_id")
def suspect_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.suspect_cells(views.of(spark, sf_dir, views.SUSPECTS))


@query(f"""
WITH v AS (SELECT *, CASE WHEN r0 <> 0 AND c1 - c0 = 1 THEN substr(text, 1, 3) END AS own FROM ({views.VOTES})),
n AS (SELECT doc_id, c0, count(*) AS n, count(*) FILTER (own = 'RON') AS ron FROM v WHERE own IS NOT NULL GROUP BY doc_id, c0),
w AS (SELECT doc_id, c0, CASE WHEN 2 * ron >= n THEN 'RON' ELSE 'EUR' END AS won FROM n WHERE n >= 2 AND greatest(ron, n - ron) >= 0.7::DOUBLE * n)
SELECT doc_id, cell_no, CASE WHEN own <> won THEN replace(replace(text, 'EUR', won), 'RON', won) ELSE text END AS text FROM v LEFT JOIN w USING (doc_id, c0)
""")
def currency_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.vote_currencies(views.of(spark, sf_dir, views.VOTES)).select("doc_id", "cell_no", "text")


@query(f"""
WITH v AS ({views.SPANS}), g AS (SELECT *, doc_id % 4 <> 0 AS ok, CASE WHEN doc_id % 4 = 0 THEN c0 ELSE (c0 + 1) // 2 END AS n0, CASE WHEN doc_id % 4 = 0 THEN c1 ELSE c1 // 2 + 1 END AS n1 FROM v)
SELECT doc_id, r0::INT AS r0, n0::INT AS c0, n1::INT AS c1, CASE WHEN ok THEN coalesce(string_agg(trim(text), ' ' ORDER BY c0) FILTER (trim(text) <> ''), '') ELSE min(text) END AS text, min(l) AS l, max(r) AS r, min(t) AS t, max(b) AS b, bool_or(column_header) AS column_header, CASE WHEN ok THEN 3 ELSE 5 END::INT AS num_cols
FROM g GROUP BY doc_id, r0, n0, n1, ok
""")
def header_group_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = views.of(spark, sf_dir, views.SPANS)
    box = F.struct("l", "t", "r", "b", F.lit("TOPLEFT").alias("origin"))
    cells = v.select("doc_id", "table_no", "cell_no", "r0", "r1", "c0", "c1", "text", box.alias("bbox"), "column_header", *[F.lit(False).alias(n) for n in ("row_header", "row_section", "fillable")])
    new_tables, new_cells = tables.collapse_header_groups(v.select("doc_id", "table_no", "num_cols").distinct(), cells)
    out = new_cells.join(new_tables, ["doc_id", "table_no"])
    return out.select("doc_id", "r0", "c0", "c1", "text", "bbox.l", "bbox.r", "bbox.t", "bbox.b", "column_header", "num_cols")


_TOC = f"SELECT *, num_cols = 2 AND num_rows >= 6 AND doc_id % 2 = 0 AS toc_like FROM ({views.CONTENTS})"


@query(f"SELECT doc_id, toc_like FROM ({_TOC})")
def toc_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = views.of(spark, sf_dir, views.CONTENTS)
    return tables.toc_like(v.drop("text"), v.select("doc_id", "table_no", F.lit(0).alias("cell_no"), "text")).select("doc_id", "toc_like")


@query(f"SELECT doc_id, count(*)::BIGINT AS table_count_pdf, sum(num_rows * num_cols)::BIGINT AS table_cells_pdf FROM ({_TOC}) WHERE NOT toc_like GROUP BY doc_id")
def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = views.of(spark, sf_dir, views.CONTENTS)
    return tables.table_stats(v.drop("text"), v.select("doc_id", "table_no", F.lit(0).alias("cell_no"), "text"))


def _two_readings(spark: SparkSession, sf_dir: str, other: str, shift: float) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    v, t = views.of(spark, sf_dir, views.READING), views.of(spark, sf_dir, views.READING_TABLES)
    box = lambda d: F.struct((F.col("l") + d).alias("l"), F.col("t").alias("t"), (F.col("l") + 20 + d).alias("r"), (F.col("t") + 10).alias("b"), F.lit("TOPLEFT").alias("origin")).alias("bbox")
    keys = ["doc_id", "table_no", "cell_no", "r0", "r1", "c0", "c1"]
    # the other reading misses the last table of every fifth document, so that its cells are found by place only
    lost = F.col("table_no") == F.when(F.col("doc_id") % 5 == 0, 2).otherwise(-1)
    there = t.withColumn("num_rows", F.when(lost, 77).otherwise(F.col("num_rows")))
    return t, v.select(*keys, "text", box(0.0)), there, v.select(*keys, F.col(other).alias("text"), box(shift))


_LOST = "(doc_id % 5 = 0 AND table_no = 2)"
#: Of the other reading's cells, whose boxes are 2 to the right, the one that covers a cell best.
_BEST = """
m AS (SELECT b.doc_id, b.table_no, b.cell_no, o.other, o.number, o.table_no AS t, o.cell_no AS c, greatest(least(b.l + 20, o.l + 22) - greatest(b.l, o.l + 2), 0) * greatest(least(b.t, o.t) + 10 - greatest(b.t, o.t), 0) / 200 AS a FROM v b JOIN v o ON b.doc_id = o.doc_id),
best AS (SELECT doc_id, table_no, cell_no, other, number FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, table_no, cell_no ORDER BY a * 0.7::DOUBLE + a * 0.3::DOUBLE DESC, t, c) AS k FROM m WHERE a >= 0.5) WHERE k = 1)
"""


@query(f"""
SELECT doc_id, table_no, cell_no, CASE WHEN cell_no % 3 = 0 AND NOT {_LOST} THEN other ELSE text END AS text, cell_no % 3 = 0 AS was_spaced, CASE WHEN cell_no % 3 = 0 AND NOT {_LOST} THEN 1 ELSE 0 END::BIGINT AS replaced FROM ({views.READING})
""")
def merge_cells_by_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.merge_spaced(*_two_readings(spark, sf_dir, "other", 500.0)).select("doc_id", "table_no", "cell_no", "text", "was_spaced", "replaced")


@query(f"""
WITH v AS ({views.READING}), {_BEST}
SELECT v.doc_id, v.table_no, v.cell_no, CASE WHEN v.cell_no % 3 <> 0 THEN v.text WHEN v.doc_id % 5 = 0 AND v.table_no = 2 THEN coalesce(best.other, v.text) ELSE v.other END AS text
FROM v LEFT JOIN best ON v.doc_id = best.doc_id AND v.table_no = best.table_no AND v.cell_no = best.cell_no
""")
def merge_cells_spatial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.merge_spaced(*_two_readings(spark, sf_dir, "other", 2.0)).select("doc_id", "table_no", "cell_no", "text")


@query(f"""
WITH v AS ({views.READING}), {_BEST},
s AS (SELECT v.doc_id, v.table_no, v.cell_no, CASE WHEN v.cell_no % 3 <> 0 AND v.cell_no % 4 = 0 AND NOT (v.doc_id % 5 = 0 AND v.table_no = 2) THEN v.number ELSE v.text END AS one, v.text <> CASE WHEN v.cell_no % 3 <> 0 AND v.cell_no % 4 = 0 AND NOT (v.doc_id % 5 = 0 AND v.table_no = 2) THEN v.number ELSE v.text END AS hit, best.number AS two
  FROM v LEFT JOIN best ON v.doc_id = best.doc_id AND v.table_no = best.table_no AND v.cell_no = best.cell_no),
d AS (SELECT *, regexp_replace(one, '[^0-9]', '', 'g') AS d1, regexp_replace(two, '[^0-9]', '', 'g') AS d2 FROM s),
r AS (SELECT *, coalesce(starts_with(one, 'RON') AND ends_with(d2, d1) AND length(d2) - length(d1) BETWEEN 1 AND 2, false) AS again FROM d)
SELECT doc_id, table_no, cell_no, CASE WHEN again THEN two ELSE one END AS text, (hit::INT + again::INT)::BIGINT AS replaced FROM r
""")
def suspect_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.merge_suspect(*_two_readings(spark, sf_dir, "number", 2.0)).select("doc_id", "table_no", "cell_no", "text", "replaced")


# --- pictures, glyphs, choices -----------------------------------------------------------------------


def _items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    v = views.of(spark, sf_dir, views.BOXES)
    flip = lambda a: F.when(F.col("flipped"), 300 - F.col(a)).otherwise(F.col(a))
    box = F.struct("l", flip("t").alias("t"), "r", flip("b").alias("b"), F.when(F.col("flipped"), "BOTTOMLEFT").otherwise("TOPLEFT").alias("origin"))
    pages = v.select("doc_id", "page_no").distinct().withColumn("height", F.lit(300.0))
    return v.select("doc_id", "item_no", "kind", "page_no", "text", box.alias("bbox")), pages


def _outside(*texts: str) -> str:
    return f"""
WITH v AS ({views.BOXES}) SELECT doc_id, item_no FROM v a WHERE NOT (kind = 'text' AND text IN {texts} AND EXISTS (SELECT 1 FROM v p WHERE p.doc_id = a.doc_id AND p.page_no = a.page_no AND p.kind = 'picture'
  AND greatest(least(a.r, p.r) - greatest(a.l, p.l), 0) * greatest(least(a.b, p.b) - greatest(a.t, p.t), 0) / 100 >= 0.6))"""


@query(_outside("31.12.2024", ""))
def picture_date_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pictures.remove_dates_inside_pictures(*_items(spark, sf_dir)).select("doc_id", "item_no")


@query(_outside("74% 9L 2025", "31.12.2024"))  # a date alone looks like ticks, too
def picture_axis_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pictures.remove_axis_texts_inside_pictures(*_items(spark, sf_dir)).select("doc_id", "item_no")


def _set_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names set glyph by glyph, two words a line, without blanks but with gaps: doc_id, w (word), i (glyph), word, ch and its box."""
    words = F.split(F.trim("p_name"), " +")
    g = _docs(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.posexplode(words).alias("w", "word"))
    before = F.sum(F.length("word") * 6 + 5).over(Window.partitionBy("doc_id", F.floor(F.col("w") / 2)).orderBy("w")) - F.length("word") * 6
    g = g.withColumn("x", before).select("doc_id", "w", "word", "x", F.posexplode(F.filter(F.split("word", ""), lambda c: c != "")).alias("i", "ch"))
    x, y = F.col("x") + F.col("i") * 6, F.floor(F.col("w") / 2) * 20
    edges = {"x0": x, "y0": y + F.col("i") % 2, "x1": x + 5.5, "y1": y + 10}
    return g.select("doc_id", "w", "i", "word", "ch", *[v.cast("double").alias(k) for k, v in edges.items()])


@query("SELECT p_partkey AS doc_id, trim(p_name) AS text FROM part")
def glyph_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Glyphs read back."""
    piece = F.struct(F.col("ch").alias("text"), "x0", "y0", "x1", "y1")
    return _set_type(spark, sf_dir).groupBy("doc_id").agg(F.collect_list(piece).alias("p")).select("doc_id", glyphs.read_glyphs(F.col("p")).alias("text"))


def _spaced_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A box for each part, whose text, for every third one, has blanks between all letters; the page's words and glyphs."""
    name = F.trim("p_name")
    box = F.struct(F.lit(-10.0).alias("l"), F.lit(-10.0).alias("t"), F.lit(2000.0).alias("r"), F.lit(500.0).alias("b"), F.lit("TOPLEFT").alias("origin"))
    text = F.when(F.col("p_partkey") % 3 == 0, F.array_join(F.filter(F.split(name, ""), lambda c: c != ""), " ")).otherwise(name)
    boxes = _docs(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.lit(0).alias("item_no"), F.lit(1).alias("page_no"), box.alias("box"), text.alias("text"))
    g = _set_type(spark, sf_dir).withColumn("page_no", F.lit(1))
    edges = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    words = g.groupBy("doc_id", "page_no", "w").agg(F.first("word").alias("text"), *edges)
    words = words.select("doc_id", "page_no", F.lit(0).alias("block_no"), F.floor(F.col("w") / 2).cast("int").alias("line_no"), F.col("w").alias("word_no"), "text", "x0", "y0", "x1", "y1")
    return boxes, words, g.select("doc_id", "page_no", (F.col("w") * 1000 + F.col("i")).alias("glyph_no"), "ch", "x0", "y0", "x1", "y1")


_REPAIRED = "SELECT p_partkey AS doc_id, trim(p_name) AS text, p_partkey % 3 = 0 AS fixed FROM part"


@query(_REPAIRED)
def text_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return glyphs.repair(*_spaced_parts(spark, sf_dir), table_mode=False).select("doc_id", "text", "fixed")


@query(_REPAIRED)
def cell_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return glyphs.repair(*_spaced_parts(spark, sf_dir), table_mode=True).select("doc_id", "text", "fixed")


@query(_REPAIRED)
def repair_by_glyphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return glyphs.repair_by_cells(*_spaced_parts(spark, sf_dir), table_mode=False).select("doc_id", "text", "fixed")


@query(f"SELECT doc_id, sum((text <> clean)::INT)::BIGINT AS changed FROM ({views.CELLS}) GROUP BY doc_id")
def cell_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cells of each document cleaning changes."""
    before = views.of(spark, sf_dir, views.CELLS)
    return tables.changes(before, tables.clean_cells)


@query("""
SELECT doc_id, item_no, caption FROM (SELECT c_custkey % 100 AS doc_id, c_custkey AS item_no, 'PROFIT NET RON ' || c_custkey || ' MIL.' AS caption, row_number() OVER (PARTITION BY c_custkey % 100 ORDER BY c_custkey) AS k FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0) WHERE k <= 30
""")
def kpi_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _docs(spark, sf_dir, "customer").select((F.col("c_custkey") % 100).alias("doc_id"), F.col("c_custkey").alias("item_no"))
    raw = F.when(F.col("item_no") % 2 == 0, F.concat(F.lit("PROFIT\nNET\n "), F.col("item_no").cast("string"), F.lit("  MIL.\nRON"))).otherwise(F.lit("Q&A cu CEO"))
    said = c.filter("item_no % 3 = 0").groupBy("doc_id").agg(F.concat_ws(" ", F.collect_list(F.concat(F.lit("profit net ron "), F.col("item_no").cast("string"), F.lit(" mil.")))).alias("text"))
    docs = c.select("doc_id").distinct().join(said, "doc_id", "left")
    return pictures.kpi_captions(c.withColumn("n_captions", F.lit(0)), c.withColumn("text", raw), docs)


_TWO = "SELECT doc_id, text || chr(10) || 'x y' AS text FROM documents"
_ONE = "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'A clean page.' ELSE text || chr(10) || 'x z' END AS text FROM documents"


@query(f"""
WITH a AS ({_score(_TWO)}), b AS ({_score(_ONE)})
SELECT doc_id, CASE WHEN b.score > a.score THEN 'pypdfium2' ELSE 'docling-parse-v4' END AS backend, greatest(a.score, b.score) AS score FROM a JOIN b USING (doc_id)
""")
def backend_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    one = d.select("doc_id", F.lit("docling-parse-v4").alias("backend"), F.concat("text", F.lit("\nx y")).alias("markdown"))
    two = d.select("doc_id", F.lit("pypdfium2").alias("backend"), F.when(F.col("doc_id") % 3 == 0, F.lit("A clean page.")).otherwise(F.concat("text", F.lit("\nx z"))).alias("markdown"))
    return select.best_backend(two.union(one))


@query("""
SELECT o_orderkey AS doc_id, a < 200 OR b >= 0.04 AS tried, (a < 200 OR b >= 0.04) AND (c < b * 0.5 OR ol > l * 1.2) AS kept
FROM (SELECT o_orderkey, (o_orderkey % 400)::DOUBLE AS a, (o_orderkey % 10) / 100.0::DOUBLE AS b, (o_orderkey % 7) / 100.0::DOUBLE AS c, 1000 AS l, 1000 + o_orderkey % 400 AS ol FROM orders)
""")
def ocr_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return select.ocr_decision(
        _docs(spark, sf_dir, "orders").select(k.alias("doc_id"), (k % 400).cast("double").alias("chars_per_page"), ((k % 10) / 100.0).alias("spaced_ratio"), ((k % 7) / 100.0).alias("ocr_ratio"), F.lit(1000).alias("length"), (1000 + k % 400).alias("ocr_length"))
    )


@query("""
WITH i AS (SELECT c_custkey % 200 AS doc_id, CASE WHEN c_custkey % 50 <> 0 THEN c_custkey % 7 END AS page_no, true AS hit FROM customer WHERE c_custkey % 2 = 0),
t AS (SELECT o_custkey % 300 AS doc_id, o_custkey % 3 AS table_no, bool_or(o_orderkey % 20 = 0 OR o_orderkey % 29 = 0) AS hit FROM orders GROUP BY ALL),
e AS (SELECT * FROM i UNION ALL SELECT doc_id, CASE WHEN doc_id <> 299 THEN table_no + 10 END, hit FROM t)
SELECT doc_id, CASE WHEN NOT bool_or(page_no IS NULL) THEN coalesce(array_to_string(list_sort(list(DISTINCT page_no) FILTER (hit)), ','), '') END AS pages FROM e GROUP BY doc_id
""")
def spacing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and cells on pages; those of a table are spaced, or end in a lone letter, by their key."""
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    items = _docs(spark, sf_dir, "customer").select((k % 200).alias("doc_id"), F.lit("text").alias("kind"), F.when(k % 2 == 0, "finan c iar").otherwise("financiar").alias("text"), F.when(k % 50 != 0, k % 7).alias("page_no"))
    text = F.when(o % 20 == 0, "va l o are").when(o % 29 == 0, "Total b").when(o % 3 == 0, "SOLD C").otherwise("RON 5")
    cells = _docs(spark, sf_dir, "orders").select((F.col("o_custkey") % 300).alias("doc_id"), (F.col("o_custkey") % 3).alias("table_no"), text.alias("text"))
    on_page = cells.select("doc_id", "table_no", F.when(F.col("doc_id") != 299, F.col("table_no") + 10).alias("page_no")).distinct()
    out = select.spacing_pages(items, cells, on_page)
    return out.select("doc_id", F.when(F.col("pages").isNotNull(), F.array_join(F.col("pages").cast("array<string>"), ",")).alias("pages"))


@query("""
SELECT page_id AS doc_id, len(regexp_extract_all(html, '<h1'))::BIGINT AS headings, (len(regexp_extract_all(html, '<h1')) + len(regexp_extract_all(html, '<p[ >]')))::BIGINT AS exported FROM pages
""")
def label_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings, and items whose labels are exported, of web pages' elements."""
    kinds = F.regexp_extract_all("html", F.lit("<(h1|p|nav|footer)[ >]"), F.lit(1))
    label = F.element_at(F.create_map(*[F.lit(x) for x in ("h1", "section_header", "p", "text", "nav", "page_header", "footer", "page_footer")]), F.col("tag"))
    docs = _docs(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), kinds.alias("tags"))
    items = docs.select("doc_id", F.explode("tags").alias("tag")).withColumn("label", label)
    exported = select.exported(items).groupBy("doc_id").agg(F.count("*").alias("exported"))
    out = docs.select("doc_id").join(audit.heading_counts(items), "doc_id", "left").join(exported, "doc_id", "left")
    return out.select("doc_id", F.coalesce("heading_count_pdf", F.lit(0).cast("long")).alias("headings"), F.coalesce("exported", F.lit(0).cast("long")).alias("exported"))
