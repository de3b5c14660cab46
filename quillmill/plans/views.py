"""Deterministic inputs of the registered queries, made of whole test tables.

The raw tables hold no headings, page breaks, currencies or boxes. These views add them by integer arithmetic on keys. Each is one SELECT that Spark and DuckDB both run,
with table names in braces and, where the two differ, both forms as ⟦Spark¦DuckDB⟧; what the noise was made from is kept in a column, so that the expected repair is known without
repairing anything.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BREAK = "<!-- page break -->"
NL = "chr(10)"

#: Each whole text in pages of eight lines.
CHUNKS = """
SELECT doc_id, source, n_chars, ⟦transform(array(split(coalesce(text, ''), chr(10))), s -> transform(sequence(0, (size(s) - 1) div 8), k -> array_join(slice(s, 8 * k + 1, 8), chr(10))))[0]¦
  list_transform([string_split(coalesce(text, ''), chr(10))], lambda s: list_transform(generate_series(0, (len(s) - 1) // 8), lambda k: array_to_string(s[8 * k + 1 : 8 * k + 8], chr(10))))[1]⟧ AS chunks
FROM {documents}
"""
_K = "⟦i¦(i - 1)⟧"
#: Pages with headings, key figures, axis lines, images, tables and headings that lead to nothing.
MD = f"""
SELECT doc_id, source, n_chars, ⟦array_join(transform(chunks, (c, i) -> ¦array_to_string(list_transform(chunks, lambda c, i: ⟧
  CASE WHEN {_K} = 0 THEN '## ' || source || {NL} || {NL} || c || {NL}
  WHEN {_K} % 4 = 1 AND doc_id % 3 = 0 THEN '{BREAK}' || {NL} || c
  WHEN {_K} % 4 = 1 THEN {NL} || '## ' || source || {NL} || {NL} || 'ACTIVE CIRCULANTE' || {NL} || {NL} || 'RON ' || cast(n_chars AS string) || ' MIL.' || {NL} || {NL}
    || '+' || cast(doc_id % 90 AS string) || '%' || {NL} || {NL} || c || {NL} || '74% 9L 2025'
  WHEN {_K} % 4 = 2 THEN {NL} || '## ' || source || {NL} || '<!-- image -->' || {NL} || c || {NL} || CASE WHEN doc_id % 2 = 0 THEN '### Orphan heading' ELSE '| a | b |' || {NL} || '|---|---|' || {NL} || '| 1 | 2 |' END
  WHEN {_K} % 4 = 3 THEN {NL} || CASE doc_id % 4 WHEN 0 THEN '## Next part' WHEN 2 THEN 'In 2025 there was more.' ELSE 'Text follows here and' END || {NL} || c || {NL} || 'The end.'
  ELSE {NL} || c END), '{BREAK}') AS markdown
FROM ({CHUNKS})
"""

#: A document's pages against a rendering that lost something on most.
PAGES = f"""
SELECT doc_id, cast(2 * k + 1 AS int) AS page_no, c || CASE k % 3 WHEN 1 THEN ' 1.234,5 and 12% on 31.12.2024' WHEN 2 THEN ' 7,5 and 2024 on 1/2/20' ELSE '' END AS text
FROM (SELECT doc_id, ⟦posexplode(chunks) AS (k, c)¦unnest(chunks) AS c, generate_subscripts(chunks, 1) - 1 AS k⟧ FROM ({CHUNKS}))
"""
RENDERED = f"""
SELECT doc_id, ⟦array_join(transform(chunks, (c, i) -> ¦array_to_string(list_transform(chunks, lambda c, i: ⟧
  CASE {_K} % 3 WHEN 0 THEN substr(c, 1, cast(floor(length(c) * 0.8) AS int)) WHEN 1 THEN CASE WHEN doc_id % 5 = 0 THEN ' ' ELSE substr(c, 1, cast(floor(length(c) * 0.5) AS int)) || ' 1234.5 and 31.12.2024' END
  ELSE {NL} || c || ' 7.5 on 2/2/20' END), '{BREAK}') AS markdown
FROM ({CHUNKS})
"""
#: Whole texts with Romanian letters for accented ones, and the same as UTF-8 looks when read as Windows-1252; every third text isn't broken.
_ACCENTS = ("éèêëáàåäãóòôöõúùûüíìïñçßÉÈÁÀÄÓÖÚÜ", "ăăăăâââââșșșșșțțțțîîîîțșĂĂÂÂÂȘȘȚȚ")
_BROKEN = (("ă", "Äƒ"), ("â", "Ã¢"), ("î", "Ã®"), ("ș", "È™"), ("ț", "È›"), ("Ă", "Ä‚"), ("Â", "Ã‚"), ("Î", "ÃŽ"), ("Ș", "È˜"), ("Ț", "Èš"))


def _replaced(column: str) -> str:
    for letter, broken in _BROKEN:
        column = f"replace({column}, '{letter}', '{broken}')"
    return column


BROKEN_TEXTS = f"SELECT doc_id, good, CASE WHEN doc_id % 3 = 1 THEN good ELSE {_replaced('good')} END AS broken FROM (SELECT doc_id, translate(text, '{_ACCENTS[0]}', '{_ACCENTS[1]}') AS good FROM {{documents}})"

_N = "(1000 + cast(floor(o_totalprice) AS bigint) % 899000)"
_A = f"(cast(cast(floor({_N} / 1000) AS bigint) AS string) || '.' || lpad(cast({_N} % 1000 AS string), 3, '0'))"
_P = "cast(10 + o_orderkey % 90 AS string)"
#: One cell for each order: its text, and what cleaning should make of it.
CELLS = f"""
SELECT o_custkey AS doc_id, 0 AS table_no, o_orderkey AS cell_no, o_orderkey % 12 AS kind, {_A} AS amount,
  CASE o_orderkey % 12 WHEN 0 THEN 'RON ' || {_A} WHEN 1 THEN {_A} || ' RON' WHEN 2 THEN 'RON ' || {_A} || ' N' WHEN 3 THEN {_A} || ' EUR ' || {_A} || ' EUR' WHEN 4 THEN {_A} || ' ON'
    WHEN 5 THEN {_P} || ' % ' || {_P} || ' %' WHEN 6 THEN '- ' || {_P} || ',40%' WHEN 7 THEN {_A} || ' EUR 7' WHEN 8 THEN 'RON ' || {_A} || ']' WHEN 9 THEN '31/12/20 31/12/2024' WHEN 10 THEN 'EUR ( ' || {_P} || ' )' ELSE 'Total active ' || {_P} END AS text,
  CASE o_orderkey % 12 WHEN 3 THEN 'EUR ' || {_A} WHEN 5 THEN {_P} || '%' WHEN 6 THEN '-' || {_P} || ',40%' WHEN 7 THEN 'EUR ' || {_A} WHEN 9 THEN '31/12/2024' WHEN 10 THEN 'EUR (' || {_P} || ')' WHEN 11 THEN 'Total active ' || {_P} ELSE 'RON ' || {_A} END AS clean
FROM {{orders}}
"""
_D = "(lpad(cast(1 + o_orderkey % 28 AS string), 2, '0') || '/' || lpad(cast(1 + o_orderkey % 12 AS string), 2, '0') || '/')"
_Y = "cast(2020 + o_orderkey % 5 AS string)"
HEADERS = f"""
SELECT o_orderkey AS cell_no,
  CASE o_orderkey % 7 WHEN 0 THEN {_D} || {_Y} WHEN 1 THEN '31.12.2022' || {_D} || {_Y} WHEN 2 THEN '2022' || {_D} || {_Y} WHEN 3 THEN 'Total activ Total activ' WHEN 4 THEN 'Δ %' WHEN 5 THEN ' Suma  RON ' ELSE 'la ' || {_D} || {_Y} END AS text,
  CASE o_orderkey % 7 WHEN 3 THEN 'Total activ' WHEN 4 THEN 'Δ%' WHEN 5 THEN 'Suma RON' WHEN 6 THEN 'la ' || {_D} || {_Y} ELSE {_D} || {_Y} END AS clean
FROM {{orders}}
"""
#: Numbers that are whole or broken.
SUSPECTS = f"""
SELECT o_custkey AS doc_id, 0 AS table_no, o_orderkey AS cell_no,
  CASE o_orderkey % 6 WHEN 0 THEN 'RON ' || {_A} WHEN 1 THEN 'EUR .' || {_A} WHEN 2 THEN 'RON ' || {_A} || '.' WHEN 3 THEN 'RON ' || {_A} || '.12' WHEN 4 THEN {_A} || ',55' ELSE 'Fara numar' END AS text,
  CASE WHEN o_orderkey % 6 IN (1, 2, 3) THEN 1 ELSE 0 END AS broken
FROM {{orders}}
"""
#: A table for each customer: rows are orders, column 1 a currency amount, mostly RON in two of three tables.
VOTES = f"""
SELECT o_custkey AS doc_id, 0 AS table_no, o_orderkey AS cell_no, o_orderkey % 50 AS r0, o_orderkey % 50 + 1 AS r1, o_orderkey % 3 AS c0, o_orderkey % 3 + 1 + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS c1,
  CASE WHEN o_orderkey % 5 = 0 AND o_custkey % 3 <> 0 OR o_orderkey % 2 = 0 AND o_custkey % 3 = 0 THEN 'EUR ' ELSE 'RON ' END || {_A} || CASE WHEN o_orderkey % 13 = 0 THEN ' RON' ELSE '' END AS text
FROM {{orders}}
"""
#: Headers that span two columns each after the first; every fourth table has a gap and stays.
SPANS = f"""
SELECT c_custkey AS doc_id, 0 AS table_no, 5 AS num_cols, g.k AS cell_no, cast(CASE WHEN g.k < 3 THEN 0 ELSE 1 END AS int) AS r0, cast(CASE WHEN g.k < 3 THEN 1 ELSE 2 END AS int) AS r1,
  cast(CASE g.k WHEN 0 THEN 0 WHEN 1 THEN 1 + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END WHEN 2 THEN 3 ELSE g.k - 3 END AS int) AS c0, cast(CASE g.k WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 5 ELSE g.k - 2 END AS int) AS c1,
  CASE g.k WHEN 0 THEN 'Indicator' WHEN 1 THEN '30/09/2025' WHEN 2 THEN '30/09/2024' WHEN 3 THEN 'CIFRA ' || cast(c_custkey AS string) WHEN 4 THEN ' RON' WHEN 5 THEN cast(c_custkey * 7 AS string) WHEN 6 THEN CASE WHEN c_custkey % 2 = 0 THEN 'EUR' ELSE '' END ELSE cast(c_custkey * 3 AS string) || ' ' END AS text,
  cast(g.k * 10 AS double) AS l, cast(g.k AS double) AS t, cast(g.k * 10 + 8 AS double) AS r, cast(g.k + 5 AS double) AS b, g.k < 3 AS column_header
FROM {{customer}} CROSS JOIN (SELECT cast(n_nationkey AS int) AS k FROM {{nation}} WHERE n_nationkey < 8) g
"""
#: Tables of two columns and as many rows as six and more, of contents or of amounts.
CONTENTS = """
SELECT c_custkey AS doc_id, 0 AS table_no, 1 AS page_no, cast(CASE WHEN c_custkey % 5 = 0 THEN 4 ELSE 6 + c_custkey % 3 END AS int) AS num_rows, cast(CASE WHEN c_custkey % 7 = 0 THEN 3 ELSE 2 END AS int) AS num_cols,
  CASE WHEN c_custkey % 2 = 0 THEN 'Capitol de continut ' || cast(c_custkey % 90 AS string) ELSE 'Suma ' || cast(100000 + c_custkey AS string) END AS text FROM {customer}
"""
#: Texts and pictures on a page: a text lies in the picture of its page where its key says so.
BOXES = """
SELECT o_custkey AS doc_id, cast(o_orderkey AS int) AS item_no, CASE WHEN o_orderkey % 5 = 0 THEN 'picture' ELSE 'text' END AS kind, cast(o_orderkey % 2 AS int) AS page_no,
  CASE o_orderkey % 3 WHEN 0 THEN '31.12.2024' WHEN 1 THEN '74% 9L 2025' ELSE 'Total active' END AS text,
  cast((o_orderkey * 7) % 100 AS double) AS l, cast((o_orderkey * 3) % 100 AS double) AS t, cast((o_orderkey * 7) % 100 + CASE WHEN o_orderkey % 5 = 0 THEN 90 ELSE 10 END AS double) AS r, cast((o_orderkey * 3) % 100 + CASE WHEN o_orderkey % 5 = 0 THEN 90 ELSE 10 END AS double) AS b, o_orderkey % 4 = 0 AS flipped
FROM {orders}
"""
#: Two readings of cells: table o_custkey % 3 of a document has the first reading's spaced texts.
READING = f"""
SELECT cast(floor(o_custkey / 3) AS bigint) AS doc_id, cast(o_custkey % 3 AS int) AS table_no, cast(o_orderkey AS int) AS cell_no, cast(o_orderkey AS int) AS r0, cast(o_orderkey + 1 AS int) AS r1, 0 AS c0, 1 AS c1,
  CASE WHEN o_orderkey % 3 = 0 THEN 'va l o are ' || cast(o_orderkey AS string) ELSE 'RON ' || {_A} END AS text, 'valoare ' || cast(o_orderkey AS string) AS other,
  CASE WHEN o_orderkey % 4 = 0 THEN 'RON 1' || {_A} ELSE 'RON ' || {_A} END AS number,
  cast((o_orderkey * 11) % 400 AS double) AS l, cast((o_orderkey * 5) % 300 AS double) AS t
FROM {{orders}}
"""
READING_TABLES = """
SELECT DISTINCT cast(floor(o_custkey / 3) AS bigint) AS doc_id, cast(o_custkey % 3 AS int) AS table_no, 1 AS page_no, cast(CASE WHEN o_custkey % 7 = 0 THEN 9 ELSE 5 END AS int) AS num_rows, 1 AS num_cols FROM {orders}
"""

_WORDS = re.compile(r"\{([a-z]+)\}")
_FORMS = re.compile(r"⟦([^¦⟧]*)¦([^⟧]*)⟧")


def of(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The view on Spark, reading the tables under sf_dir."""
    return spark.sql(_WORDS.sub(lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", _FORMS.sub(r"\1", sql)))


def duck(sql: str) -> str:
    """The view for DuckDB, where the tables are views of the same names."""
    return _WORDS.sub(lambda m: m[1], _FORMS.sub(lambda m: m[2], sql))
