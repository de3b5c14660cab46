"""Choosing between readings of a document: text backends, pages to repair, and whether to keep an OCR reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.detect import needs_spacing_fix, needs_table_spacing_fix
from quillmill.operators.quality import report
from quillmill.sources.config import EXPORT_LABELS

#: Backends in order of preference among equals.
BACKENDS = ("docling-parse-v4", "pypdfium2")
SPACED_SHARE = 0.04
FEW_CHARS = 200


def exported(items: DataFrame, labels: tuple[str, ...] = EXPORT_LABELS) -> DataFrame:
    """The items whose labels are exported."""
    return items.filter(F.col("label").isin(*labels))


def best_backend(readings: DataFrame, order: tuple[str, ...] = BACKENDS) -> DataFrame:
    """readings: doc_id, backend, markdown of the probed pages. (doc_id, backend, score) of the best, the first in order among equals."""
    rank = F.array_position(F.array(*[F.lit(b) for b in order]), F.col("backend"))
    scored = readings.select("doc_id", "backend", rank.alias("rank"), report(F.coalesce("markdown", F.lit("")))["score"].alias("score"))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("score"), "rank"))
    return scored.withColumn("n", nth).filter("n = 1").select("doc_id", "backend", "score")


def spacing_pages(items: DataFrame, cells: DataFrame, tables: DataFrame, predicate=needs_spacing_fix, table_predicate=needs_table_spacing_fix) -> DataFrame:
    """(doc_id, pages): the pages with a text or cell in need of repair; null, for all pages, where a table or such a text has no page."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hits = items.filter((F.col("kind") != "table") & (text != "")).filter(predicate(text)).select("doc_id", "page_no", F.lit(True).alias("hit"))
    cell = cells.groupBy("doc_id", "table_no").agg(F.bool_or(table_predicate(text)).alias("hit"))
    by_table = tables.select("doc_id", "table_no", "page_no").join(cell, ["doc_id", "table_no"], "left").select("doc_id", "page_no", F.coalesce("hit", F.lit(False)).alias("hit"))
    every = hits.union(by_table).groupBy("doc_id").agg(F.bool_or(F.col("page_no").isNull()).alias("unknown"), F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("page_no")))).alias("pages"))
    return every.select("doc_id", F.when(~F.col("unknown"), F.col("pages")).alias("pages"))


def wants_ocr(chars_per_page: Column, spaced_ratio: Column) -> Column:
    """A second reading pays for pages of little text or cells that are often spaced."""
    return (chars_per_page < FEW_CHARS) | (spaced_ratio >= SPACED_SHARE)


def keeps_ocr(spaced_ratio: Column, ocr_ratio: Column, length: Column, ocr_length: Column) -> Column:
    """The second reading stays if it halves the spaced cells or has a fifth more text."""
    return (ocr_ratio < spaced_ratio * 0.5) | (ocr_length > length * 1.2)


def ocr_decision(readings: DataFrame) -> DataFrame:
    """readings: doc_id, chars_per_page, spaced_ratio, ocr_ratio, length, ocr_length."""
    c = F.col
    use = wants_ocr(c("chars_per_page"), c("spaced_ratio"))
    return readings.select("doc_id", use.alias("tried"), (use & keeps_ocr(c("spaced_ratio"), c("ocr_ratio"), c("length"), c("ocr_length"))).alias("kept"))
