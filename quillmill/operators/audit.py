"""How much of a document's text, numbers and dates a Markdown rendering kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import extract
from quillmill.functions.detect import is_multi_space, is_spaced, needs_spacing_fix
from quillmill.functions.regex import let
from quillmill.operators.markdown import PAGE_BREAK, heading_count, split_pages, table_count
from quillmill.operators.tables import table_stats, toc_like

def token_share(reference: Column, candidate: Column) -> Column:
    """The share of the reference's words, repeats counted, that the candidate has; 1 for none.

    Both sides' words are sorted together, the candidate's before the reference's, so that one pass over them sees whether a word was just met.
    """

    def share(words: Column) -> Column:
        start = F.struct(F.lit(None).cast("string").alias("met"), F.lit(0).alias("n"), F.lit(0).alias("held"))

        def add(a: Column, x: Column) -> Column:
            ref = x["side"] == 1
            met = F.when(ref, a["met"]).otherwise(x["word"])
            return F.struct(met.alias("met"), F.when(ref, a["n"] + 1).otherwise(a["n"]).alias("n"), F.when(ref & (a["met"] == x["word"]), a["held"] + 1).otherwise(a["held"]).alias("held"))

        return let(F.aggregate(words, start, add), lambda a: F.when(a["n"] == 0, 1.0).otherwise(a["held"] / a["n"]))

    tag = lambda words, side: F.transform(words, lambda w: F.struct(w.alias("word"), F.lit(side).alias("side")))
    return let(F.sort_array(F.concat(tag(F.array_distinct(extract.audit_tokens(candidate)), 0), tag(extract.audit_tokens(reference), 1))), share)


def _set_share(reference: Column, candidate: Column) -> Column:
    """The same of distinct entries."""
    return let(reference, lambda r: F.when(F.size(r) == 0, 1.0).otherwise(F.size(F.array_intersect(r, candidate)) / F.size(r)))


def recall(pairs: DataFrame, *keys: str, reference: str = "reference", candidate: str = "candidate") -> DataFrame:
    """For each row its keys and the three shares of the reference's entries that the candidate has; 1 where the reference has none. Null counts as empty.

    Both texts are in one row and are compared there.
    """
    ref, cand = F.coalesce(reference, F.lit("")), F.coalesce(candidate, F.lit(""))
    return pairs.select(*keys, token_share(ref, cand).alias("token_coverage"), _set_share(extract.numbers(ref), extract.numbers(cand)).alias("numeric_recall"), _set_share(extract.dates(ref), extract.dates(cand)).alias("date_recall"))


def per_page(doc_pages: DataFrame, docs: DataFrame, page_break: str = PAGE_BREAK) -> DataFrame:
    """The audit of each page: the i-th page number of a document against the i-th page of its Markdown that isn't blank.

    doc_pages: doc_id, page_no, text; docs: doc_id, markdown.
    """
    nth = doc_pages.withColumn("chunk_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("page_no")) - 1)
    md = split_pages(docs, page_break).withColumnRenamed("text", "candidate")
    pairs = nth.join(md, ["doc_id", "chunk_no"], "left").select("doc_id", "page_no", F.coalesce("text", F.lit("")).alias("reference"), F.coalesce("candidate", F.lit("")).alias("candidate"))
    pairs = pairs.withColumn("pdf_text_length", F.length("reference").cast("long")).withColumn("md_text_length", F.length("candidate").cast("long"))
    shares = ["token_coverage", "numeric_recall", "date_recall"]
    return recall(pairs, "doc_id", "page_no", "pdf_text_length", "md_text_length").select("doc_id", "page_no", *shares, "pdf_text_length", "md_text_length")


def worst_pages(audits: DataFrame, n: int = 5) -> DataFrame:
    """The n pages of least token coverage, in page order among equals."""
    return audits.orderBy("token_coverage", "doc_id", "page_no").limit(n)


def heading_counts(items: DataFrame) -> DataFrame:
    """(doc_id, heading_count_pdf): the titles and section headers of documents that have items."""
    return items.groupBy("doc_id").agg(F.sum(F.col("label").isin("title", "section_header").cast("long")).alias("heading_count_pdf"))


def spaced_cells(tables: DataFrame, cells: DataFrame) -> DataFrame:
    """(doc_id, total_table_cells, spaced_table_cells), without tables of contents."""
    real = cells.join(toc_like(tables, cells).filter("toc_like").select("doc_id", "table_no"), ["doc_id", "table_no"], "left_anti")
    return real.groupBy("doc_id").agg(F.count("*").alias("total_table_cells"), F.sum(is_spaced(F.coalesce("text", F.lit(""))).cast("long")).alias("spaced_table_cells"))


def document_metrics(docs: DataFrame, items: DataFrame, tables: DataFrame, cells: DataFrame) -> DataFrame:
    """One row of the 15 audit metrics per document. docs: doc_id, text, markdown; items: doc_id, kind, label, text; tables and cells as in operators.tables."""
    ref = recall(docs.select("doc_id", F.col("text").alias("reference"), F.col("markdown").alias("candidate")), "doc_id")
    md, text = F.coalesce("markdown", F.lit("")), F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", table_count(md).alias("table_count_md"), heading_count(md).alias("heading_count_md"), F.length(text).cast("long").alias("pdf_text_length"), F.length(md).cast("long").alias("md_text_length"))
    said = items.filter((F.col("kind") != "table") & (F.coalesce("text", F.lit("")) != ""))
    n = lambda cond: F.sum(cond.cast("long"))
    text_items = said.groupBy("doc_id").agg(F.count("*").alias("total_text_items"), n(is_multi_space(F.col("text"))).alias("multi_space_text_items"), n(needs_spacing_fix(F.col("text"))).alias("spaced_text_items"))
    headings = heading_counts(items)
    spaced = spaced_cells(tables, cells)
    out = reduce(lambda a, b: a.join(b, "doc_id", "left"), [table_stats(tables, cells), headings, text_items, spaced], ref.join(own, "doc_id"))
    order = ["token_coverage", "numeric_recall", "date_recall", "table_count_pdf", "table_count_md", "table_cells_pdf", "heading_count_pdf", "heading_count_md", "pdf_text_length", "md_text_length", "spaced_table_cells", "total_table_cells", "spaced_text_items", "multi_space_text_items", "total_text_items"]
    return out.select("doc_id", *[F.coalesce(c, F.lit(0)).alias(c) if c.endswith(("pdf", "cells", "items")) else F.col(c) for c in order])


def format_metrics(row: dict) -> str:
    """One line for the command line."""
    share = ", ".join(f"{k}={row[k]:.2%}" for k in ("token_coverage", "numeric_recall", "date_recall"))
    plain = {"tables_pdf": "table_count_pdf", "tables_md": "table_count_md", "table_cells_pdf": "table_cells_pdf", "headings_pdf": "heading_count_pdf", "headings_md": "heading_count_md", "pdf_text_len": "pdf_text_length", "md_text_len": "md_text_length"}
    parts = {"spaced_cells": ("spaced_table_cells", "total_table_cells"), "spacing_issue_text_items": ("spaced_text_items", "total_text_items"), "multi_space_text_items": ("multi_space_text_items", "total_text_items")}
    return ", ".join([share, *[f"{k}={row[v]}" for k, v in plain.items()], *[f"{k}={row[a]}/{row[b]}" for k, (a, b) in parts.items()]])


def ratios(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text_length, pages, spaced_table_cells, total_table_cells, for deciding on a second reading."""
    return docs.select("doc_id", (F.col("text_length") / F.greatest("pages", F.lit(1))).alias("chars_per_page"), F.coalesce(F.try_divide("spaced_table_cells", "total_table_cells"), F.lit(0.0)).alias("spaced_ratio"))


