"""Reading and writing extracted documents.

An extracted corpus is a folder of tables, Parquet by default: items, pages, tables, cells, words, glyphs, and those of a second reading with names that begin with ocr_. Files that
must be decoded first go through an extractor, a function from a file's bytes to rows, which runs in tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions.geometry import BOX

SCHEMAS = {
    "items": f"doc_id long, item_no int, kind string, label string, level int, text string, page_no int, bbox {BOX}, n_captions int",
    "pages": "doc_id long, page_no int, height double",
    "tables": "doc_id long, table_no int, page_no int, num_rows int, num_cols int",
    "cells": f"doc_id long, table_no int, cell_no int, r0 int, r1 int, c0 int, c1 int, text string, bbox {BOX}, column_header boolean, row_header boolean, row_section boolean, fillable boolean",
    "words": "doc_id long, page_no int, block_no int, line_no int, word_no int, text string, x0 double, y0 double, x1 double, y1 double",
    "glyphs": "doc_id long, page_no int, glyph_no int, ch string, x0 double, y0 double, x1 double, y1 double",
    "markdown": "doc_id long, markdown string",
}

Extractor = Callable[[str, bytes], Iterable[dict]]


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet", page_range: tuple[int, int] | None = None) -> DataFrame:
    """A table of an extracted corpus; a page range is pushed down to the scan."""
    df = spark.read.schema(SCHEMAS[name.removeprefix("ocr_")]).format(fmt).load(f"{path}/{name}")
    return df.filter(F.col("page_no").between(*page_range)) if page_range and "page_no" in df.columns else df


def staged(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the folder that spark.checkpoint.dir names, or kept where that is unset: what is read from it plans, and starts again, from there."""
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.persist()
    path = f"{folder.rstrip('/')}/quillmill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: path, markdown. path: what write_markdown wrote as Parquet (its ids are the paths), or Markdown files."""
    try:
        found = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
        return found.select(F.col("doc_id").cast("string").alias("path"), "markdown")
    except AnalysisException:
        return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("markdown"))


def extract(spark: SparkSession, path: str, extractor: Extractor, name: str) -> DataFrame:
    """A table made by an extractor from each file under path."""
    schema = SCHEMAS[name]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"], strict=True):
                rows = list(extractor(file, content))
                if rows:
                    yield pd.DataFrame(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def read_pictures(pictures: DataFrame, files: DataFrame, reader: Callable[[bytes, int, dict, str | None], str | None] | None, languages: str | None = None) -> DataFrame:
    """(doc_id, item_no, text): what an OCR reader makes of each picture, given its file's bytes, page, box and languages; null without a reader, empty where it fails.

    pictures: doc_id, item_no, page_no, bbox. files: doc_id, content.
    """
    schema = "doc_id long, item_no int, text string"
    if reader is None:
        return pictures.select("doc_id", "item_no", F.lit(None).cast("string").alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            said = []
            for content, page, box in zip(frame["content"], frame["page_no"], frame["bbox"], strict=True):
                try:
                    said.append(reader(content, page, box, languages) or "")
                except Exception:  # a picture that can't be read has no text
                    said.append("")
            yield frame[["doc_id", "item_no"]].assign(text=said)

    return pictures.filter("page_no IS NOT NULL AND bbox IS NOT NULL").select("doc_id", "item_no", "page_no", "bbox").join(files.select("doc_id", "content"), "doc_id").mapInPandas(run, schema)


def write_markdown(docs: DataFrame, path: str, files: bool = False) -> None:
    """Parquet of (doc_id, markdown), in files of many documents; or, on request and for few documents, a text file for each, in a folder of its id."""
    out = docs.select("doc_id", "markdown")
    if files:
        out.withColumnRenamed("markdown", "value").repartition("doc_id").write.partitionBy("doc_id").option("lineSep", "\x00").text(path)
    else:
        out.write.parquet(path)


def document_json(items: DataFrame, tables: DataFrame, cells: DataFrame) -> DataFrame:
    """(doc_id, json): everything known of a document, its tables with their cells."""
    gather = lambda df, keys, order: df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in df.columns if c not in (*keys, order)]))).alias("rows"))
    whole = tables.join(gather(cells, ["doc_id", "table_no"], "cell_no").withColumnRenamed("rows", "cells"), ["doc_id", "table_no"], "left")
    by_doc = gather(items, ["doc_id"], "item_no").withColumnRenamed("rows", "items").join(gather(whole, ["doc_id"], "table_no").withColumnRenamed("rows", "tables"), "doc_id", "full")
    return by_doc.select("doc_id", F.to_json(F.struct("doc_id", "items", "tables")).alias("json"))


def write_json(documents: DataFrame, path: str) -> None:
    documents.select(F.col("json").alias("value")).write.text(path)
