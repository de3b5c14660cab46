"""Texts inside pictures: dates and axis labels that go, key figures that become captions.

items: doc_id, item_no, kind, text, page_no, bbox. pages: doc_id, page_no, height.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.detect import is_axis, is_date_only
from quillmill.functions.geometry import overlap_ratio, to_top_left
from quillmill.functions.kpi import is_kpi_text
from quillmill.functions.regex import casefold, chain
from quillmill.functions.text import normalize_kpi_caption, normalize_ligatures, normalize_mojibake


def _boxed(items: DataFrame, pages: DataFrame) -> DataFrame:
    return items.join(pages.select("doc_id", "page_no", "height"), ["doc_id", "page_no"], "left").withColumn("box", to_top_left(F.col("bbox"), F.col("height"))).drop("height")


def inside_pictures(items: DataFrame, pages: DataFrame, wanted: Column, overlap: float = 0.6) -> DataFrame:
    """(doc_id, item_no) of the wanted texts of which a picture on their page holds the share `overlap`."""
    texts = _boxed(items.filter(~F.col("kind").isin("table", "picture") & F.coalesce("text", F.lit("")).rlike(r"\S")).filter(wanted), pages)
    pics = _boxed(items.filter(F.col("kind") == "picture"), pages).filter("page_no IS NOT NULL AND bbox IS NOT NULL").select("doc_id", "page_no", F.col("box").alias("pic"))
    on = (texts["doc_id"] == pics["doc_id"]) & (texts["page_no"] == pics["page_no"]) & (overlap_ratio(texts["box"], pics["pic"]) >= F.lit(overlap))
    return texts.join(pics, on, "left_semi").select("doc_id", "item_no")


def remove_dates_inside_pictures(items: DataFrame, pages: DataFrame, overlap: float = 0.6) -> DataFrame:
    gone = inside_pictures(items, pages, is_date_only(F.col("text")), overlap)
    return items.join(gone, ["doc_id", "item_no"], "left_anti").select(*items.columns)


def remove_axis_texts_inside_pictures(items: DataFrame, pages: DataFrame, overlap: float = 0.6) -> DataFrame:
    gone = inside_pictures(items, pages, is_axis(F.col("text")), overlap)
    return items.join(gone, ["doc_id", "item_no"], "left_anti").select(*items.columns)


def picture_texts(pictures: DataFrame, words: DataFrame, pad: float = 2.0) -> DataFrame:
    """(doc_id, item_no, text): the words that meet each picture's padded box, by block and line.

    words: doc_id, page_no, block_no, line_no, word_no, text, x0, y0, x1, y1.
    """
    w = words.filter("text <> ''").withColumnRenamed("text", "word")
    p = pictures.select("doc_id", "item_no", "page_no", "bbox")
    b = F.col("bbox")
    met = p.join(w, ["doc_id", "page_no"]).filter((F.col("x1") > b["l"] - pad) & (F.col("x0") < b["r"] + pad) & (F.col("y1") > b["t"] - pad) & (F.col("y0") < b["b"] + pad))
    lines = met.groupBy("doc_id", "item_no", "block_no", "line_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_no", "word"))), lambda x: x["word"]), " ").alias("line"))
    return lines.groupBy("doc_id", "item_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "line_no", "line"))), lambda x: x["line"]), "\n").alias("text"))


def kpi_captions(pictures: DataFrame, texts: DataFrame, docs: DataFrame, second: DataFrame | None = None, most: int = 30) -> DataFrame:
    """(doc_id, item_no, caption) for pictures whose text is a key figure that the document doesn't state yet; the first `most` of each document.

    pictures: doc_id, item_no, n_captions; texts and second (from an OCR reading, used where the first is no key figure): doc_id, item_no, text; docs: doc_id, text.
    """
    tidy = lambda c: chain(F.coalesce(c, F.lit("")), normalize_mojibake, normalize_ligatures, normalize_kpi_caption)
    own = pictures.filter("n_captions = 0").join(texts.select("doc_id", "item_no", tidy(F.col("text")).alias("raw")), ["doc_id", "item_no"], "left")
    if second is not None:
        own = own.join(second.select("doc_id", "item_no", tidy(F.col("text")).alias("raw2")), ["doc_id", "item_no"], "left")
    else:
        own = own.withColumn("raw2", F.lit(None).cast("string"))
    own = own.withColumn("caption", F.when(is_kpi_text(F.coalesce("raw", F.lit(""))), F.col("raw")).when(is_kpi_text(F.coalesce("raw2", F.lit(""))), F.col("raw2"))).filter("caption IS NOT NULL")
    own = own.join(docs.select("doc_id", casefold(F.coalesce("text", F.lit(""))).alias("said")), "doc_id").filter(~F.col("said").contains(casefold(F.col("caption"))))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("item_no"))
    return own.withColumn("nth", nth).filter(F.col("nth") <= most).select("doc_id", "item_no", "caption")
