"""From extracted tables to clean Markdown: the repairs in their order, each a DataFrame step."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.geometry import to_top_left
from quillmill.functions.text import normalize_item
from quillmill.operators import audit, glyphs, markdown, pictures, select, tables
from quillmill.sources.config import EXPORT_LABELS, Options
from quillmill.sources.io import staged


@dataclass(frozen=True)
class Corpus:
    """The tables of extracted documents; those of a second reading, by OCR, may be missing. Its picture items hold the texts that OCR found in pictures."""

    items: DataFrame
    pages: DataFrame
    tables: DataFrame
    cells: DataFrame
    words: DataFrame | None = None
    glyphs: DataFrame | None = None
    ocr_tables: DataFrame | None = None
    ocr_cells: DataFrame | None = None
    ocr_items: DataFrame | None = None


_TABLES = ("items", "pages", "tables", "cells", "words", "glyphs", "ocr_tables", "ocr_cells", "ocr_items")


def _chosen(readings: dict[str, Corpus], choice: DataFrame) -> Corpus:
    """The documents' tables, each document's from the reading that choice (doc_id, reading) names."""

    def of(table: str) -> DataFrame | None:
        parts = [getattr(c, table).join(choice.filter(F.col("reading") == name).select("doc_id"), "doc_id", "left_semi") for name, c in readings.items() if getattr(c, table) is not None]
        return reduce(DataFrame.unionByName, parts) if parts else None

    return Corpus(**{t: of(t) for t in _TABLES})


def probe(c: Corpus) -> DataFrame:
    """(doc_id, markdown) of each document's page 1, unrepaired, as backends are judged by it."""
    first = lambda df: df.filter("page_no = 1")
    return export(replace(c, items=first(c.items), tables=first(c.tables)))


def choose_backend(readings: dict[str, Corpus], wanted: str = "auto") -> Corpus:
    """Of the readings by several backends the wanted one, or for each document that whose page 1 scores best; the first in their order among equals."""
    if wanted != "auto":
        return readings[wanted]
    if len(readings) == 1:
        return next(iter(readings.values()))
    every = [c.items.select("doc_id").distinct().join(probe(c), "doc_id", "left").select("doc_id", F.lit(name).alias("backend"), "markdown") for name, c in readings.items()]
    best = staged(select.best_backend(reduce(DataFrame.unionByName, every), tuple(readings)), "backends")
    return _chosen(readings, best.select("doc_id", F.col("backend").alias("reading")))


def measures(c: Corpus) -> DataFrame:
    """doc_id, text_length, chars_per_page and spaced_ratio (of cells, without tables of contents), by which a second reading is asked for and judged."""
    text = c.items.filter("kind <> 'table' AND text <> ''").groupBy("doc_id").agg(F.sum(F.length("text")).alias("text_length"))
    n_pages = c.pages.groupBy("doc_id").agg(F.countDistinct("page_no").alias("pages"))
    spaced = audit.spaced_cells(c.tables, c.cells)
    every = c.items.select("doc_id").distinct()
    for part in (text, n_pages, spaced):
        every = every.join(part, "doc_id", "left")
    own = every.fillna(0, ["text_length", "pages", "spaced_table_cells", "total_table_cells"])
    return own.select("doc_id", "text_length").join(audit.ratios(own), "doc_id")


def escalate(plain: Corpus, ocr: Corpus | None, mode: str = "auto") -> Corpus:
    """The reading to repair: that by OCR for all documents (mode on), for none (off), or for those of little text or many spaced cells where it is clearly better (auto)."""
    if ocr is None or mode == "off":
        return plain
    if mode == "on":
        return ocr
    second = measures(ocr).select("doc_id", F.col("spaced_ratio").alias("ocr_ratio"), F.col("text_length").alias("ocr_length"))
    both = measures(plain).withColumnRenamed("text_length", "length").join(second, "doc_id", "left")
    decided = select.ocr_decision(both).select("doc_id", F.when(F.coalesce("kept", F.lit(False)), "ocr").otherwise("plain").alias("reading"))
    return _chosen({"plain": plain, "ocr": ocr}, staged(decided, "readings"))


def _boxes(rows: DataFrame, pages: DataFrame, number: Column) -> DataFrame:
    return rows.withColumn("item_no", number).join(pages, ["doc_id", "page_no"], "left").withColumn("box", to_top_left(F.col("bbox"), F.col("height"))).withColumnRenamed("height", "page_height")


def repair_spacing(c: Corpus, how: str = "pymupdf") -> Corpus:
    """Texts and cells that are spaced or cut are read again from words and glyphs, on the pages where any is."""
    if how == "off" or c.words is None or c.glyphs is None:
        return c
    chosen = staged(select.spacing_pages(c.items, c.cells, c.tables), "pages-to-repair")
    on_page = lambda df: df.join(chosen, "doc_id", "left").withColumn("page_no", F.when(F.col("pages").isNull() | (F.size("pages") == 0) | F.array_contains("pages", F.col("page_no")), F.col("page_no"))).drop("pages")
    # documents without any page to repair keep their texts
    any_page = chosen.filter("pages IS NULL OR size(pages) > 0").select("doc_id")
    cell_rows = c.cells.join(c.tables.select("doc_id", "table_no", "page_no"), ["doc_id", "table_no"]).join(any_page, "doc_id", "left_semi")
    cell_boxes = on_page(_boxes(cell_rows, c.pages, F.struct("table_no", "cell_no")))
    text_boxes = on_page(_boxes(c.items.filter("kind <> 'table'").join(any_page, "doc_id", "left_semi"), c.pages, F.col("item_no")))
    again = glyphs.repair_by_cells if how == "docling" else glyphs.repair
    new_cells = again(cell_boxes, c.words, c.glyphs, True).filter("fixed").select("doc_id", F.col("item_no.table_no").alias("table_no"), F.col("item_no.cell_no").alias("cell_no"), F.col("text").alias("_new"))
    new_items = again(text_boxes, c.words, c.glyphs, False).filter("fixed").select("doc_id", "item_no", F.col("text").alias("_new"))
    put = lambda df, new, keys: df.join(new, keys, "left").withColumn("text", F.coalesce("_new", "text")).select(*df.columns)
    return replace(c, cells=staged(put(c.cells, new_cells, ["doc_id", "table_no", "cell_no"]), "cells"), items=staged(put(c.items, new_items, ["doc_id", "item_no"]), "items"))


def repair(c: Corpus, options: Options = Options()) -> Corpus:
    """All repairs of a document's tables, pictures and texts, in their order."""
    if options.spacing_fix == "ocr" and c.ocr_cells is not None:
        c = replace(c, cells=tables.merge_spaced(c.tables, c.cells, c.ocr_tables, c.ocr_cells).select(*c.cells.columns))
    c = repair_spacing(c, {"heuristic": "pymupdf", "ocr": "off"}.get(options.spacing_fix, options.spacing_fix))
    if c.ocr_cells is not None:
        c = replace(c, cells=tables.merge_suspect(c.tables, c.cells, c.ocr_tables, c.ocr_cells).select(*c.cells.columns))
    new_tables, new_cells = tables.collapse_header_groups(c.tables, c.cells)
    # staged, as pushing filters through the cleaning would copy its expressions over and over
    new_cells = staged(tables.normalize_headers(new_cells), "headers")
    new_cells = tables.vote_currencies(staged(tables.clean_cells(new_cells), "clean-cells"))
    items = pictures.remove_axis_texts_inside_pictures(pictures.remove_dates_inside_pictures(c.items, c.pages), c.pages)
    if c.words is not None:
        items = add_captions(items, c.pages, c.words, c.ocr_items if options.kpi_ocr else None)
    items = items.withColumn("text", F.when((F.col("kind") == "table") | F.col("text").isNull(), F.col("text")).otherwise(normalize_item(F.col("text"))))
    return replace(c, tables=new_tables, cells=staged(new_cells, "voted-cells"), items=staged(items, "normal-items"))


def add_captions(items: DataFrame, pages: DataFrame, words: DataFrame, ocr_items: DataFrame | None = None) -> DataFrame:
    """Key figures in pictures become caption items right after them; where the words in a picture are none, what OCR read there may be."""
    pics = _boxes(items.filter("kind = 'picture' AND page_no IS NOT NULL AND bbox IS NOT NULL"), pages, F.col("item_no"))
    read = pictures.picture_texts(pics.withColumn("bbox", F.col("box")), words)
    said = items.filter("text IS NOT NULL").groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_no", "text"))), lambda x: x["text"]), "\n\n").alias("text"))
    every = items.select("doc_id").distinct().join(said, "doc_id", "left")
    second = ocr_items.filter("kind = 'picture' AND text <> ''").select("doc_id", "item_no", "text") if ocr_items is not None else None
    found = pictures.kpi_captions(pics.select("doc_id", "item_no", F.coalesce("n_captions", F.lit(0)).alias("n_captions")), read, every, second)
    captions = items.join(found, ["doc_id", "item_no"]).withColumn("kind", F.lit("text")).withColumn("label", F.lit("caption")).withColumn("text", F.col("caption")).select(*items.columns)
    return items.unionByName(captions)


def table_markdown(t: DataFrame, cells: DataFrame) -> DataFrame:
    """(doc_id, table_no, text): each table as a Markdown table; a spanning cell stands in all its places."""
    places = cells.select("doc_id", "table_no", F.coalesce("text", F.lit("")).alias("text"), "cell_no", F.explode(F.expr("sequence(r0, greatest(r1 - 1, r0))")).alias("r"), "c0", "c1").withColumn("c", F.explode(F.expr("sequence(c0, greatest(c1 - 1, c0))")))
    one = places.groupBy("doc_id", "table_no", "r", "c").agg(F.max_by("text", "cell_no").alias("text"))
    rows = one.groupBy("doc_id", "table_no", "r").agg(F.map_from_entries(F.collect_list(F.struct("c", "text"))).alias("m")).join(t.select("doc_id", "table_no", "num_cols"), ["doc_id", "table_no"])
    line = lambda cell: F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(0), F.col("num_cols") - 1), cell), " | "), F.lit(" |"))
    rows = rows.filter("num_cols > 0").withColumn("line", line(lambda c: F.coalesce(F.replace(F.try_element_at("m", c), F.lit("\n"), F.lit(" ")), F.lit(""))))
    rows = rows.withColumn("line", F.when(F.col("r") == 0, F.concat("line", F.lit("\n"), line(lambda c: F.lit("---")))).otherwise(F.col("line")))
    return rows.groupBy("doc_id", "table_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "line"))), lambda x: x["line"]), "\n").alias("text"))


def export(c: Corpus, labels: tuple[str, ...] = EXPORT_LABELS, page_break: str = markdown.PAGE_BREAK) -> DataFrame:
    """(doc_id, markdown): the exported items in reading order, pages apart. The k-th table item of a document is its table k."""
    nth = F.row_number().over(Window.partitionBy("doc_id", "kind").orderBy("item_no")) - 1
    own = c.items.withColumn("table_no", F.when(F.col("kind") == "table", nth))
    own = select.exported(own, labels)
    own = own.join(table_markdown(c.tables, c.cells).withColumnRenamed("text", "grid"), ["doc_id", "table_no"], "left")
    hashes = F.repeat(F.lit("#"), F.when(F.col("label") == "title", 1).otherwise(F.least(F.coalesce("level", F.lit(1)) + 1, F.lit(6))))
    text = F.when(F.col("kind") == "table", F.col("grid")).when(F.col("kind") == "picture", F.lit("<!-- image -->"))
    text = text.when(F.col("label").isin("title", "section_header"), F.concat(hashes, F.lit(" "), "text")).when(F.col("label") == "list_item", F.concat(F.lit("- "), "text")).otherwise(F.col("text"))
    blocks = own.select("doc_id", F.coalesce("page_no", F.lit(0)).alias("page_no"), "item_no", text.alias("text"), F.lit(0).alias("k")).filter("text IS NOT NULL")
    page = blocks.groupBy("doc_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_no", "text"))), lambda x: x["text"]), "\n\n").alias("text"))
    return page.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda x: x["text"]), f"\n\n{page_break}\n\n").alias("markdown"))


def convert(c: Corpus, options: Options = Options()) -> DataFrame:
    """(doc_id, markdown) of repaired and cleaned documents."""
    return markdown.clean(export(repair(c, options)), remove_images=options.image_mode == "placeholder")


def read_and_convert(readings: dict[str, Corpus], ocr: Corpus | None = None, options: Options = Options()) -> DataFrame:
    """The whole conversion: choose the backend, then whether OCR's reading is better, then repair, export and clean."""
    return convert(escalate(choose_backend(readings, options.pdf_backend), ocr, options.ocr_mode), options)
