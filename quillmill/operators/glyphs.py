"""Texts rebuilt from the places of words and glyphs, and their use where an extracted text is spaced or cut.

words: doc_id, page_no, block_no, line_no, word_no, text, x0, y0, x1, y1. glyphs: doc_id, page_no, glyph_no, ch, x0, y0, x1, y1. Boxes to look in: doc_id, item_no, page_no, box, and
page_height where it is known. A box's words and glyphs are gathered into one array, which is as large as a cell or a paragraph, and read there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.detect import facts, needs_spacing_fix, needs_table_cell_repair, prefers
from quillmill.functions.geometry import clip
from quillmill.functions.regex import let
from quillmill.functions.text import compact_numeric_spacing
from quillmill.sources.io import staged

GAP_RATIO, LINE_RATIO, SPACE_RATIO, PAD, IOS = 0.35, 0.6, 0.6, 1.0, 0.2


def gap_threshold(gaps: np.ndarray, width: float, ratio: float) -> float:
    """What separates gaps inside words from gaps between words: the middle of two clusters, if they are clearly two."""
    fallback = width * ratio
    if len(gaps) < 2:
        return fallback
    low, high = float(gaps.min()), float(gaps.max())
    near = np.abs(gaps - low) <= np.abs(gaps - high)
    for _ in range(8):
        near = np.abs(gaps - low) <= np.abs(gaps - high)
        means = [float(g.mean()) if len(g) else c for g, c in ((gaps[near], low), (gaps[~near], high))]
        if abs(means[0] - low) < 1e-3 and abs(means[1] - high) < 1e-3:
            break
        low, high = means
    if near.all() or not near.any() or abs(high - low) < 0.3 * width:
        return fallback
    return (low + high) / 2


def _lines(y: np.ndarray, x: np.ndarray, tolerance: float) -> list[np.ndarray]:
    """Indices by line: from the top, a new line where the centre is away from that of the line's first member; from the left inside a line."""
    order, out, anchor = np.lexsort((x, y)), [], None
    for i in order:
        if anchor is None or abs(y[i] - anchor) > tolerance:
            out.append([])
            anchor = y[i]
        out[-1].append(i)
    return [np.array(sorted(line, key=lambda i: x[i])) for line in out]


def _median(values: np.ndarray) -> float:
    return float(np.median(values)) if len(values) else 1.0


def read_pieces(pieces: list, gap_ratio: float = GAP_RATIO, line_ratio: float = LINE_RATIO, space_ratio: float = SPACE_RATIO, whole_words: bool = False) -> str:
    """The text of pieces (text, x0, y0, x1, y1), glyphs or whole words. Glyphs that are blanks count if they are wide enough."""
    if pieces is None or not len(pieces):
        return ""
    text = [p["text"] for p in pieces]
    x0, y0, x1, y1 = (np.array([p[k] for p in pieces], float) for k in ("x0", "y0", "x1", "y1"))
    out = []
    for line in _lines((y0 + y1) / 2, x0, _median(y1 - y0) * line_ratio):
        blank = np.array([not whole_words and text[i].isspace() for i in line])
        widths = (x1 - x0)[line] / ([max(len(text[i]), 1) for i in line] if whole_words else 1)
        width = _median(widths[~blank])
        gaps = x0[line][1:] - x1[line][:-1]
        limit = gap_threshold(gaps[gaps >= 0], width, gap_ratio)
        said, before, wide = "", None, None
        for i, is_blank in zip(line, blank, strict=True):
            if is_blank:
                wide = max(wide or 0.0, x1[i] - x0[i])
                continue
            apart = wide >= width * space_ratio if wide is not None else before is not None and x0[i] - before > limit
            said += " " * bool(apart) + text[i]
            before, wide = x1[i], None
        if said.strip():
            out.append(said.strip())
    return " ".join(out).strip()


def _reader(whole_words: bool, gap_ratio: float, line_ratio: float, space_ratio: float):
    @F.pandas_udf("string")
    def read(pieces: pd.Series) -> pd.Series:
        return pieces.map(lambda p: read_pieces(p, gap_ratio, line_ratio, space_ratio, whole_words))

    return read


def read_glyphs(pieces: Column, gap_ratio: float = GAP_RATIO, line_ratio: float = LINE_RATIO, space_ratio: float = SPACE_RATIO) -> Column:
    """The text of an array of struct(text, x0, y0, x1, y1), one glyph each."""
    return _reader(False, gap_ratio, line_ratio, space_ratio)(pieces)


def read_words(pieces: Column, gap_ratio: float = GAP_RATIO, line_ratio: float = LINE_RATIO) -> Column:
    """The same of whole words, joined where they touch."""
    return _reader(True, gap_ratio, line_ratio, 0.0)(pieces)


def _grown(boxes: DataFrame, pad: float) -> DataFrame:
    """boxes with each box grown by pad, but not beyond its page where that has a height."""
    far = 1e12
    height = F.col("page_height") if "page_height" in boxes.columns else F.lit(None).cast("double")
    page = F.struct(F.lit(-far).alias("l"), F.when(height.isNull(), -far).otherwise(0.0).alias("t"), F.lit(far).alias("r"), F.coalesce(height, F.lit(far)).alias("b"))
    return boxes.withColumn("box", clip(F.col("box"), page, pad))


def _meets() -> Column:
    b = F.col("box")
    return (F.col("x1") > b["l"]) & (F.col("x0") < b["r"]) & (F.col("y1") > b["t"]) & (F.col("y0") < b["b"])


def _mostly_in(ios: float) -> Column:
    b = F.col("box")
    common = F.greatest(F.least("x1", b["r"]) - F.greatest("x0", b["l"]), F.lit(0.0)) * F.greatest(F.least("y1", b["b"]) - F.greatest("y0", b["t"]), F.lit(0.0))
    return common > F.lit(ios) * (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))


def glyphs_in(boxes: DataFrame, glyphs: DataFrame, condition: Column) -> DataFrame:
    """(doc_id, item_no, pieces): the glyphs in each box, in their order."""
    met = boxes.select("doc_id", "item_no", "page_no", "box").join(glyphs.filter("ch <> ''"), ["doc_id", "page_no"]).filter(condition)
    return met.groupBy("doc_id", "item_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("glyph_no", F.col("ch").alias("text"), "x0", "y0", "x1", "y1"))), lambda p: F.struct(p["text"].alias("text"), p["x0"].alias("x0"), p["y0"].alias("y0"), p["x1"].alias("x1"), p["y1"].alias("y1"))).alias("pieces"))


def words_in(boxes: DataFrame, words: DataFrame, condition: Column) -> DataFrame:
    """(doc_id, item_no, text): the words in each box by block, line and number."""
    met = boxes.select("doc_id", "item_no", "page_no", "box").join(words.filter("text <> ''"), ["doc_id", "page_no"]).filter(condition)
    return met.groupBy("doc_id", "item_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "line_no", "word_no", "text"))), lambda x: x["text"]), " ").alias("text"))


def _candidates(boxes: DataFrame, words: DataFrame, glyphs: DataFrame, pad: float, name: str) -> DataFrame:
    grown = _grown(boxes, pad)
    w = words_in(grown, words, _meets()).withColumnRenamed("text", "w")
    g = glyphs_in(grown, glyphs, _meets()).select("doc_id", "item_no", read_glyphs(F.col("pieces")).alias("g"))
    both = w.join(g, ["doc_id", "item_no"], "full")
    tidy = lambda c: compact_numeric_spacing(F.trim(F.coalesce(c, F.lit(""))))
    return both.select("doc_id", "item_no", tidy(F.col("w")).alias(f"{name}_w"), tidy(F.col("g")).alias(f"{name}_g"))


def _chosen(read: Column, table_mode: bool) -> Column:
    """The text to take, or null: read holds the facts of the text itself and of its readings by words and by glyphs, in the box and in a wider one.

    All are compared with all first, so that what follows only looks up numbers of readings.
    """
    said, words, glyphs, wide_words, wide_glyphs = (F.lit(i) for i in range(5))

    def choose(better: Column) -> Column:
        at = lambda i: F.get(read, i)
        takes = lambda i, j: (at(j)["text"] != "") & F.get(F.get(better, i), j)

        def longer(i: Column) -> Column:
            if not table_mode:
                return i
            return F.when(~at(i)["cut"], i).when(takes(i, wide_words), wide_words).when(takes(i, wide_glyphs), wide_glyphs).otherwise(i)

        w = F.when((at(words)["text"] != "") & ~at(words)["fix"], longer(words))
        if table_mode:
            tries = [(w, F.lit(True)), (longer(glyphs), F.lit(True)), (longer(said), at(said)["cut"])]
            picks = F.array(*[F.when(ok & takes(said, i), at(i)["text"]) for i, ok in tries])
        else:  # words that read well settle the matter, taken or not
            picks = F.array(F.when(w.isNotNull(), F.when(takes(said, w), at(w)["text"])).when(takes(said, glyphs), at(glyphs)["text"]))
        return F.get(F.filter(picks, lambda t: t.isNotNull()), F.lit(0))

    return let(F.transform(read, lambda a: F.transform(read, lambda b: prefers(a, b, table_mode))), choose)


def repair(boxes: DataFrame, words: DataFrame, glyphs: DataFrame, table_mode: bool, pad: float = PAD) -> DataFrame:
    """boxes (with text) plus fixed: the words or glyphs of the box, where they read better than the text, which is then replaced.

    For cells, a reading whose last word seems cut is first tried again in a box three times as padded.
    """
    own = F.coalesce(F.col("text"), F.lit(""))
    wanted = boxes.filter(needs_table_cell_repair(own) if table_mode else needs_spacing_fix(own)).filter("box IS NOT NULL AND page_no IS NOT NULL")
    kept = [c for c in ("doc_id", "item_no", "page_no", "page_height", "box", "text") if c in boxes.columns]
    wanted = staged(wanted.select(*kept), "to-repair")  # it meets words and glyphs several times
    c = wanted.join(_candidates(wanted, words, glyphs, pad, "n"), ["doc_id", "item_no"], "left")
    if table_mode:
        c = c.join(_candidates(wanted, words, glyphs, 3 * pad, "f"), ["doc_id", "item_no"], "left")
    readings = [F.coalesce(n, F.lit("")) if n in c.columns else F.lit("") for n in ("n_w", "n_g", "f_w", "f_g")]
    best = let(F.transform(F.array(own, *readings), facts), lambda read: _chosen(read, table_mode))
    fixes = c.select("doc_id", "item_no", best.alias("_best"))
    out = boxes.join(fixes, ["doc_id", "item_no"], "left")
    return out.withColumn("fixed", F.col("_best").isNotNull()).withColumn("text", F.coalesce("_best", "text")).select(*boxes.columns, "fixed")


def repair_by_cells(boxes: DataFrame, words: DataFrame, glyphs: DataFrame, table_mode: bool, ios: float = IOS) -> DataFrame:
    """The simpler repair: words (cells only), else glyphs, that lie in the box by the share `ios` of their own area; taken if they read well."""
    own = F.coalesce(F.col("text"), F.lit(""))
    wanted = staged(boxes.filter(needs_spacing_fix(own)).filter("box IS NOT NULL AND page_no IS NOT NULL").select("doc_id", "item_no", "page_no", "box", "text"), "to-repair")
    as_glyphs = words.select("doc_id", "page_no", F.row_number().over(_in_order()).alias("glyph_no"), F.col("text").alias("ch"), "x0", "y0", "x1", "y1")
    w = glyphs_in(wanted, as_glyphs, _mostly_in(ios)).select("doc_id", "item_no", read_words(F.col("pieces")).alias("_w"))
    g = glyphs_in(wanted, glyphs, _mostly_in(ios)).select("doc_id", "item_no", read_glyphs(F.col("pieces")).alias("_g"))
    c = wanted.join(w, ["doc_id", "item_no"], "left").join(g, ["doc_id", "item_no"], "left")
    good = lambda x: (F.coalesce(x, F.lit("")) != "") & ~needs_spacing_fix(F.coalesce(x, F.lit("")))
    best = F.when(F.lit(table_mode) & good("_w"), F.col("_w")).when(good("_g"), F.col("_g"))
    out = boxes.join(c.select("doc_id", "item_no", best.alias("_best")), ["doc_id", "item_no"], "left")
    return out.withColumn("fixed", F.col("_best").isNotNull()).withColumn("text", F.coalesce("_best", "text")).select(*boxes.columns, "fixed")


def _in_order():
    from pyspark.sql import Window

    return Window.partitionBy("doc_id", "page_no").orderBy("block_no", "line_no", "word_no")


def repair_report(cells: DataFrame, items: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(doc_id, table_cells, text_items, pages_processed) from the repaired cells and items and the pages chosen; null pages means all, and counts as 0."""
    n = lambda df, name: df.groupBy("doc_id").agg(F.sum(F.col("fixed").cast("long")).alias(name))
    out = n(cells, "table_cells").join(n(items, "text_items"), "doc_id", "full")
    out = out.withColumn("pages_processed", F.lit(0).cast("long")) if pages is None else out.join(pages.groupBy("doc_id").agg(F.count("*").alias("pages_processed")), "doc_id", "left")
    return out.select("doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("table_cells", "text_items", "pages_processed")])
