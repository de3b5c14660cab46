"""Markdown by page, block and line.

A document is a row with its Markdown; every pass is a function of that text alone. What looks across pages does so over the array of a document's pages,
inside the row, so nothing is shuffled, rows may share an id or have none, and all other columns stay. Null stays null.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.detect import is_axis
from quillmill.functions.kpi import is_kpi_label, is_kpi_value
from quillmill.functions.regex import S, casefold, is_blank, let, rstrip, split_lines, squeeze, strip, words

PAGE_BREAK = "<!-- page break -->"
# The three notations of a page number.
MARKER = rf"(?i)(?:<!--{S}*page:{S}*\p{{Nd}}+{S}*-->|\[//\]:{S}*#{S}*\({S}*page:{S}*\p{{Nd}}+{S}*\)|\*\*{S}*\[page:?{S}*\p{{Nd}}+\]{S}*\*\*)"
IMAGE = rf"^{S}*<!--{S}*image{S}*-->{S}*\z"
HEADING = rf"^(#{{1,6}}){S}+([^\n]+?){S}*\z"


def _is_marker(line: Column) -> Column:
    return line.rlike(rf"\A{MARKER}")


def _parts(markdown: Column, page_break: str) -> Column:
    return F.split(markdown, re.escape(page_break))


def page_texts(markdown: Column, page_break: str = PAGE_BREAK) -> Column:
    """The pages that aren't blank, stripped; a text without page breaks is one page as it is."""
    kept = F.filter(F.transform(_parts(markdown, page_break), strip), lambda p: p != "")
    return F.when(markdown.contains(page_break), kept).otherwise(F.array(markdown))


def split_pages(docs: DataFrame, page_break: str = PAGE_BREAK) -> DataFrame:
    """One row per page: doc_id, chunk_no from 0, text."""
    return docs.select("doc_id", F.posexplode(page_texts(F.col("markdown"), page_break)).alias("chunk_no", "text"))


def strip_page_markers(markdown: Column) -> Column:
    return F.regexp_replace(markdown, MARKER, "")


def add_page_markers(markdown: Column, page_break: str = PAGE_BREAK, visible: bool = True) -> Column:
    """Old markers go; each page that isn't blank gets its number, from 1, in front."""
    head, tail = ("**[Page ", "]**") if visible else ("[//]: # (page: ", ")")

    def mark(text: Column) -> Column:
        marked = F.transform(page_texts(text, page_break), lambda p, i: F.concat(F.lit(head), (i + 1).cast("string"), F.lit(tail + "\n\n"), strip(p)))
        return F.when(is_blank(text) & ~text.contains(page_break), text).otherwise(F.array_join(marked, f"\n\n{page_break}\n\n"))

    return let(strip_page_markers(markdown), mark)


def heading_count(markdown: Column) -> Column:
    return F.size(F.filter(split_lines(markdown), lambda x: x.rlike(rf"^{S}*#"))).cast("long")


def table_count(markdown: Column) -> Column:
    """Separator lines of tables below a line with a bar."""

    def count(lines: Column) -> Column:
        hit = lambda x, i: (i > 0) & strip(x).rlike(r"^\|") & x.contains("---") & F.get(lines, i - 1).contains("|")
        return F.size(F.filter(lines, hit)).cast("long")

    return let(split_lines(markdown), count)


# --- passes over one page at a time ---------------------------------------------------------------


def _each_page(markdown: Column, page_break: str, change) -> Column:
    pages = F.transform(_parts(markdown, page_break), change)
    return F.when(is_blank(markdown), markdown).otherwise(F.array_join(pages, f"\n\n{page_break}\n\n"))


def remove_axis_lines(markdown: Column, page_break: str = PAGE_BREAK) -> Column:
    """Lines of chart axes go; markers, images, headings and table lines never do."""
    protected = lambda s: _is_marker(s) | s.rlike(IMAGE) | s.rlike(HEADING) | s.contains("|")
    keep = lambda line: let(strip(line), lambda s: (s == "") | protected(s) | ~is_axis(s))
    return _each_page(markdown, page_break, lambda p: F.array_join(F.filter(split_lines(p), keep), "\n"))


def merge_kpi_blocks(markdown: Column, page_break: str = PAGE_BREAK) -> Column:
    """A block that is a label takes up to two value blocks that follow it into its line."""

    def add(state: Column, block: Column) -> Column:
        takes = (state["free"] > 0) & is_kpi_value(block)
        last = F.element_at(state["done"], -1)
        longer = F.concat(F.slice(state["done"], 1, F.greatest(F.size(state["done"]) - 1, F.lit(0))), F.array(F.concat(last, F.lit(" "), squeeze(block))))
        done = F.when(takes, longer).otherwise(F.concat(state["done"], F.array(block)))
        free = F.when(takes, state["free"] - 1).otherwise(F.when(is_kpi_label(block), 2).otherwise(0))
        return F.struct(done.alias("done"), free.alias("free"))

    def page(p: Column) -> Column:
        blocks = F.transform(F.filter(F.split(p, "\n{2,}"), lambda b: ~is_blank(b)), strip)
        start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(0).alias("free"))
        return F.array_join(F.aggregate(blocks, start, add)["done"], "\n\n")

    return _each_page(markdown, page_break, page)


# --- passes across pages ---------------------------------------------------------------------------


def _meaningful(lines: Column) -> Column:
    """The lines of a page, stripped, that aren't blank, an image or a page marker."""
    return F.filter(F.transform(lines, strip), lambda x: (x != "") & ~x.rlike(IMAGE) & ~_is_marker(x))


def _heading_key(line: Column) -> Column:
    return F.when(line.rlike(HEADING), casefold(squeeze(F.regexp_extract(line, HEADING, 2))))


def without_noise(markdown: Column, page_break: str = PAGE_BREAK, remove_images: bool = False, ratio: float = 0.3, least: int = 3) -> Column:
    """Headings that open many pages stay on the first of these only; image placeholders can go."""

    def cleaned(lines: Column, heading: Column, out: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: _heading_key(strip(F.get(lines, i))).eqNullSafe(heading))
        gone = F.when((out >= 0) & (F.size(lines) > 0), F.get(at, out))
        said = F.filter(lines, lambda x: ~strip(x).rlike(IMAGE)) if remove_images else lines
        marked = let(gone, lambda g: F.filter(lines, lambda x, i: F.coalesce(i != g, F.lit(True)) & ~(F.lit(remove_images) & strip(x).rlike(IMAGE))))
        return F.array_join(F.when(out < 0, said).otherwise(marked), "\n")

    def pages(page: Column) -> Column:
        keys = F.transform(page, lambda p: p["heading"])
        times = F.greatest(F.lit(least), F.floor(F.size(page) * ratio + 0.999).cast("int"))
        # in the sorted keys one that is there so often meets itself again that far on; there can be few of them
        often = let(F.sort_array(F.array_compact(keys)), lambda s: F.array_distinct(F.filter(s, lambda x, i: F.coalesce(F.get(s, i + times - 1) == x, F.lit(False)))))
        first = let(F.when(F.size(page) > 1, often).otherwise(F.array().cast("array<string>")), lambda found: F.transform(found, lambda h: F.struct(h.alias("heading"), F.array_position(keys, h).alias("page"))))

        def one(first: Column) -> Column:
            def of(p: Column, i: Column) -> Column:
                own = F.get(F.filter(first, lambda f: f["heading"].eqNullSafe(p["heading"])), F.lit(0))
                # the heading stays once: of the first page the second match goes, of the others the first
                return cleaned(p["lines"], p["heading"], F.when(own.isNull(), -1).when(own["page"] == i + 1, 1).otherwise(0))

            return F.transform(page, of)

        return F.array_join(let(first, one), f"\n\n{page_break}\n\n")

    page = F.transform(_parts(markdown, page_break), lambda p: let(split_lines(p), lambda x: F.struct(x.alias("lines"), _heading_key(F.get(_meaningful(x), F.lit(0))).alias("heading"))))
    return F.when(is_blank(markdown), markdown).otherwise(let(page, pages))


def reduce_noise(docs: DataFrame, page_break: str = PAGE_BREAK, remove_images: bool = False, ratio: float = 0.3, least: int = 3) -> DataFrame:
    return docs.withColumn("markdown", without_noise(F.col("markdown"), page_break, remove_images, ratio, least))


def is_heading_like(line: Column) -> Column:
    """A line of at least three words that begins with a capital, has no digit and ends no sentence."""
    s = strip(line)
    plain = (s != "") & ~s.rlike(HEADING) & ~_is_marker(s) & ~s.rlike(IMAGE) & ~s.rlike(r"\p{Nd}")
    return plain & (F.length(s) <= 120) & ~s.rlike(r"[.!?;:]\z") & (F.size(words(s)) >= 3) & F.regexp_extract(s, r"(\p{L})", 1).rlike(r"^\p{Lu}\z")


def without_orphan_headings(markdown: Column, page_break: str = PAGE_BREAK) -> Column:
    """A heading at the end of a page goes if nothing of its own follows on the pages after."""
    level = lambda x: F.length(F.regexp_extract(x, HEADING, 1))

    def orphan(last: Column, after: Column) -> Column:
        nothing = after.isNull() | (after.rlike(HEADING) & (level(after) <= level(last))) | is_heading_like(after)
        return F.coalesce(last.rlike(HEADING) & nothing, F.lit(False))

    def without(part: Column) -> Column:
        n = lambda lines: F.array_max(F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: ~is_blank(F.get(lines, i))))
        return let(split_lines(part), lambda lines: rstrip(F.array_join(F.slice(lines, F.lit(1), F.coalesce(n(lines), F.lit(0))), "\n")))

    def pages(parts: Column) -> Column:
        def ends(part: Column, i: Column) -> Column:
            lines = F.filter(F.transform(split_lines(part), strip), lambda x: x != "")
            return let(lines, lambda x: F.struct(i.alias("page"), F.get(_meaningful(x), F.lit(0)).alias("first"), F.element_at(F.concat(F.array(F.lit("")), x), -1).alias("last")))

        # a page without a line of its own ends in no heading
        told = F.filter(F.transform(parts, ends), lambda e: e["first"].isNotNull())
        gone = let(told, lambda t: F.transform(F.filter(F.transform(t, lambda e, k: F.struct(e["page"].alias("page"), orphan(e["last"], F.get(t, k + 1)["first"]).alias("orphan"))), lambda e: e["orphan"]), lambda e: e["page"]))
        return let(gone, lambda g: F.array_join(F.transform(parts, lambda p, i: F.when(F.array_contains(g, i), without(p)).otherwise(p)), f"\n\n{page_break}\n\n"))

    return F.when(is_blank(markdown), markdown).otherwise(let(_parts(markdown, page_break), pages))


def remove_orphan_headings(docs: DataFrame, page_break: str = PAGE_BREAK) -> DataFrame:
    return docs.withColumn("markdown", without_orphan_headings(F.col("markdown"), page_break))


def clean(docs: DataFrame, page_break: str = PAGE_BREAK, remove_images: bool = False) -> DataFrame:
    """All passes over exported Markdown, in their order."""
    md = F.col("markdown")
    out = reduce_noise(docs.withColumn("markdown", add_page_markers(md, page_break)), page_break, remove_images)
    out = remove_orphan_headings(out.withColumn("markdown", merge_kpi_blocks(md, page_break)), page_break)
    return out.withColumn("markdown", remove_axis_lines(md, page_break))
