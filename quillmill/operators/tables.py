"""Repairs of extracted tables, and joins of two readings of one document.

tables: doc_id, table_no, page_no, num_rows, num_cols. cells: doc_id, table_no, cell_no, r0, r1, c0, c1 (half-open spans), text, bbox, column_header, row_header, row_section, fillable. cell_no is
the order of the cells in their table; table_no that of the tables in their document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import extract
from quillmill.functions.cells import CURRENCY, clean_cell, clean_header, is_suspect, should_replace_numeric
from quillmill.functions.detect import is_spaced
from quillmill.functions.geometry import area, intersection_area, union_of
from quillmill.functions.regex import count_of, digits, let, strip

KEY = ["doc_id", "table_no"]
_FLAGS = ("column_header", "row_header", "row_section", "fillable")


def normalize_headers(cells: DataFrame) -> DataFrame:
    """Cleans the cells of the first row."""
    return cells.withColumn("text", F.when(F.col("r0") == 0, clean_header(F.col("text"))).otherwise(F.col("text")))


def clean_cells(cells: DataFrame) -> DataFrame:
    return cells.withColumn("text", clean_cell(F.col("text")))


def changes(rows: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(doc_id, changed): how many rows' texts a step that keeps the rows changes, for each document that has any."""
    after = step(rows.withColumn("_before", F.col("text")))
    return after.groupBy("doc_id").agg(F.count_if(~F.col("text").eqNullSafe(F.col("_before"))).alias("changed"))


def suspect_cells(cells: DataFrame) -> DataFrame:
    """The number of cells per document whose cleaned number is broken."""
    return cells.groupBy("doc_id").agg(F.sum(let(clean_cell(F.coalesce("text", F.lit(""))), is_suspect).cast("long")).alias("suspect_cells"))


def collapse_header_groups(tables: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Columns under one spanning header cell become one. A table whose first row doesn't tile its columns, or spans none, stays as it is."""
    head = cells.filter("r0 = 0").groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("c0", "c1"))).alias("h"))
    head = head.join(tables.select(*KEY, "num_cols"), KEY)
    tiled = F.forall(F.sequence(F.lit(0), F.size("h") - 1), lambda i: (F.get("h", i)["c0"] == F.coalesce(F.get("h", i - 1)["c1"], F.lit(0))) & (F.get("h", i)["c1"] > F.get("h", i)["c0"]))
    head = head.filter(tiled & (F.element_at("h", -1)["c1"] == F.col("num_cols")) & F.exists("h", lambda g: g["c1"] - g["c0"] > 1)).select(*KEY, "h")

    group_of = lambda c: F.size(F.filter("h", lambda g: g["c0"] <= c)) - 1
    moved = cells.join(head, KEY).withColumn("n0", group_of(F.col("c0"))).withColumn("n1", group_of(F.col("c1") - 1) + 1)
    parts = F.array_sort(F.collect_list(F.struct("c0", "cell_no", F.coalesce("text", F.lit("")).alias("text"), "bbox")))
    merged = moved.groupBy(*KEY, "r0", "r1", "n0", "n1").agg(parts.alias("p"), *[F.bool_or(f).alias(f) for f in _FLAGS])
    text = F.array_join(F.filter(F.transform("p", lambda x: strip(x["text"])), lambda t: t != ""), " ")
    boxes = F.filter(F.transform("p", lambda x: x["bbox"]), lambda b: b.isNotNull())
    order = Window.partitionBy(*KEY).orderBy("r0", "n0", "r1", "n1")
    merged = merged.select(*KEY, (F.row_number().over(order) - 1).alias("cell_no"), "r0", "r1", F.col("n0").alias("c0"), F.col("n1").alias("c1"), text.alias("text"), union_of(boxes).alias("bbox"), *_FLAGS)
    rest = cells.join(head.select(*KEY), KEY, "left_anti").select(*merged.columns)
    narrow = tables.join(head.select(*KEY, F.size("h").alias("groups")), KEY, "left")
    narrow = narrow.withColumn("num_cols", F.coalesce("groups", "num_cols")).drop("groups")
    return narrow.select(*tables.columns), rest.unionByName(merged)


def vote_currencies(cells: DataFrame, least: int = 2, share: float = 0.7) -> DataFrame:
    """Cells of a column that mostly names one currency, named first in each cell, take that currency."""
    counted = (F.col("r0") != 0) & (F.col("c1") - F.col("c0") == 1)
    own = F.regexp_extract(F.coalesce("text", F.lit("")), CURRENCY, 1)
    marked = cells.withColumn("_own", F.when(counted & (own != ""), own))
    votes = marked.filter("_own IS NOT NULL").groupBy(*KEY, "c0").agg(F.count("*").alias("n"), *[F.count_if(F.col("_own") == c).alias(c) for c in ("RON", "EUR")])
    won = votes.filter((F.col("n") >= least) & (F.greatest("RON", "EUR") / F.col("n") >= share)).select(*KEY, "c0", F.when(F.col("RON") >= F.col("EUR"), "RON").otherwise("EUR").alias("_won"))
    out = marked.join(won, [*KEY, "c0"], "left")
    return out.withColumn("text", F.when(F.col("_own") != F.col("_won"), F.regexp_replace("text", CURRENCY, F.col("_won"))).otherwise(F.col("text"))).select(*cells.columns)


def toc_like(tables: DataFrame, cells: DataFrame) -> DataFrame:
    """tables with toc_like: two columns, six rows or more, mostly letters, and small numbers."""
    texts = cells.filter("text <> ''").groupBy(*KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cell_no", "text"))), lambda x: x["text"]), " ").alias("t"))

    def by_numbers(n: Column) -> Column:
        small = F.size(F.filter(n, lambda x: F.length(digits(x)) <= 3))
        return (F.size(n) > 0) & (small >= 0.7 * F.size(n))

    d, a = count_of(F.col("t"), r"\p{Nd}"), count_of(F.col("t"), r"\p{L}")
    few_digits = d <= 0.25 * F.greatest(d + a, F.lit(1))
    shape = (F.col("num_cols") == 2) & (F.col("num_rows") >= 6)
    like = F.when(shape & F.col("t").isNotNull(), few_digits & let(extract.numbers(F.col("t")), by_numbers)).otherwise(False)
    return tables.join(texts, KEY, "left").withColumn("toc_like", F.coalesce(like, F.lit(False))).drop("t")


def table_stats(tables: DataFrame, cells: DataFrame) -> DataFrame:
    """Per document the number of tables that aren't tables of contents, and of their cells by shape."""
    real = toc_like(tables, cells).filter("NOT toc_like")
    return real.groupBy("doc_id").agg(F.count("*").alias("table_count_pdf"), F.sum((F.col("num_rows") * F.col("num_cols")).cast("long")).alias("table_cells_pdf"))


# --- two readings of a document --------------------------------------------------------------------


def _paired(base: DataFrame, other: DataFrame) -> DataFrame:
    """Tables of one page and shape, the k-th with the k-th, which is what first-fit in table order gives."""
    nth = F.row_number().over(Window.partitionBy("doc_id", "page_no", "num_rows", "num_cols").orderBy("table_no"))
    a = base.filter("page_no IS NOT NULL").withColumn("k", nth)
    b = other.filter("page_no IS NOT NULL").withColumn("k", nth).withColumnRenamed("table_no", "other_no")
    return a.join(b.select("doc_id", "page_no", "num_rows", "num_cols", "k", "other_no"), ["doc_id", "page_no", "num_rows", "num_cols", "k"]).select("doc_id", "table_no", "other_no")


def _by_shape(tables: DataFrame, cells: DataFrame, other_tables: DataFrame, other_cells: DataFrame) -> DataFrame:
    """cells with shape_text, the other reading's text at the same span of the paired table; the last of several."""
    span = ["r0", "r1", "c0", "c1"]
    last = other_cells.groupBy("doc_id", F.col("table_no").alias("other_no"), *span).agg(F.max_by("text", "cell_no").alias("shape_text"))
    out = cells.join(_paired(tables, other_tables), KEY, "left")
    return out.join(last, ["doc_id", "other_no", *span], "left").drop("other_no").withColumn("shape_text", F.coalesce("shape_text", F.lit("")))


def _by_place(cells: DataFrame, tables: DataFrame, other_tables: DataFrame, other_cells: DataFrame, wanted: Column, accept) -> DataFrame:
    """cells with place_text: of the other reading's cells on the page that cover the cell well, the best accepted; the first among equals.

    Boxes meet on (doc_id, page_no); their number is that of one page's cells on both sides.
    """
    page = tables.select(*KEY, "page_no")
    here = cells.filter(wanted & F.col("bbox").isNotNull()).join(page, KEY).filter((area(F.col("bbox")) > 0) & F.col("page_no").isNotNull())
    there = other_cells.filter("bbox IS NOT NULL AND text <> ''").join(other_tables.select(*KEY, "page_no"), KEY)
    there = there.select("doc_id", "page_no", F.col("table_no").alias("_t"), F.col("cell_no").alias("_c"), F.col("text").alias("_text"), F.col("bbox").alias("_box")).filter(area(F.col("_box")) > 0)
    inter = intersection_area(F.col("bbox"), F.col("_box"))
    a, b = inter / area(F.col("bbox")), inter / area(F.col("_box"))
    met = here.join(there, ["doc_id", "page_no"]).filter((a >= 0.5) & (b >= 0.15) & accept(F.col("text"), F.col("_text")))
    best = met.groupBy(*KEY, "cell_no").agg(F.max_by("_text", F.struct((a * 0.7 + b * 0.3).alias("s"), -F.col("_t"), -F.col("_c"))).alias("place_text"))
    return cells.join(best, [*KEY, "cell_no"], "left")


def merge_spaced(tables: DataFrame, cells: DataFrame, other_tables: DataFrame, other_cells: DataFrame) -> DataFrame:
    """cells with spaced texts replaced by the other reading's, by shape or else by place; was_spaced and replaced tell which."""
    out = _by_shape(tables, cells, other_tables, other_cells).withColumn("was_spaced", is_spaced(F.coalesce("text", F.lit(""))))
    hit = F.col("was_spaced") & (F.col("shape_text") != "") & ~is_spaced(F.col("shape_text"))
    out = out.withColumn("replaced", hit.cast("long")).withColumn("text", F.when(hit, F.col("shape_text")).otherwise(F.col("text"))).drop("shape_text")
    out = _by_place(out, tables, other_tables, other_cells, F.col("was_spaced") & (F.col("replaced") == 0), lambda old, new: ~is_spaced(new))
    out = out.withColumn("replaced", F.col("replaced") + F.col("place_text").isNotNull().cast("long"))
    return out.withColumn("text", F.coalesce("place_text", "text")).drop("place_text")


def merge_suspect(tables: DataFrame, cells: DataFrame, other_tables: DataFrame, other_cells: DataFrame) -> DataFrame:
    """cells with numbers replaced that lost digits, by shape and then by place; replaced counts the times, up to two."""
    out = _by_shape(tables, cells, other_tables, other_cells)
    hit = should_replace_numeric(F.coalesce("text", F.lit("")), F.col("shape_text"))
    out = out.withColumn("_hit", hit).withColumn("text", F.when(F.col("_hit"), F.col("shape_text")).otherwise(F.col("text"))).withColumn("replaced", F.col("_hit").cast("long")).drop("shape_text", "_hit")
    out = _by_place(out, tables, other_tables, other_cells, F.coalesce("text", F.lit("")) != "", lambda old, new: ~is_spaced(new))
    better = should_replace_numeric(F.coalesce("text", F.lit("")), F.coalesce("place_text", F.lit("")))  # of the best placed only
    out = out.withColumn("_better", better).withColumn("place_text", F.when(F.col("_better"), F.col("place_text"))).drop("_better")
    out = out.withColumn("replaced", F.col("replaced") + F.col("place_text").isNotNull().cast("long"))
    return out.withColumn("text", F.coalesce("place_text", "text")).drop("place_text")
