"""A score of Markdown from its noise and repetition, computed inside each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.regex import count_of, let, split_lines, strip


def report(text: Column) -> Column:
    """struct(score, short_line_count, repeated_line_count, control_char_count)."""

    def of_lines(lines: Column) -> Column:
        short = F.filter(lines, lambda x: (F.length(F.replace(x, F.lit(" "), F.lit(""))) <= 4) & x.rlike(r"\p{L}"))
        told = F.filter(lines, lambda x: (F.length(x) >= 6) & ~x.rlike(r"^(?:<!-- image|<!-- page break|#)"))
        # a line occurs three times if the sorted lines hold it again two places on; texts that lack two lines of their distinct ones aren't sorted
        thrice = lambda s: F.array_distinct(F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 2) == x, F.lit(False))))
        often = let(F.transform(told, F.lower), lambda x: F.when(F.size(x) - F.size(F.array_distinct(x)) < 2, F.array().cast("array<string>")).otherwise(let(F.sort_array(x), thrice)))
        control = count_of(text, r"[\x00-\x1f&&[^\n\t]]")
        return let(
            F.struct(F.size(short).cast("long").alias("s"), F.size(often).cast("long").alias("r"), control.cast("long").alias("c")),
            lambda n: F.struct(
                F.greatest(100 - 5 * n["s"] - 2 * n["r"] - n["c"], F.lit(0)).cast("long").alias("score"), n["s"].alias("short_line_count"), n["r"].alias("repeated_line_count"), n["c"].alias("control_char_count")
            ),
        )

    return let(F.transform(split_lines(text), strip), of_lines)


def score(docs: DataFrame, text_col: str = "text", *keep: str) -> DataFrame:
    """The report of each row's text, beside the kept columns."""
    return docs.select(*(keep or ("doc_id",)), report(F.coalesce(F.col(text_col), F.lit(""))).alias("_q")).select(*(keep or ("doc_id",)), "_q.*")


def format_report(r: Column) -> Column:
    return F.format_string("score=%d short_lines=%d repeated_lines=%d control_chars=%d", r["score"], r["short_line_count"], r["repeated_line_count"], r["control_char_count"])
