"""Key-figure texts in pictures and Markdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.regex import B0, B1, D, LETTER, W, count_of, find_all, let, strip, words

_NUMBER = rf"{D}{{1,3}}(?:[.,]{D}{{3}})+(?:[.,]{D}+)?|{D}+(?:[.,]{D}+)?"
_CURRENCY = rf"(?iu){B0}(?:RON|EUR|USD|LEI){B1}"
_AXIS_UNIT = rf"(?iu){B0}(?:mil\.|mil|mii|milioane?){B1}"
#: Stems of key figures.
_KEYWORD = rf"(?iu){B0}(?:profit|cifr|venit|active|ebitda|marj|rezultat|capital){W}*{B1}"


def is_axis_text(text: Column) -> Column:
    """At least four small whole numbers, no large one but years, and a unit or currency."""

    def check(n: Column) -> Column:
        value = F.transform(n, lambda x: x.cast("decimal(38,0)"))
        whole = ~F.exists(n, lambda x: x.rlike("[.,]"))
        large = F.exists(value, lambda v: (v >= 1000) & ~v.between(1900, 2100))
        return (F.size(n) >= 4) & whole & ~large & (F.size(F.filter(value, lambda v: v <= 200)) >= 4)

    short = F.transform(find_all(text, _NUMBER), lambda x: F.when(x.rlike("[.,]"), x).otherwise(F.right(F.concat(F.lit("0"), x), F.lit(30))))
    return F.when(text.rlike(_AXIS_UNIT) | text.rlike(_CURRENCY), let(short, lambda n: F.when(F.exists(n, lambda x: x.rlike("[.,]")), False).otherwise(check(n)))).otherwise(False)


def is_kpi_text(text: Column) -> Column:
    """A short text with some numbers, a word that is no currency, and a currency, a percent sign or a known stem."""
    numbers = F.size(find_all(text, _NUMBER))
    named = F.exists(find_all(text, rf"{LETTER}+"), lambda t: ~F.lower(t).isin("ron", "eur", "usd", "lei"))
    marked = text.rlike(_CURRENCY) | text.contains("%") | text.rlike(_KEYWORD)
    fits = F.length(text).between(8, 300) & (count_of(text, "\n") <= 8) & numbers.between(1, 12)
    return F.coalesce(fits & named & ~is_axis_text(text) & marked, F.lit(False))


def is_kpi_label(block: Column) -> Column:
    """One line of at most five words, mostly capitals, no heading."""
    s = strip(block)
    letters, upper = count_of(s, r"\p{L}"), count_of(s, r"\p{Lu}")
    return (s != "") & ~s.contains("\n") & ~s.rlike(r"^#{1,6}\s+\S") & (F.size(words(s)) <= 5) & (letters > 0) & (upper >= 0.7 * letters)


def is_kpi_value(block: Column) -> Column:
    """One line with a unit and a number, or a comparison or percentage."""
    s = strip(block)
    unit = s.rlike(rf"(?iu){B0}(?:RON|EUR|USD|LEI|MIL){B1}") | s.rlike(rf"(?iu){B0}MIL\.{B0}{W}")
    hint = s.rlike(rf"(?iu){B0}vs{B1}|%|{D}")
    return (s != "") & ~s.contains("\n") & hint & (unit | F.lower(s).contains("vs") | s.contains("%"))
