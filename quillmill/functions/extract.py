"""Tokens, numbers and dates of a text, normalised for comparing two renderings of it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.regex import B0, B1, D, casefold, count_of, find_all, let, strip, tokens


def audit_tokens(text: Column) -> Column:
    """All words in order, case folded and without underscores at their ends; a word of underscores is an empty one."""

    def fold(found: Column) -> Column:
        # all words at once, and one by one only where there are underscores
        folded = F.split(casefold(F.array_join(found, " ")), " ")
        bare = F.when(F.contains(text, F.lit("_")), F.transform(folded, lambda t: F.btrim(t, F.lit("_")))).otherwise(folded)
        return F.when(F.size(found) == 0, found).otherwise(bare)

    return let(tokens(text), fold)


def normalize_number(token: Column) -> Column:
    """One notation for decimals: a point before them, no other separators; a percent sign stays."""
    t = F.rtrim(strip(token), F.lit("%"))
    percent = F.when(strip(token).endswith("%"), "%").otherwise("")
    drop = lambda c, x: F.replace(c, F.lit(x), F.lit(""))
    both = F.when(t.rlike(r",[^.]*\z"), F.replace(drop(t, "."), F.lit(","), F.lit("."))).otherwise(drop(t, ","))
    alone = F.when((count_of(t, ",") == 1) & ~t.contains("."), F.replace(t, F.lit(","), F.lit("."))).otherwise(t)
    return F.concat(F.when(t.contains(",") & t.contains("."), both).otherwise(drop(alone, " ")), percent)


def numbers(text: Column) -> Column:
    """The distinct normalised numbers."""
    found = find_all(text, rf"{B0}[+-]?(?:{D}{{1,3}}(?:[ .]{D}{{3}})+|{D}+)(?:[.,]{D}+)?%?")
    return F.array_distinct(F.transform(found, normalize_number))


def dates(text: Column) -> Column:
    """The distinct dates, as written."""
    return F.array_distinct(find_all(text, rf"{B0}{D}{{1,2}}[./-]{D}{{1,2}}[./-]{D}{{2,4}}{B1}"))

