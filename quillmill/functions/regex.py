"""Python's text semantics as Spark expressions, in one place.

Java's \\w, \\d, \\s and \\b are ASCII by default, and its (?U) mode adds combining marks; the classes here are those of Python's str patterns. Patterns are
built by f-strings from these names, so none is spelled out twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: \w, \d, \s and [^\W\d_] of Python.
W = r"[\p{L}\p{N}_]"
D = r"\p{Nd}"
S = r"[\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
NOT_S = S.replace("[", "[^", 1)
LETTER = r"[\p{L}\p{Nl}\p{No}]"
#: \b before and after a word character.
B0, B1 = rf"(?<!{W})", rf"(?!{W})"
_BREAK = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once: a chain of conditional steps grows in proportion to its length, not exponentially."""
    return F.element_at(F.transform(F.array(value), body), 1)


def chain(value: Column, *steps: Callable[[Column], Column]) -> Column:
    """The steps one after another, each on what the one before made."""
    for step in steps:
        value = let(value, step)
    return value


def strip(c: Column) -> Column:
    """str.strip()."""
    return F.regexp_replace(c, rf"^{S}+|{S}+\z", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{S}+\z", "")


def is_blank(c: Column) -> Column:
    return ~c.rlike(NOT_S)


def words(c: Column) -> Column:
    """str.split()."""
    return F.regexp_extract_all(c, F.lit(rf"({NOT_S}+)"), F.lit(1))


def squeeze(c: Column) -> Column:
    """' '.join(text.split())."""
    return F.array_join(words(c), " ")


def split_lines(c: Column) -> Column:
    """str.splitlines(): other breaks than \\n count, and a last break ends no further line."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, rf"{_BREAK}\z", ""), _BREAK))


def casefold(c: Column) -> Column:
    """str.casefold() for the letters of European languages: lower case, and ß as ss."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def find_all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def tokens(c: Column) -> Column:
    """All \\w+."""
    return find_all(c, rf"{W}+")


def count_of(c: Column, char_class: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(c) - F.length(F.regexp_replace(c, char_class, ""))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, rf"[^{D}]", "")

