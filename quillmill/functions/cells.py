"""Repairs and checks of table cells: numbers, currencies, percentages and dates, kept as strings throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.detect import is_spaced
from quillmill.functions.regex import B0, B1, D, S, chain, count_of, digits, find_all, let, squeeze, strip, words
from quillmill.functions.text import normalize_ligatures, normalize_mojibake

DATE = rf"{D}{{1,2}}[./-]{D}{{1,2}}[./-]{D}{{2,4}}"
FUZZY_DATE = rf"{D}{{1,3}}[./-]{D}{{1,2}}[./-]{D}{{2,4}}"
_GROUPED = rf"{D}{{1,3}}(?:\.{D}{{3}})+"
_AMOUNT = rf"{_GROUPED}(?:[.,]{D}+)?"
_CURRENCY = "(RON|EUR)"
CURRENCY = rf"{B0}{_CURRENCY}{B1}"
NUMBER = rf"[+-]?\(?[.,]?{D}(?:{D}|[.,])*\)?"
_DELTA = rf"^(?:ƒ\^\+%|∆{S}*%|Δ{S}*%)\n?\z"


def is_numericish(text: Column) -> Column:
    """Digits, number signs and ASCII letters only, when in upper case."""
    return F.upper(text).rlike(rf"^(?:[0-9.,()%+A-Z-]|{S})+\z")


def currency_number(text: Column) -> Column:
    """struct(currency, number) of a text with one number and one currency or no letter at all; else null."""

    def pick(flat: Column) -> Column:
        numbers = F.filter(find_all(flat, NUMBER), lambda n: n.rlike(D))
        currencies = F.array_distinct(find_all(flat, CURRENCY, 1))
        ok = (F.size(numbers) == 1) & ((F.size(currencies) == 1) | ((F.size(currencies) == 0) & ~flat.rlike(r"\p{L}")))
        return F.when(ok, F.struct(F.get(currencies, F.lit(0)).alias("currency"), F.get(numbers, F.lit(0)).alias("number")))

    return let(squeeze(text), pick)


def number_token(token: Column) -> Column:
    return F.replace(F.ltrim(F.btrim(strip(token), F.lit("()")), F.lit("+-")), F.lit(" "), F.lit(""))


def grouping_is_valid(token: Column) -> Column:
    """Whether every group after the first point has three digits, once a decimal part after a comma is gone."""

    def check(n: Column) -> Column:
        commas = count_of(n, ",")
        decimal = (n.rlike(r"\.") & n.rlike(r",[^.]*\z")) | (~n.rlike(r"\.") & (commas == 1))
        whole = F.when(decimal, F.regexp_extract(n, "^([^,]*)", 1)).otherwise(F.replace(n, F.lit(","), F.lit("")))
        return ~n.rlike(r"^(?:[.,]|\z)|[.,]\z") & whole.rlike(r"^(?:[^.]*|[^.]+(?:\.[^.]{3})+)\z")

    return let(number_token(token), check)


def is_negative(text: Column) -> Column:
    return strip(text).rlike(r"^-") | (text.contains("(") & text.contains(")"))


def is_suspect(text: Column) -> Column:
    """One number, whose grouping is broken."""

    def check(found: Column) -> Column:
        n = number_token(found["number"])
        return found.isNotNull() & (n != "") & (n.rlike(r"^[.,]|[.,]\z") | ~grouping_is_valid(n))

    return let(currency_number(text), lambda found: F.coalesce(check(found), F.lit(False)))


# --- the steps of a cell's cleaning, in their order --------------------------------------------


def _percent_and_sign(t: Column) -> Column:
    number = rf"{B0}({D}+(?:[.,]{D}+)?){S}*%"
    t = F.regexp_replace(t, rf"{number}{S}+\1{S}*%", "$1%")
    t = F.regexp_replace(t, number, "$1%")
    return F.regexp_replace(t, rf"{B0}-{S}+(?={D})", "-")


def _groups(t: Column) -> Column:
    """`42 42.916.476` loses the double; a leading group joins one group, but gives way to two or more."""
    t = F.regexp_replace(t, rf"{B0}({D}{{1,3}}){S}+\1((?:\.{D}{{3}})+){B1}", "$1$2")
    t = F.regexp_replace(t, rf"{B0}{D}{{1,2}}{S}+({D}{{3}}(?:\.{D}{{3}}){{2,}}){B1}", "$1")
    return F.regexp_replace(t, rf"{B0}({D}{{1,2}}){S}+({D}{{3}}\.{D}{{3}}){B1}(?!\.{D}{{3}}{B1})", "$1.$2")


def _brackets(t: Column) -> Column:
    return F.when(t.rlike(D), F.btrim(t, F.lit("[]"))).otherwise(t)


def compact_number_spacing(text: Column) -> Column:
    t = F.regexp_replace(text, rf"(?<={D}){S}+(?={D})", "")
    t = F.regexp_replace(t, rf"(?<={D}){S}+(?=[.,])", "")
    t = F.regexp_replace(t, rf"(?<=[.,]){S}+(?={D})", "")
    return F.when(is_numericish(text), strip(F.regexp_replace(t, rf"{S}{{2,}}", " "))).otherwise(text)


def _parentheses(t: Column) -> Column:
    tight = F.regexp_replace(F.regexp_replace(t, rf"\({S}+(?={D})", "("), rf"(?<={D}){S}+\)", ")")
    return F.when(is_numericish(t), tight).otherwise(t)


def _currency_first(t: Column) -> Column:
    return F.regexp_replace(t, rf"^({_AMOUNT}){S}+{_CURRENCY}\n?\z", "$2 $1")


def _missing_letter(t: Column) -> Column:
    ends = rf"^({_AMOUNT}){S}+ON\n?\z"
    inside = is_numericish(t) & t.rlike(rf"{B0}RO{B1}") & ~t.contains("RON")
    return F.when(t.rlike(ends), F.regexp_replace(t, ends, "RON $1")).when(inside, F.regexp_replace(t, rf"{B0}RO{B1}", "RON")).otherwise(t)


def _trailing_short(t: Column) -> Column:
    return F.regexp_replace(t, rf"^({_GROUPED}){S}+{_CURRENCY}{S}+{D}{{1,2}}\n?\z", "$2 $1")


def _best_date(t: Column) -> Column:
    """Of several dates in a cell without letters, the one of the longest year, then the longest, then the last by text."""
    dates = find_all(t, DATE)
    ranked = F.transform(dates, lambda d: F.struct(F.length(F.regexp_extract(d, rf"({D}*)\z", 1)), F.length(d), d.alias("date")))
    return F.when((F.size(dates) >= 2) & ~t.rlike(r"\p{L}"), F.array_max(ranked)["date"]).otherwise(t)


def _trailing_fragment(t: Column) -> Column:
    """A torn R, E, N or ON after the number, in a text that names its currency."""

    def cut(w: Column) -> Column:
        last, before = F.element_at(w, -1), F.get(w, F.size(w) - 2)
        named = F.array_contains(w, "RON") | (last.isin("R", "E", "N") & F.array_contains(w, "EUR"))
        torn = (F.size(w) >= 3) & last.isin("R", "E", "N", "ON") & named & before.rlike(D)
        return F.when(torn, F.array_join(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), " ")).otherwise(t)

    return F.when(t.rlike(rf"{S}(?:R|E|N|ON){S}*\z"), let(words(t), cut)).otherwise(t)


def _prefix(t: Column, pattern: str, number: int, value: int, currency: int, same: bool) -> Column:
    """Drop the number before the currency if the value's digits begin with its digits (same), or if they don't."""
    of = lambda k: F.regexp_extract(t, pattern, k)
    begins = F.startswith(digits(of(value)), digits(of(number)))
    return F.when(t.rlike(pattern) & (begins if same else ~begins), F.concat(of(currency), F.lit(" "), of(value))).otherwise(t)


def _duplicate_prefix(t: Column) -> Column:
    return _prefix(t, rf"^({D}{{1,3}}(?:[.,]{D}{{1,3}})?[.,]?){S}+{_CURRENCY}{S}+({_GROUPED})\n?\z", 1, 3, 2, True)


def _duplicate_suffix(t: Column) -> Column:
    def cut(w: Column) -> Column:
        twice = (F.size(w) >= 3) & F.get(w, F.lit(0)).isin("RON", "EUR") & (F.element_at(w, -1) == F.get(w, F.lit(0))) & F.get(w, F.lit(1)).rlike(D)
        return F.when(twice, F.array_join(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), " ")).otherwise(t)

    return F.when(t.rlike(rf"^{S}*(?:RON|EUR){S}"), let(words(t), cut)).otherwise(t)


def _repeated_value(t: Column) -> Column:
    t = F.regexp_replace(t, rf"^{_CURRENCY}{S}+({_AMOUNT}){S}+\1{S}+\2\n?\z", "$1 $2")
    t = F.regexp_replace(t, rf"^({_AMOUNT}){S}+{_CURRENCY}{S}+\1{S}+\2\n?\z", "$2 $1")
    return F.regexp_replace(t, rf"^{D}{{1,3}}{S}+{_CURRENCY}{S}+({_AMOUNT}){S}+\1\n?\z", "$1 $2")


def _on_middle(t: Column) -> Column:
    return _prefix(t, rf"^({D}{{1,3}}(?:[.,]{D}+)?){S}+ON{S}+({_AMOUNT}){S}+{_CURRENCY}\n?\z", 1, 2, 3, True)


def _odd_prefix(t: Column) -> Column:
    return _prefix(t, rf"^({D}{{1,2}}){S}+{_CURRENCY}{S}+({_AMOUNT})\n?\z", 1, 3, 2, False)


def clean_cell(text: Column) -> Column:
    """A body cell's text, cleaned. The order of the steps is part of the result."""
    body = lambda c: F.when(c.rlike(_DELTA), F.lit("Δ%")).otherwise(
        chain(
            _groups(_percent_and_sign(c)), squeeze, _brackets, compact_number_spacing, _parentheses, _currency_first, _missing_letter, _trailing_short, _best_date,
            _trailing_fragment, _duplicate_prefix, _duplicate_suffix, _repeated_value, _on_middle, _odd_prefix,
        )
    )
    return F.when(text == "", text).otherwise(chain(text, normalize_mojibake, lambda t: strip(normalize_ligatures(t)), body))


# --- headers -------------------------------------------------------------------------------------


def choose_date(dates: Column) -> Column:
    """Of dates in text order: full years first, then two-digit days, then the last."""
    full = F.filter(dates, lambda d: d.rlike(rf"[./-]{D}{{4}}\z"))

    def by_day(d: Column) -> Column:
        two = F.filter(d, lambda x: x.rlike(rf"^{D}{{2}}[./-]"))
        return F.element_at(F.when(F.size(two) > 0, two).otherwise(d), -1)

    return F.when(F.size(dates) > 0, let(F.when(F.size(full) > 0, full).otherwise(dates), by_day))


def repair_fuzzy_date(date: Column) -> Column:
    """Day and month of at most two digits, the first separator throughout."""
    parts, sep = F.split(date, "[./-]"), F.regexp_extract(date, "([./-])", 1)
    short = lambda p: F.right(p, F.lit(2))
    return F.when(F.size(parts) == 3, F.concat(short(parts[0]), sep, short(parts[1]), sep, parts[2])).otherwise(date)


def clean_header(text: Column) -> Column:
    """A header cell's text: one date of several, repaired dates, doubled labels once."""

    def body(t: Column) -> Column:
        only_date = t.rlike(rf"^(?:{D}|{S}|[./-])+\z")

        def by_date(found: Column) -> Column:
            chosen, dates = found["chosen"], found["dates"]
            full = F.coalesce(chosen.rlike(rf"[./-]{D}{{4}}\z"), F.lit(False))  # choosing prefers a full year, so no date has one otherwise
            fuzzy = repair_fuzzy_date(choose_date(find_all(t, rf"(?=({FUZZY_DATE}))", 1)))
            half = let(words(t), lambda w: F.when((F.size(w) > 0) & (F.size(w) % 2 == 0) & (F.slice(w, 1, F.floor(F.size(w) / 2).cast("int")) == F.slice(w, (F.floor(F.size(w) / 2) + 1).cast("int"), F.size(w))), F.array_join(F.slice(w, 1, F.floor(F.size(w) / 2).cast("int")), " ")).otherwise(t))
            return (
                F.when(full & ((F.size(dates) > 1) | ((t != chosen) & only_date)), chosen)
                .when(~full & (count_of(t, "[/.-]") > 2) & only_date & F.coalesce(fuzzy != t, F.lit(False)), fuzzy)
                .otherwise(half)
            )

        return F.when(t.rlike(_DELTA), F.lit("Δ%")).otherwise(let(F.struct(find_all(t, DATE).alias("dates"), choose_date(find_all(t, DATE)).alias("chosen")), by_date))

    return F.when(text == "", text).otherwise(chain(text, normalize_mojibake, lambda t: squeeze(normalize_ligatures(t)), body))


# --- choosing between two readings of a cell ------------------------------------------------------


def should_replace_numeric(base: Column, other: Column) -> Column:
    """Whether the other reading of a cell is the same number with digits that this one lost."""

    def compare(c: Column) -> Column:
        a, b, fa, fb = c["a"], c["b"], c["fa"], c["fb"]
        da, db = digits(fa["number"]), digits(fb["number"])
        same_kind = fa["currency"].eqNullSafe(fb["currency"]) & (is_negative(a) == is_negative(b))
        more = (F.length(da) > 0) & (F.length(db) > F.length(da)) & grouping_is_valid(fb["number"])
        return F.coalesce((a != b) & fa.isNotNull() & fb.isNotNull() & same_kind & more & (is_suspect(a) | (F.endswith(db, da) & (F.length(db) - F.length(da) <= 2))), F.lit(False))

    cleaned = let(
        F.struct(clean_cell(base).alias("a"), clean_cell(other).alias("b")),
        lambda c: let(F.struct(c["a"].alias("a"), c["b"].alias("b"), currency_number(c["a"]).alias("fa"), currency_number(c["b"]).alias("fb")), compare),
    )
    return F.when(F.coalesce((base == "") | (other == "") | is_spaced(other), F.lit(True)), False).otherwise(cleaned)
