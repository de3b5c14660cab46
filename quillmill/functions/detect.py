"""Predicates on texts: spacing and collapse artifacts, numbers and cells in need of repair, axis lines. All are Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.regex import B0, B1, D, LETTER, NOT_S, S, W, count_of, digits, find_all, is_blank, let, strip, tokens, words

# Single letters that are words, and the letters of the languages at hand.
COMMON_LETTERS = "aAIioO"
LETTERS = "A-Za-zĂÂÎȘȚăâîșț"
_RARE = rf"[\p{{L}}&&[^{COMMON_LETTERS}]]"
_ONE = rf"{B0}{W}{B1}"


def is_spaced(text: Column) -> Column:
    """Letters or digits set apart: single digits in a row, blanks inside numbers, runs of single letters, a lone letter between words.

    Every sign but a blank inside a number needs a single letter or digit; every other one but a line of at least half single ones needs one besides the common
    ones, or single digits. What most lines lack is looked for first.
    """
    split_number = text.rlike(rf"{D}[.,/]{S}+{D}|{D}{S}+[.,/]{S}*{D}")
    digits_apart = text.rlike(rf"(?:{B0}{D}{B1}{S}+){{3,}}{B0}{D}{B1}")
    # a run of single characters with a rare letter: one of its neighbours is single, too
    letters_apart = text.rlike(rf"{B0}{_RARE}{B1}{S}+{_ONE}|{_ONE}{S}+{B0}{_RARE}{B1}")
    middles = find_all(text, rf"{B0}{W}{{2,}}{S}+({W}){S}+{W}{{2,}}{B1}", 1)
    rare = lambda t: t.rlike(rf"^{_RARE}\z")

    def by_share(w: Column, mid: Column) -> Column:
        single = F.filter(w, lambda t: t.rlike(r"^[\p{L}\p{N}]\z"))
        return let(
            F.struct(F.size(w).alias("n"), F.size(single).alias("one"), F.size(F.filter(single, rare)).alias("rare")),
            lambda c: (c["n"] >= 4) & ((2 * c["one"] >= c["n"]) | ((F.size(mid) > 0) & ((c["rare"] >= 2) | ((c["one"] > 0) & (2 * c["rare"] >= c["one"]))))),
        )

    slow = let(middles, lambda mid: F.exists(mid, rare) | by_share(words(text), mid))
    two_alone = text.rlike(rf"(?s)(?:^|{S})[\p{{L}}\p{{N}}]{S}(?:.*{S})??[\p{{L}}\p{{N}}](?:{S}|\z)")
    common = F.when(digits_apart, True).when((F.length(text) < 6) | ~two_alone, False).otherwise(by_share(words(text), F.array().cast("array<string>")))
    full = F.when(digits_apart | letters_apart, True).when(F.length(text) < 6, False).otherwise(slow)
    return F.when(split_number, True).when(~text.rlike(_ONE), False).when(~text.rlike(rf"{B0}{_RARE}{B1}"), common).otherwise(full)


def is_multi_space(text: Column) -> Column:
    """Several blanks or tabs between words."""
    return text.rlike(rf"(?<={NOT_S})[ \t]{{2,}}(?={NOT_S})")


RUN_ON = rf"{LETTER}{{20,}}"
MERGED = rf"{LETTER}{{6,}}{D}{{2,}}{LETTER}{{2,}}|{D}{{2,}}{LETTER}{{6,}}"


def is_collapsed(text: Column) -> Column:
    """Words run together."""

    def long_words(t: Column) -> Column:
        total = F.aggregate(t, F.lit(0), lambda a, w: a + F.length(w))
        long = F.size(F.filter(t, lambda w: F.length(w) >= 18))
        few_blanks = (F.length(text) > 120) & (count_of(text, " ") / F.length(text) < 0.05)
        return (F.size(t) >= 8) & ((total >= 9 * F.size(t)) | (long >= 2) | few_blanks)

    # one scan for what the two patterns have in common: six letters in a row with more letters or digits beside them
    quick = text.rlike(rf"{LETTER}{{6}}(?:{LETTER}{{14}}|{D})|{D}{LETTER}{{6}}") & (text.rlike(RUN_ON) | text.rlike(MERGED))
    return F.when(quick, True).when(F.length(text) < 60, False).otherwise(let(tokens(text), long_words))


def needs_spacing_fix(text: Column) -> Column:
    return is_spaced(text) | is_collapsed(text)


def _table_fix(text: Column, fix: Column) -> Column:
    short = rf"(?:{B0}[{LETTERS}]{{1,2}}{B1}{S}+){{2,}}{B0}[{LETTERS}]{{1,2}}{B1}"
    lone = rf"{B0}[{LETTERS}]{{2,}}{S}+[{LETTERS}]{B1}"
    return (
        F.when(fix, True)
        .when((text == "") | (text.rlike(D) & ~text.rlike(r"\p{L}")), False)
        .when(text.rlike(short), True)
        .otherwise(text.rlike(lone) & ~text.rlike(rf"(?iu){B0}SOLD{S}+[CD]{B1}"))
    )


def needs_table_spacing_fix(text: Column) -> Column:
    """For cells, also short letter groups in a row, or a lone letter after a word unless it is `SOLD C` or `SOLD D`."""
    return _table_fix(text, needs_spacing_fix(text))


def spacing_badness(text: Column) -> Column:
    """How badly words seem joined or split; 0 without words."""
    return let(is_spaced(text), lambda spaced: _badness(text, spaced))


def _badness(text: Column, spaced: Column) -> Column:
    def score(t: Column) -> Column:
        mean = F.aggregate(t, F.lit(0.0), lambda a, w: a + F.length(w)) / F.greatest(F.size(t), F.lit(1))
        points = lambda cond, n: F.when(cond, F.lit(n)).otherwise(F.lit(0.0))
        return F.when(F.size(t) == 0, F.lit(0.0)).otherwise(
            F.greatest(mean - 6.0, F.lit(0.0)) + 1.5 * F.size(F.filter(t, lambda w: F.length(w) >= 18)) + points(text.rlike(RUN_ON), 4.0) + points(text.rlike(MERGED), 3.0) + points(spaced, 4.0)
        )

    return let(tokens(text), score)


# --- cells that a second look at the page may improve -------------------------------------------


def numeric_only(text: Column) -> Column:
    return strip(text).rlike(rf"^(?:[0-9.,/%()-]|{S})+\z")


def needs_numeric_repair(text: Column) -> Column:
    s, n = strip(text), F.length(digits(text))
    return numeric_only(text) & ((n <= 2) | (s.rlike(r"^[.,]") & (n <= 4)))


def needs_short_text_repair(text: Column) -> Column:
    return strip(text).rlike(r"^\p{L}{0,2}\z")


def needs_suffix_completion(text: Column) -> Column:
    """The last word is long and ends in no vowel: its end may be cut off."""
    last = F.get(F.reverse(find_all(strip(text), "[A-Za-zĂÂÎăâîșșțȚȘ]+")), F.lit(0))
    return (F.length(strip(text)) >= 6) & F.coalesce(last.rlike(r"^.{5,}[^aeiouAEIOUăâîĂÂÎ]\z"), F.lit(False))


def needs_table_cell_repair(text: Column) -> Column:
    return needs_table_spacing_fix(text) | needs_numeric_repair(text) | needs_short_text_repair(text) | needs_suffix_completion(text)


def facts(text: Column) -> Column:
    """What choosing between readings needs to know of a text, each thing found once."""

    def of(found: Column) -> Column:
        spaced, fix = found["spaced"], found["spaced"] | found["collapsed"]
        return F.struct(
            text.alias("text"), F.length(text).alias("length"), F.size(tokens(text)).alias("words"), F.length(digits(text)).alias("digits"), spaced.alias("spaced"), fix.alias("fix"), _table_fix(text, fix).alias("table_fix"),
            _badness(text, spaced).alias("badness"), numeric_only(text).alias("numeric"), text.rlike(rf"^(?:[0-9.,/%()-]|{S})+\z").alias("bare"), needs_numeric_repair(text).alias("broken"), needs_short_text_repair(text).alias("short"),
            needs_suffix_completion(text).alias("cut"),
        )

    return let(F.struct(is_spaced(text).alias("spaced"), is_collapsed(text).alias("collapsed")), of)


def prefers(old: Column, new: Column, table_mode: bool = False) -> Column:
    """Whether the text of the facts `new` is better than that of `old`. The rules are tried in order."""
    fewer = F.greatest(F.floor(old["words"] * 0.6), F.lit(1))
    in_table, forgiven = F.lit(table_mode), old["spaced"] | old["bare"]
    longer = new["length"] - old["length"]
    out = F.when((new["text"] == "") | (new["text"] == old["text"]), False).when(is_blank(old["text"]), True)
    out = out.when(F.startswith(new["text"], old["text"]) & longer.between(1, 3), True)
    out = out.when(in_table & old["table_fix"] & (old["words"] > 0) & (new["words"] <= fewer), True)
    out = out.when(old["broken"] & new["numeric"] & (new["digits"] > old["digits"]), True)
    out = out.when(old["short"] & (longer > 0), True)
    out = out.when((new["length"] < F.greatest(F.floor(old["length"] * 0.4), F.lit(8))) & ~forgiven, False)
    out = out.when((old["words"] > 0) & (new["words"] < fewer) & ~(forgiven | (in_table & old["table_fix"])), False)
    out = out.when(old["fix"] & ~new["fix"], True).when(in_table & old["table_fix"] & ~new["table_fix"], True)
    return out.otherwise(new["badness"] + 0.5 < old["badness"])


def should_replace(old: Column, new: Column, table_mode: bool = False) -> Column:
    """Whether a reconstruction is better than what it replaces."""
    return let(facts(old), lambda a: let(facts(new), lambda b: prefers(a, b, table_mode)))


# --- what stands inside charts ------------------------------------------------------------------


def is_date_only(text: Column) -> Column:
    return strip(text).rlike(rf"^{D}{{2}}[./-]{D}{{2}}[./-]{D}{{4}}\z")


_AXIS_TOKEN = rf"(?iu)^(?:{D}{{1,4}}%?|Q[1-4]|9L|L9|mil|RON|EUR|USD|LEI)\z"


def is_axis(text: Column) -> Column:
    """A short line of ticks, periods and units."""

    def check(t: Column) -> Column:
        with_digit = F.size(F.filter(t, lambda x: x.rlike(D)))
        by_kind = F.forall(t, lambda x: x.rlike(_AXIS_TOKEN)) | ((with_digit >= F.size(t) - 1) & (F.length(strip(text)) <= 20))
        return F.size(t).between(1, 6) & (with_digit > 0) & by_kind

    fits = F.length(strip(text)).between(1, 40) & strip(text).rlike(rf"^(?:[0-9A-Za-z%./+\-]|{S})+\z")
    return F.when(fits, let(find_all(strip(text), "[A-Za-z0-9%]+"), check)).otherwise(False)
