"""String -> string repairs of running text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.detect import numeric_only
from quillmill.functions.regex import B0, B1, D, NOT_S, S, chain, count_of, let, split_lines, squeeze, strip

# Fixed values.
LIGATURES = (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl"))
DIACRITICS = "ăâîșțĂÂÎȘȚ"
_CP1252 = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))


def normalize_whitespace(text: Column) -> Column:
    """Runs of blanks between words become one; a last pair of single capitals is a ratio that lost its slash."""
    one = F.regexp_replace(text, rf"(?<={NOT_S})[ \t]{{2,}}(?={NOT_S})", " ")
    return F.regexp_replace(one, rf"{B0}([A-Z]){S}+([A-Z])(?=\n?\z)", "$1/$2")


def normalize_ligatures(text: Column) -> Column:
    for ligature, letters in LIGATURES:
        text = F.replace(text, F.lit(ligature), F.lit(letters))
    return text


def mojibake_score(text: Column) -> Column:
    """3 for each control character of Latin-1, 1 for each of its letters but âîÂÎ, 4 for each replacement character."""
    return 3 * count_of(text, r"[\x80-\x9f]") + count_of(text, "[À-ÿ&&[^âîÂÎ]]") + 4 * count_of(text, "�")


def diacritics(text: Column) -> Column:
    return count_of(text, f"[{DIACRITICS}]")


def normalize_mojibake(text: Column) -> Column:
    """UTF-8 that was read as Windows-1252 or Latin-1 is read as UTF-8, where that makes the text clearly better.

    Both code pages are written out with built-in functions; a text with a character outside a code page, or whose bytes aren't valid UTF-8, stays as it is.
    """
    special = _CP1252.decode("cp1252")
    as_latin = F.translate(text, special, _CP1252.decode("latin-1"))
    fits = (~text.rlike(r"[\x80-\x9f]") & ~as_latin.rlike(r"[^\x00-\xff]"), ~text.rlike(r"[^\x00-\xff]"))
    raw = [F.when(ok, F.encode(t, "ISO-8859-1").cast("string")) for ok, t in zip(fits, (as_latin, text), strict=True)]

    def better(best: Column, candidate: Column) -> Column:
        def judge(c: Column) -> Column:
            score, length = mojibake_score(c), F.length(text)
            ok = (c != text) & (score < mojibake_score(best)) & ((diacritics(c) > diacritics(text)) | (score < 2)) & (F.length(c) >= F.greatest(F.lit(4), F.floor(length * 0.9)))
            return F.when(F.coalesce(ok, F.lit(False)), c).otherwise(best)

        return let(F.when(F.expr("true") & F.is_valid_utf8(candidate), candidate), judge)

    fixed = let(better(text, raw[0]), lambda best: better(best, raw[1]))
    return F.when((F.length(text) < 4) | (mojibake_score(text) == 0), text).otherwise(fixed)


def compact_numeric_spacing(text: Column) -> Column:
    """Blanks inside numbers go, if the text is nothing but numbers."""
    t = F.regexp_replace(text, rf"(?<={D}){S}+(?={D})", "")
    t = F.regexp_replace(t, rf"(?<={D}){S}+(?=[.,/%])", "")
    t = F.regexp_replace(t, rf"(?<=[.,/%]){S}+(?={D})", "")
    return F.when(numeric_only(text), strip(F.regexp_replace(t, rf"{S}{{2,}}", " "))).otherwise(text)


def normalize_kpi_caption(text: Column) -> Column:
    """The lines of a caption as one, with tidy punctuation, and `12,3 mil. RON` as `RON 12,3 mil.`."""
    lines = F.filter(F.transform(split_lines(text), strip), lambda x: x != "")
    t = squeeze(F.array_join(lines, " "))
    t = F.regexp_replace(t, rf"{S}+([,.;:%])", "$1")
    t = F.regexp_replace(t, rf"\({S}+", "(")
    t = F.regexp_replace(t, rf"{S}+\)", ")")
    return F.regexp_replace(t, rf"(?iu)({B0}{D}(?:{D}|[.,])*{S}*mil\.?){S}+ron{B1}", "RON $1")


def normalize_item(text: Column) -> Column:
    """All repairs of a text item, in their order."""
    return chain(text, normalize_whitespace, normalize_mojibake, normalize_ligatures)
