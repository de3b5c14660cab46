"""The scalar functions against known pairs of input and result."""

import pytest
from pyspark.sql import functions as F

from quillmill.functions import cells, detect, extract, kpi, regex, text


def run(spark, f, *values):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names)).repartition(1)  # else the driver folds it
    return df.select(f(*map(F.col, names)).alias("x")).first()["x"]


CELLS = {
    "84 % 84 %": "84%", "42 42.916.476": "42.916.476", "1 234.567": "1.234.567", "ƒ^+%": "Δ%", "78. RON 78.947.449": "RON 78.947.449",
    "15.53 EUR 15.537.472": "EUR 15.537.472", "16. EUR 16.559.155 R": "EUR 16.559.155", "RON 418.244.920 N": "RON 418.244.920", "168.506.901 RON": "RON 168.506.901",
    "168.506.901 ON": "RON 168.506.901", "139.369. 058": "139.369.058", "153.689.723 RON 153.689.723 RON": "RON 153.689.723", "16 RON 164.980.067 RON": "RON 164.980.067",
    "RON 78.947.449 ON": "RON 78.947.449", "RON 139.369. 058 RON": "RON 139.369.058", "126.39 ON 126.397.863 RON": "RON 126.397.863", "- 45,40%": "-45,40%",
    "7 RO 133.339.798 R": "RON 133.339.798", "EUR ( 420 )": "EUR (420)", "31/12/20 31/12/2024": "31/12/2024", "RON 471.371]": "RON 471.371", "115.784.991 RON 7": "RON 115.784.991",
    "": "", "Total active": "Total active", "SubvenÈ›ii": "Subvenții", "1 23 231.456.456": "1231.456.456",
}
HEADERS = {
    "Indicatori Indicatori": "Indicatori", "31.12.202230/09/2024": "30/09/2024", "3130/09/2025": "30/09/2025", "202231/12/2024": "31/12/2024", "31.12.230/09/2025": "30/09/2025",
    "02131/12/2024": "31/12/2024", "Δ %": "Δ%", "30/09/2025": "30/09/2025", "": "", "la 30/09/2025": "la 30/09/2025",
}


@pytest.mark.parametrize("given", CELLS)
def test_clean_cell(spark, given):
    assert run(spark, cells.clean_cell, given) == CELLS[given]


@pytest.mark.parametrize("given", HEADERS)
def test_clean_header(spark, given):
    assert run(spark, cells.clean_header, given) == HEADERS[given]


TRUTHS = [
    (cells.is_suspect, "EUR .961.31", True), (cells.is_suspect, "EUR 6.961.310", False), (cells.is_suspect, "EUR 6.961.310 RON", False), (cells.is_suspect, "text", False),
    (detect.is_multi_space, "foo  bar", True), (detect.needs_spacing_fix, "foo  bar", False), (detect.is_spaced, "Group a inregistrat rezultate", False),
    (detect.is_spaced, "finan c iar", True), (detect.is_spaced, "la 1 martie", False), (detect.is_spaced, "T1 2025 rezultate", False), (detect.is_spaced, "Într-o a doua etapă", False),
    (detect.is_spaced, "2024, 15", True), (detect.is_spaced, "1 2 3 4", True), (detect.is_spaced, "1 2 3", False), (detect.is_spaced, "foo a bar x baz", True), (detect.is_spaced, "", False),
    (detect.needs_table_spacing_fix, "Sold C", False), (detect.needs_table_spacing_fix, "Venit n", True), (detect.needs_table_spacing_fix, "ab cd ef", True), (detect.needs_table_spacing_fix, "12 34", False),
    (detect.is_collapsed, "a" * 20, True), (detect.is_collapsed, "a" * 19, False), (detect.is_collapsed, "abcdef12ab", True), (detect.is_collapsed, "12abcdef", True),
    (detect.needs_suffix_completion, "cheltuiel", True), (detect.needs_suffix_completion, "11.10. Alte cheltuiel", True), (detect.needs_suffix_completion, "cheltuieli", False),
    (detect.needs_numeric_repair, "12", True), (detect.needs_numeric_repair, "1234", False), (detect.needs_numeric_repair, ".1234", True), (detect.needs_numeric_repair, "", False),
    (detect.needs_short_text_repair, " a", True), (detect.needs_short_text_repair, "abc", False),
    (detect.is_axis, "74% 9L 2025", True), (detect.is_axis, "Total active", False), (detect.is_axis, "", False), (detect.is_date_only, " 30.09.2025 ", True), (detect.is_date_only, "30.09.25", False),
    (kpi.is_kpi_text, "Cifra de afaceri neta 158.065.856 RON", True), (kpi.is_kpi_text, "Profit net 43.000.000", True), (kpi.is_kpi_text, "Q&A cu CEO", False),
    (kpi.is_kpi_text, "Grafic 0 10 20 30 40 50", False), (kpi.is_kpi_text, "Profit 1 2 3 4 5 6 7 8 9 10 11 12 13", False), (kpi.is_kpi_text, "20 0 40 60 80 9L 2024 9L 2025 mil. RON", False),
    (kpi.is_axis_text, "20 0 40 60 80 9L 2024 9L 2025 mil. RON", True), (kpi.is_kpi_label, "ACTIVE CIRCULANTE", True), (kpi.is_kpi_label, "Active circulante", False), (kpi.is_kpi_value, "RON 5 mil.", True),
    (kpi.is_kpi_value, "text vs text", True), (kpi.is_kpi_value, "text", False),
]


@pytest.mark.parametrize("f, given, want", TRUTHS, ids=lambda x: getattr(x, "__name__", str(x)[:20]))
def test_predicates(spark, f, given, want):
    assert run(spark, f, given) is want


@pytest.mark.parametrize("base, other, want", [("RON 71.371", "RON 471.371", True), ("RON 71.371", "RON 1.371.000", False), ("EUR .961.31", "EUR 6.961.310", True), (".961.31", "6.961.310", True), ("RON 1.000", "EUR 11.000", False), ("", "1", False)])
def test_should_replace_numeric(spark, base, other, want):
    assert run(spark, cells.should_replace_numeric, base, other) is want


@pytest.mark.parametrize("old, new", [("cheltuiel", "cheltuieli"), ("11.10. Alte cheltuiel", "11.10. Alte cheltuieli"), ("Vi t e z a de ro t a ț ie a a ct i v e l or", "Viteza de rotație a activelor")])
def test_should_replace(spark, old, new):
    f = lambda a, b: detect.should_replace(a, b, table_mode=True)
    assert run(spark, f, old, new) is True and run(spark, f, new, new) is False and run(spark, f, new, "") is False


@pytest.mark.parametrize(
    "f, given, want",
    [
        (text.normalize_whitespace, "foo  bar", "foo bar"), (text.normalize_whitespace, "foo\t\tbar", "foo bar"), (text.normalize_whitespace, "  foo", "  foo"), (text.normalize_whitespace, "foo  ", "foo  "),
        (text.normalize_whitespace, "Gradul de indatorare A B", "Gradul de indatorare A/B"), (text.normalize_mojibake, "SubvenÈ›ii pentru investiÈ›ii", "Subvenții pentru investiții"),
        (text.normalize_mojibake, "Text curat și bun", "Text curat și bun"), (text.normalize_mojibake, "cafÃ© bon", "cafÃ© bon"), (text.normalize_ligatures, "Proﬁtul și ﬁnanciare", "Profitul și financiare"),
        (text.normalize_kpi_caption, "PROFIT\nNET\nRON\n42,92 MIL.\n(EUR 8,45 MIL.)\n+103,61%\nvs\n9L 2024", "PROFIT NET RON 42,92 MIL. (EUR 8,45 MIL.) +103,61% vs 9L 2024"),
        (text.normalize_kpi_caption, "12,3 mil. RON", "RON 12,3 mil."), (text.compact_numeric_spacing, "1 2 / 3 %", "12/3%"), (text.compact_numeric_spacing, "a 1 2", "a 1 2"),
        (extract.normalize_number, "1.234,5%", "1234.5%"), (extract.normalize_number, "1,234.5", "1234.5"), (extract.normalize_number, "1,5", "1.5"), (extract.normalize_number, "1.234.567", "1.234.567"), (extract.normalize_number, "1 234", "1234"),
    ],
)
def test_texts(spark, f, given, want):
    assert run(spark, f, given) == want


def test_lists(spark):
    assert run(spark, extract.audit_tokens, "Foo _bar_ ß __") == ["foo", "bar", "ss", ""]
    assert run(spark, extract.numbers, "x1 12 12,5% +3 1.234.567") == ["12", "12.5%", "+3", "1.234.567"]
    assert run(spark, extract.dates, "1/2/20 39.99.2024 1/2/20") == ["1/2/20", "39.99.2024"]
    odd = "a\rb\r\nc\x0bd\x0ce\x1cf\x85g h\n\ni\n"
    assert run(spark, regex.split_lines, odd) == odd.splitlines() and run(spark, regex.split_lines, "") == []
    for given in ("\x1c a  b　", " \n", "", "x"):
        assert run(spark, regex.strip, given) == given.strip() and run(spark, regex.words, given) == given.split()
