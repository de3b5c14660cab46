"""The DataFrame operators on small inputs with known results."""

import pytest
from pyspark.sql import functions as F

from quillmill import cli
from quillmill.operators import audit, glyphs, markdown, pictures, quality, select, tables
from quillmill.plans import convert
from quillmill.sources import config, io

B = markdown.PAGE_BREAK


def md(spark, f, text, whole=False):
    df = spark.createDataFrame([(1, text)], "doc_id long, markdown string")
    return (f(df) if whole else df.select(f(F.col("markdown")).alias("markdown"))).first()["markdown"]


def pages(text):
    return [p.strip() for p in text.split(B)]


def test_page_markers(spark):
    assert md(spark, markdown.add_page_markers, "# A\ntext") == "**[Page 1]**\n\n# A\ntext"
    assert md(spark, markdown.add_page_markers, f"<!-- page: 1 -->a{B} {B}b") == f"**[Page 1]**\n\na\n\n{B}\n\n**[Page 2]**\n\nb"
    assert md(spark, markdown.add_page_markers, " \n") == " \n" and md(spark, markdown.add_page_markers, f" {B} ") == ""
    assert md(spark, lambda c: markdown.add_page_markers(c, visible=False), "a") == "[//]: # (page: 1)\n\na"


def test_noise(spark):
    text = f"# Raport\n<!-- image -->\na{B}# Raport\nb{B}#  RAPORT\nc\n# Unic"
    out = md(spark, lambda d: markdown.reduce_noise(d, remove_images=True), text, True)
    assert pages(out) == ["# Raport\na", "b", "c\n# Unic"]
    twice = f"# R\n# R\n# R\nx{B}# R\n# R{B}# R"
    assert pages(md(spark, markdown.reduce_noise, twice, True)) == ["# R\n# R\nx", "# R", ""]
    assert md(spark, markdown.reduce_noise, "# R\nx\n", True) == "# R\nx" and md(spark, markdown.reduce_noise, " ", True) == " "


def test_kpi_blocks(spark):
    assert md(spark, markdown.merge_kpi_blocks, "ACTIVE CIRCULANTE\n\nRON 5 mil.\n\n+3% vs 2024\n\n4%\n\nText") == "ACTIVE CIRCULANTE RON 5 mil. +3% vs 2024\n\n4%\n\nText"


@pytest.mark.parametrize(
    "text, kept",
    [("a\n# H", False), (f"a\n# H{B}# Next\nb", False), (f"a\n# H{B}**[Page 2]**\n\n# Next", False), (f"a\n# H{B}Titlu Mare Nou\nb", False), (f"a\n# H{B}un text aici.\nb", True), (f"a\n# H{B}## Sub\nb", True), (f"a\n# H{B} {B}", False)],
)
def test_orphan_headings(spark, text, kept):
    assert ("# H" in pages(md(spark, markdown.remove_orphan_headings, text, True))[0]) is kept


def test_axis_lines(spark):
    text = "74% 9L 2025\n| 10 | 20 |\n# 2024\n<!-- image -->\n\nTotal active"
    assert md(spark, markdown.remove_axis_lines, text) == text.split("\n", 1)[1]


def test_quality(spark):
    got = md(spark, lambda c: quality.report(c), "ab\nabc d\n\x01same line\nsame line\nSAME LINE\n same line \n# same line\n1234")
    assert (got["score"], got["short_line_count"], got["repeated_line_count"], got["control_char_count"]) == (87, 2, 1, 1)
    assert md(spark, lambda c: quality.report(c), "a\n" * 40)["score"] == 0


CELL = io.SCHEMAS["cells"]


def cell(doc, table, no, r0, c0, text, c1=None, box=None, head=False):
    return (doc, table, no, r0, r0 + 1, c0, c1 or c0 + 1, text, box and (*map(float, box), "TOPLEFT"), head, False, False, False)


def test_collapse(spark):
    spans = [(0, 1, "Indicatori"), (1, 3, "30/09/2025"), (3, 5, "30/09/2024"), (5, 7, "30/09/2025"), (7, 9, "30/09/2024"), (9, 10, "Delta%")]
    row = ["CIFRA", "RON", "158.065.856", "RON", "126.792.531", "EUR", "36.549.554", "EUR", "29.318.226", "24,66%"]
    data = [cell(1, 0, i, 0, a, t, b, (a, 0, b, 1), True) for i, (a, b, t) in enumerate(spans)] + [cell(1, 0, 10 + i, 1, i, t, None, (i, 1, i + 1, 2)) for i, t in enumerate(row)]
    t = spark.createDataFrame([(1, 0, 1, 2, 10)], io.SCHEMAS["tables"])
    new_t, new_c = tables.collapse_header_groups(t, spark.createDataFrame(data, CELL))
    got = {(r["r0"], r["c0"]): r for r in new_c.collect()}
    assert new_t.first()["num_cols"] == 6 and len(got) == 12 and got[1, 1]["text"] == "RON 158.065.856" and got[1, 5]["text"] == "24,66%"
    assert (got[1, 1]["bbox"]["l"], got[1, 1]["bbox"]["r"]) == (1.0, 3.0) and got[0, 1]["column_header"]
    gap = spark.createDataFrame([r for r in data if r[2] != 1], CELL)
    assert tables.collapse_header_groups(t, gap)[0].first()["num_cols"] == 10


def test_currency_vote(spark):
    data = [cell(1, 0, i, i, 0, f"{c} 158.065.856") for i, c in enumerate(["EUR", "RON", "RON", "EUR", "RON", "RON"])]
    got = [r["text"][:3] for r in tables.vote_currencies(spark.createDataFrame(data, CELL)).orderBy("cell_no").collect()]
    assert got == ["EUR", "RON", "RON", "RON", "RON", "RON"]


def test_toc(spark):
    data = [cell(1, 0, 2 * i, i, 0, f"Section {i}") for i in range(6)] + [cell(1, 0, 2 * i + 1, i, 1, str(i)) for i in range(6)] + [cell(1, 1, 0, 0, 0, "a"), cell(1, 1, 1, 0, 1, "1")]
    t = spark.createDataFrame([(1, 0, 1, 6, 2), (1, 1, 1, 1, 2)], io.SCHEMAS["tables"])
    assert [r["toc_like"] for r in tables.toc_like(t, spark.createDataFrame(data, CELL)).orderBy("table_no").collect()] == [True, False]


def test_merges(spark):
    t = spark.createDataFrame([(1, 0, 1, 2, 2), (1, 1, 1, 3, 3)], io.SCHEMAS["tables"])
    o = spark.createDataFrame([(1, 4, 1, 2, 2), (1, 5, 1, 9, 9)], io.SCHEMAS["tables"])
    base = [cell(1, 0, 0, 0, 0, "va l o are"), cell(1, 0, 1, 0, 1, "RON 71.371"), cell(1, 1, 0, 0, 0, "ve n i t", None, (0, 0, 10, 10)), cell(1, 1, 1, 0, 1, "co s t", None, (50, 0, 60, 10))]
    other = [cell(1, 4, 0, 0, 0, "valoare"), cell(1, 4, 1, 0, 1, "RON 471.371"), cell(1, 5, 0, 0, 0, "venit", None, (1, 0, 11, 10)), cell(1, 5, 1, 0, 1, "alt", None, (0, 0, 60, 60))]
    b, c = spark.createDataFrame(base, CELL), spark.createDataFrame(other, CELL)
    got = {(r["table_no"], r["cell_no"]): (r["text"], r["replaced"]) for r in tables.merge_spaced(t, b, o, c).collect()}
    assert got == {(0, 0): ("valoare", 1), (0, 1): ("RON 71.371", 0), (1, 0): ("venit", 1), (1, 1): ("co s t", 0)}
    got = {(r["table_no"], r["cell_no"]): r["text"] for r in tables.merge_suspect(t, b, o, c).collect()}
    assert got[0, 1] == "RON 471.371" and got[1, 0] == "ve n i t"


def test_pictures(spark):
    box = lambda l, t, r, b, origin="TOPLEFT": (float(l), float(t), float(r), float(b), origin)
    rows = [(1, 0, "picture", "picture", 0, None, 1, box(0, 0, 100, 100), 0)]
    texts = [("30.09.2025", (10, 10, 20, 20)), ("30.09.2025", (200, 200, 208, 208)), ("74% 9L 2025", (10, 10, 20, 20)), ("Total active", (10, 10, 20, 20))]
    rows += [(1, i, "text", "text", 0, t, 1, box(*b), 0) for i, (t, b) in enumerate(texts, 1)]
    rows += [(2, 1, "text", "text", 0, "30.09.2025", 1, box(10, 10, 20, 20), 0), (3, 0, "picture", "picture", 0, None, 1, box(0, 300, 100, 200, "BOTTOMLEFT"), 0), (3, 1, "text", "text", 0, "30.09.2025", 1, box(10, 10, 20, 20), 0)]
    items = spark.createDataFrame(rows, io.SCHEMAS["items"])
    heights = spark.createDataFrame([(1, 1, 300.0), (2, 1, 300.0), (3, 1, 300.0)], io.SCHEMAS["pages"])
    ids = lambda df: sorted((r["doc_id"], r["item_no"]) for r in df.collect())
    dates = pictures.remove_dates_inside_pictures(items, heights)
    assert ids(dates) == [(1, 0), (1, 2), (1, 3), (1, 4), (2, 1), (3, 0)]
    assert ids(pictures.remove_axis_texts_inside_pictures(dates, heights)) == [(1, 0), (1, 2), (1, 4), (2, 1), (3, 0)]


def test_gap_threshold_and_reading():
    import numpy as np

    assert glyphs.gap_threshold(np.array([1.0]), 10, 0.35) == 3.5 and glyphs.gap_threshold(np.array([1.0, 1.0, 9.0]), 10, 0.35) == 5.0
    assert glyphs.gap_threshold(np.array([1.0, 1.1, 1.2]), 10, 0.35) == 3.5 and glyphs.gap_threshold(np.array([]), 10, 0.35) == 3.5
    at = lambda t, x, y=0.0, w=5.0: {"text": t, "x0": x, "y0": y, "x1": x + w, "y1": y + 10}
    line = [at(c, x) for c, x in zip("abcd", (0, 5.2, 16, 21.2), strict=True)]
    assert glyphs.read_pieces(line) == "ab cd" and glyphs.read_pieces([*line, at("e", 0, 20)]) == "ab cd e" and glyphs.read_pieces([]) == ""
    assert glyphs.read_pieces([at("a", 0), at(" ", 5), at("b", 10)]) == "a b" and glyphs.read_pieces([at("a", 0), at(" ", 5, 0.0, 1.0), at("b", 6)]) == "ab"
    assert glyphs.read_pieces([at("ven", 0, 0, 15), at("it", 15, 0, 10), at("net", 40, 0, 15)], whole_words=True) == "venit net"


def corpus(spark):
    box = lambda *v: (*map(float, v), "TOPLEFT")
    items = [(1, 0, "text", "section_header", 1, "Raport", 1, box(0, 0, 50, 10), 0), (1, 1, "text", "text", 1, "finan c iar  bun", 1, box(0, 20, 100, 30), 0), (1, 2, "table", "table", 1, None, 1, None, 0), (1, 3, "text", "page_footer", 1, "pag 1", 1, None, 0), (1, 4, "text", "text", 1, "Urmeaza text.", 2, None, 0)]
    cells = [cell(1, 0, 0, 0, 0, "Indicatori"), cell(1, 0, 1, 0, 1, "3130/09/2025"), cell(1, 0, 2, 1, 0, "Venit"), cell(1, 0, 3, 1, 1, "168.506.901 RON")]
    words = [(1, 1, 0, 0, 0, "financiar", 1.0, 21.0, 60.0, 29.0), (1, 1, 0, 0, 1, "bun", 65.0, 21.0, 90.0, 29.0)]
    glyph = [(1, 1, i, c, 1.0 + 6 * i, 21.0, 6.5 + 6 * i, 29.0) for i, c in enumerate("financiar")]
    make = lambda rows, name: spark.createDataFrame(rows, io.SCHEMAS[name])
    return convert.Corpus(make(items, "items"), make([(1, 1, 300.0), (1, 2, 300.0)], "pages"), make([(1, 0, 1, 2, 2)], "tables"), make(cells, "cells"), make(words, "words"), make(glyph, "glyphs"))


def test_convert(spark):
    got = convert.convert(corpus(spark)).first()["markdown"]
    assert pages(got) == ["**[Page 1]**\n\n## Raport\n\nfinanciar bun\n\n| Indicatori | 30/09/2025 |\n| --- | --- |\n| Venit | RON 168.506.901 |", "**[Page 2]**\n\nUrmeaza text."]
    again = convert.repair_spacing(corpus(spark), "docling").items.filter("item_no = 1").first()
    assert again["text"] == "financiar"


def test_cell_repair(spark):
    box = (0.0, 0.0, 62.0, 10.0, "TOPLEFT")
    cells = spark.createDataFrame([(1, 0, 1, box, "ve n i t"), (1, 1, 1, (0.0, 50.0, 62.0, 60.0, "TOPLEFT"), "cheltuiel"), (1, 2, 1, box, "Venit")], f"doc_id long, item_no int, page_no int, box {io.BOX}, text string")
    words = spark.createDataFrame([(1, 1, 0, 0, 0, "venit", 1.0, 1.0, 40.0, 9.0), (1, 1, 1, 0, 0, "cheltuieli", 1.0, 51.0, 70.0, 59.0)], io.SCHEMAS["words"])
    glyph = spark.createDataFrame([(1, 1, 0, "v", 1.0, 1.0, 6.0, 9.0)], io.SCHEMAS["glyphs"])
    got = {r["item_no"]: (r["text"], r["fixed"]) for r in glyphs.repair(cells, words, glyph, True).collect()}
    assert got == {0: ("venit", True), 1: ("cheltuieli", True), 2: ("Venit", False)}


def test_audit(spark):
    c = corpus(spark)
    docs = spark.createDataFrame([(1, "Venit 12% net net", "venit 12% | a |\n|---|\n# x"), (2, "", None)], "doc_id long, text string, markdown string")
    got = {r["doc_id"]: r for r in audit.document_metrics(docs, c.items, c.tables, c.cells).collect()}
    assert got[1]["token_coverage"] == 0.5 and got[1]["numeric_recall"] == 1.0 and got[2]["token_coverage"] == 1.0
    assert (got[1]["table_count_pdf"], got[1]["table_count_md"], got[1]["heading_count_pdf"], got[1]["heading_count_md"], got[1]["total_table_cells"], got[1]["spaced_text_items"]) == (1, 1, 1, 1, 4, 1)
    assert audit.format_metrics(got[1].asDict()).startswith("token_coverage=50.00%, numeric_recall=100.00%")


def test_select(spark):
    r = spark.createDataFrame([(1, "pypdfium2", "text bun"), (1, "docling-parse-v4", "text bun"), (2, "pypdfium2", "text"), (2, "docling-parse-v4", "ab\ntext")], "doc_id long, backend string, markdown string")
    got = {x["doc_id"]: (x["backend"], x["score"]) for x in select.best_backend(r).collect()}
    assert got[1] == ("docling-parse-v4", 100) and got[2] == ("pypdfium2", 95)
    c = corpus(spark)
    assert select.spacing_pages(c.items, c.cells, c.tables).first()["pages"] == [1]


def test_config(tmp_path, monkeypatch):
    assert config.parse_env("=x\n = y\nA=1") == {"A": "1"}
    (tmp_path / ".env").write_text("KPI_OCR=off\n=x")
    for value, want in ((None, False), (" ", False), ("on", True), ("off", False)):
        monkeypatch.delenv("KPI_OCR", raising=False)
        if value is not None:
            monkeypatch.setenv("KPI_OCR", value)
        assert config.kpi_ocr_enabled(tmp_path / ".env") is want
    monkeypatch.setenv("KPI_OCR", "on")
    config.env_into_environ(tmp_path / ".env")
    assert config.parse_languages("ron+eng, ,deu") == ["ron", "eng", "deu"] and config.parse_bool(" ON ", False) and not config.parse_bool("off", True) and config.parse_bool("?", True)
    assert config.parse_env("# c\nA=1\nB = 'x=y'\nA=\"2\"\nno") == {"A": "2", "B": "x=y"} and config.parse_page_range("2:3") == (2, 3)
    for bad in ("1", "0:3", "3:2", "a:b", "1:2:3"):
        with pytest.raises(ValueError):
            config.parse_page_range(bad)
    from pathlib import Path

    assert config.output_path(Path("a/r.pdf"), None) == Path("a/r.md") and config.output_path(Path("a/r.pdf"), "o/") == Path("o/r.md") and config.output_path(Path("r.pdf"), str(tmp_path)) == tmp_path / "r.md"
    assert config.export_path(Path("r.pdf"), "o/") == Path("o/r.docling.json") and config.export_path(Path("r.pdf"), "o/x.json") == Path("o/x.json")
    args = cli.build_parser().parse_args(["convert", "x", "--ocr", "--spacing-fix", "heuristic", "--page-range", "1:4"])
    assert (cli.options_of(args).ocr_mode, cli.options_of(args).spacing_fix, cli.options_of(args).page_range) == ("on", "pymupdf", (1, 4))


def test_command_line(spark, tmp_path, capsys):
    c = corpus(spark)
    for name in ("items", "pages", "tables", "cells", "words", "glyphs"):
        getattr(c, name).write.parquet(f"{tmp_path}/in/{name}")
    assert cli.main(["convert", f"{tmp_path}/in", "-o", f"{tmp_path}/out", "--export-json", f"{tmp_path}/json", "--audit"]) == 0
    assert "financiar bun" in io.read_markdown(spark, f"{tmp_path}/out").first()["markdown"]
    assert spark.read.text(f"{tmp_path}/json").first()[0].startswith('{"doc_id":1,"items":[')
    assert cli.main(["quality", f"{tmp_path}/out"]) == 0 and "1 score=" in capsys.readouterr().out
    assert cli.main(["audit", f"{tmp_path}/in", f"{tmp_path}/out", "--per-page"]) == 0
    assert cli.main(["convert", f"{tmp_path}/none"]) == 2 and cli.main(["convert", f"{tmp_path}/in", "--page-range", "2:2", "-o", f"{tmp_path}/two", "--files", "--quiet"]) == 0
    assert "Urmeaza" in io.read_markdown(spark, f"{tmp_path}/two/doc_id=1").first()["markdown"]
    decoded = io.extract(spark, f"{tmp_path}/in/pages", lambda path, content: [{"doc_id": 1, "page_no": len(content[:1]), "height": 2.0}], "pages")
    assert decoded.count() >= 1


def test_pictures_are_read_by_a_given_reader(spark):
    box = (0.0, 0.0, 9.0, 9.0, "TOPLEFT")
    pics = spark.createDataFrame([(1, 0, 1, box), (1, 1, 2, box), (2, 0, 1, None)], f"doc_id long, item_no int, page_no int, bbox {io.BOX}")
    files = spark.createDataFrame([(1, bytearray(b"x")), (2, bytearray(b"y"))], "doc_id long, content binary")
    reader = lambda content, page, box, languages: f"{content.decode()} {page} {box['r']} {languages}" if page == 1 else 1 / 0
    got = {(r["doc_id"], r["item_no"]): r["text"] for r in io.read_pictures(pics, files, reader, config.best_languages(["eng", "osd", "ron"])).collect()}
    assert got == {(1, 0): "x 1 9.0 ron+eng", (1, 1): ""}
    assert [r["text"] for r in io.read_pictures(pics, files, None).collect()] == [None] * 3
    assert config.best_languages(["eng"]) == "eng" and config.best_languages(["deu"]) is None


def test_boxes_grow_to_the_edge_of_the_page(spark):
    box = (0.0, 0.0, 62.0, 10.0, "TOPLEFT")
    cells = spark.createDataFrame([(1, 0, 1, 10.0, box, "ve n i t"), (2, 0, 1, None, box, "ve n i t")], f"doc_id long, item_no int, page_no int, page_height double, box {io.BOX}, text string")
    words = spark.createDataFrame([(d, 1, 0, 0, 0, "venit", 1.0, 1.0, 40.0, 9.0) for d in (1, 2)] + [(d, 1, 1, 0, 0, "afara", 1.0, 10.5, 40.0, 12.0) for d in (1, 2)], io.SCHEMAS["words"])
    near = {d: glyphs.words_in(glyphs._grown(cells, 1.0), words, glyphs._meets()).filter(F.col("doc_id") == d).first()["text"] for d in (1, 2)}
    assert near == {1: "venit", 2: "venit afara"}


def test_choice_of_readings(spark):
    item = lambda doc, no, text, page=1, kind="text": (doc, no, kind, kind, 0, text, page, None, 0)

    def reading(items, cells=()):
        make = lambda rows, name: spark.createDataFrame(rows, io.SCHEMAS[name])
        docs = sorted({i[0] for i in items})
        return convert.Corpus(make(items, "items"), make([(d, 1, 300.0) for d in docs], "pages"), make([(d, 0, 1, 1, 2) for d in docs], "tables"), make(list(cells), "cells"))

    noisy = "ab\ncd\nef"
    one = reading([item(1, 0, noisy), item(1, 1, "more", 2), item(2, 0, "A clean page."), item(3, 0, "equal")])
    two = reading([item(1, 0, "A clean page."), item(2, 0, noisy), item(3, 0, "equal, too")])
    best = convert.choose_backend({"docling-parse-v4": one, "pypdfium2": two})
    assert sorted((r["doc_id"], r["text"]) for r in best.items.collect()) == [(1, "A clean page."), (2, "A clean page."), (3, "equal")]
    assert convert.choose_backend({"docling-parse-v4": one, "pypdfium2": two}, "pypdfium2") is two and convert.choose_backend({"x": one}) is one

    long = "text " * 60
    plain = reading([item(1, 0, "short"), item(2, 0, long), item(3, 0, long), item(4, 0, "short")], [cell(3, 0, 0, 0, 0, "va l o are"), cell(3, 0, 1, 0, 1, "valoare")])
    ocr = reading([item(1, 0, "longer by a fifth"), item(2, 0, "ocr"), item(3, 0, "ocr"), item(4, 0, "short")], [cell(3, 0, 0, 0, 0, "valoare"), cell(3, 0, 1, 0, 1, "valoare")])
    got = {r["doc_id"]: r["text"] for r in convert.escalate(plain, ocr).items.collect()}
    assert got == {1: "longer by a fifth", 2: long, 3: "ocr", 4: "short"}
    assert convert.escalate(plain, ocr, "on") is ocr and convert.escalate(plain, ocr, "off") is plain and convert.escalate(plain, None) is plain


def test_stream(spark, tmp_path):
    from quillmill.streaming import documents

    spark.createDataFrame([(1, f"# R\na{B}# R\nb")], "doc_id long, markdown string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("doc_id long, markdown string").parquet(f"{tmp_path}/in")
    documents.clean_markdown(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(60)
    assert pages(spark.read.parquet(f"{tmp_path}/out").first()["markdown"])[0].startswith("**[Page 1]**")
    assert documents.scored(stream, "markdown").isStreaming
