"""Command line: `convert` an extracted corpus to Markdown, `audit` Markdown against it, score `quality`."""

from __future__ import annotations

import argparse
import os
import sys

from quillmill.sources import config


def _page_range(text: str) -> tuple[int, int]:
    try:
        return config.parse_page_range(text)
    except ValueError as error:
        raise argparse.ArgumentTypeError(str(error)) from None


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quillmill", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    convert = sub.add_parser("convert", help="extracted tables to Markdown")
    convert.add_argument("input", nargs="?", help="folder of the extracted tables (default: FIN_REPORT_PDF)")
    convert.add_argument("-o", "--output")
    convert.add_argument("--images-dir")
    convert.add_argument("--audit", action="store_true", help="print the audit and the worst pages")
    convert.add_argument("--export-json")
    convert.add_argument("--files", action="store_true", help="write a Markdown file for each document, not Parquet")
    audit = sub.add_parser("audit", help="Markdown against extracted tables")
    audit.add_argument("input")
    audit.add_argument("markdown")
    audit.add_argument("--per-page", action="store_true")
    audit.add_argument("--top", type=int, default=5)
    for p in (convert, audit):
        p.add_argument("--image-mode", choices=("placeholder", "embedded", "referenced"), default="placeholder")
        p.add_argument("--max-pages", type=int)
        p.add_argument("--page-range", type=_page_range)
        p.add_argument("--ocr", action=argparse.BooleanOptionalAction, default=False)
        p.add_argument("--ocr-mode", choices=("off", "on", "auto"), default="off")
        p.add_argument("--ocr-engine", choices=("auto", "tesseract", "rapidocr", "easyocr"), default="tesseract")
        p.add_argument("--ocr-lang", default="eng")
        p.add_argument("--force-full-page-ocr", action="store_true")
        p.add_argument("--fix-spaced-tables", action="store_true", help="deprecated: --spacing-fix")
        p.add_argument("--spacing-fix", choices=("off", "pymupdf", "docling", "heuristic", "ocr"), default="pymupdf")
        p.add_argument("--pdf-backend", choices=("auto", "pypdfium2", "docling-parse-v4"), default="auto")
        p.add_argument("--device", default="cuda")
        p.add_argument("--quiet", action="store_true")
    quality = sub.add_parser("quality", help="score Markdown files")
    quality.add_argument("input")
    return parser


def options_of(args: argparse.Namespace) -> config.Options:
    fix = {"heuristic": "pymupdf"}.get(args.spacing_fix, args.spacing_fix)
    if args.fix_spaced_tables and fix == "off":
        fix = "ocr"
    ocr = config.ocr_options(args.ocr_engine, args.ocr_lang, args.force_full_page_ocr)
    return config.Options(args.image_mode, args.max_pages, args.page_range, "on" if args.ocr else args.ocr_mode, ocr, fix, args.pdf_backend, args.device, kpi_ocr=config.kpi_ocr_enabled())


def load(spark, path: str, options: config.Options):
    """The reading under path; tables of words, glyphs and OCR only where they are there. None if there is no reading."""
    from pyspark.errors import AnalysisException

    from quillmill.plans.convert import Corpus
    from quillmill.sources.io import read_table

    pages = options.page_range or ((1, options.max_pages) if options.max_pages else None)

    def maybe(name: str):
        try:
            return read_table(spark, path, name, page_range=pages)
        except AnalysisException:
            return None

    need = {n: maybe(n) for n in ("items", "pages", "tables", "cells")}
    if None in need.values():
        return None
    return Corpus(**need, **{n: maybe(n) for n in ("words", "glyphs", "ocr_tables", "ocr_cells", "ocr_items")})


def load_readings(spark, path: str, options: config.Options):
    """The readings under path by backend, each in a folder of its name, or the one reading there; and the reading by OCR, in the folder `ocr`, or None."""
    found = {b: load(spark, f"{path}/{b}", options) for b in config.BACKENDS}
    found = {b: c for b, c in found.items() if c is not None}
    if not found:
        one = load(spark, path, options)
        found = {config.BACKENDS[0] if options.pdf_backend == "auto" else options.pdf_backend: one} if one is not None else {}
    return found, load(spark, f"{path}/ocr", options)


def main(argv: list[str] | None = None) -> int:
    config.env_into_environ()
    args = build_parser().parse_args(argv)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from quillmill.operators import audit, quality
    from quillmill.plans import convert as plan
    from quillmill.sources import io

    spark = SparkSession.builder.appName("quillmill").getOrCreate()
    if args.command == "quality":
        scored = io.read_markdown(spark, args.input).select("path", quality.format_report(quality.report(F.col("markdown"))).alias("report"))
        for row in scored.toLocalIterator():
            print(row["path"], row["report"])
        return 0
    options, source = options_of(args), args.input or os.environ.get("FIN_REPORT_PDF")
    if not source:
        print("no input, and FIN_REPORT_PDF isn't set", file=sys.stderr)
        return 2
    readings, ocr = load_readings(spark, source, options)
    if not readings or options.pdf_backend not in ("auto", *readings):
        print(f"no extracted tables under {source}" + f" by {options.pdf_backend}" * bool(readings), file=sys.stderr)
        return 2
    corpus = plan.escalate(plan.choose_backend(readings, options.pdf_backend), ocr, options.ocr_mode)
    say = (lambda *_: None) if args.quiet else (lambda *x: print(*x, file=sys.stderr))
    say("backends:", *readings, "ocr:", options.ocr_mode if ocr is not None else "no reading")
    by_page = corpus.items.filter("text IS NOT NULL AND page_no IS NOT NULL").groupBy("doc_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_no", "text"))), lambda x: x["text"]), "\n").alias("text"))
    if args.command == "convert":
        fixed = plan.repair(corpus, options)
        docs = plan.markdown.clean(plan.export(fixed), remove_images=options.image_mode == "placeholder")
        target = args.output or f"{source.rstrip('/')}.md"
        io.write_markdown(docs, target, args.files)
        say("written:", target)
        if args.export_json:
            io.write_json(io.document_json(fixed.items, fixed.tables, fixed.cells), args.export_json)
        if not args.audit:
            return 0
        top = 5
    else:
        docs, top = spark.read.schema(io.SCHEMAS["markdown"]).parquet(args.markdown), args.top if args.per_page else 0
    whole = by_page.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda x: x["text"]), "\n").alias("text"))
    metrics = audit.document_metrics(docs.join(whole, "doc_id", "left"), corpus.items, corpus.tables, corpus.cells)
    for row in metrics.orderBy("doc_id").toLocalIterator():
        print(row["doc_id"], audit.format_metrics(row.asDict()))
    for row in audit.worst_pages(audit.per_page(by_page, docs), top).collect() if top else ():
        print(row.asDict())
    return 0


if __name__ == "__main__":
    sys.exit(main())
