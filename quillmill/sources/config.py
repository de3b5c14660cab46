"""Options of a conversion and how they are read from strings, environment and files."""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path

TRUE, FALSE = {"1", "true", "yes", "on"}, {"0", "false", "no", "off"}
BACKENDS = ("docling-parse-v4", "pypdfium2")
#: What is exported: the body's labels, with captions and footnotes, without page furniture and indexes.
EXPORT_LABELS = ("caption", "checkbox_selected", "checkbox_unselected", "code", "footnote", "formula", "grading_scale", "handwritten_text", "key_value_region", "list_item", "paragraph", "picture", "reference", "section_header", "table", "text", "title")


@dataclass(frozen=True)
class OcrOptions:
    engine: str = "tesseract"
    languages: tuple[str, ...] = ("eng",)
    full_page: bool = False


@dataclass(frozen=True)
class Options:
    """What an extractor is asked for, and which repairs follow."""

    image_mode: str = "placeholder"
    max_pages: int | None = None
    page_range: tuple[int, int] | None = None
    ocr_mode: str = "off"
    ocr: OcrOptions = field(default_factory=OcrOptions)
    spacing_fix: str = "pymupdf"
    pdf_backend: str = "auto"
    device: str = "cuda"
    cell_matching: bool = True
    images_scale: float = 2.0
    accurate_tables: bool = True
    kpi_ocr: bool = True

    @property
    def picture_images(self) -> bool:
        return self.image_mode != "placeholder"


def parse_languages(text: str) -> list[str]:
    """`ron+eng` or `ron,eng` as a list."""
    return [x for x in (part.strip() for part in text.replace("+", ",").split(",")) if x]


def best_languages(available: Iterable[str]) -> str | None:
    """Of the languages an OCR engine has, those to read key figures with: Romanian and English, else one of them, else None."""
    have = set(available)
    found = [x for x in ("ron", "eng") if x in have]
    return "+".join(found) or None


def ocr_options(engine: str, languages: str, full_page: bool = False) -> OcrOptions:
    return OcrOptions(engine if engine in ("tesseract", "rapidocr", "easyocr") else "auto", tuple(parse_languages(languages)), full_page)


def parse_bool(value: str | None, default: bool) -> bool:
    word = (value or "").strip().lower()
    return word in TRUE if word in TRUE | FALSE else default


def parse_env(text: str) -> dict[str, str]:
    """KEY=value lines; blank lines, comments and lines without a key or = are skipped, quotes around values dropped, later keys win."""
    out = {}
    for line in map(str.strip, text.splitlines()):
        if line and not line.startswith("#") and "=" in line:
            key, _, value = line.partition("=")
            if key.strip():
                out[key.strip()] = value.strip().strip('"').strip("'")
    return out


def load_env(path: str | Path) -> dict[str, str]:
    p = Path(path)
    return parse_env(p.read_text(encoding="utf-8")) if p.exists() else {}


def env_into_environ(path: str | Path = ".env") -> None:
    """Values of the file, where the environment has none of that name."""
    for key, value in load_env(path).items():
        os.environ.setdefault(key, value)


def kpi_ocr_enabled(path: str | Path = ".env") -> bool:
    """Of the environment, or of the file where that has no or a blank value."""
    own = os.environ.get("KPI_OCR", "")
    return parse_bool(own if own.strip() else load_env(path).get("KPI_OCR"), True)


def parse_page_range(text: str) -> tuple[int, int]:
    """`a:b`, from 1, b not before a."""
    parts = text.split(":")
    try:
        first, last = (int(p) for p in parts)
    except ValueError:
        raise ValueError("a page range looks like 1:10") from None
    if not 1 <= first <= last:
        raise ValueError("a page range begins at 1 or later and doesn't end before it begins")
    return first, last


def _in_folder(source: Path, target: str, name: str) -> Path | None:
    folder = target.endswith(("/", "\\")) or Path(target).is_dir()
    return Path(target) / name if folder else None


def output_path(source: Path, target: str | None) -> Path:
    """Where the Markdown of a source goes: beside it, into a folder, or to the file named."""
    if target is None:
        return source.with_suffix(".md")
    return _in_folder(source, target, f"{source.stem}.md") or Path(target)


def export_path(source: Path, target: str) -> Path:
    return _in_folder(source, target, f"{source.stem}.docling.json") or Path(target)
