"""Optional outside engines, imported only when they are asked for; none is needed by the rest."""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def _match(offset: int, length: int, values: list[str], rule: str, note: str = "") -> dict:
    return {"offset": offset, "length": length, "replacements": [{"value": v} for v in values], "rule": {"id": rule, "description": note}}


class WordChecker:
    """A checker from a function that corrects one word."""

    def __init__(self, name: str, fix):
        self.name, self.fix = name, fix

    def check(self, text: str) -> list[dict]:
        import re

        found = []
        for m in re.finditer(r"\b[А-Яа-яёЁ]+\b", text):
            fixed = self.fix(m[0].lower())
            if fixed and fixed.lower() != m[0].lower():
                value = fixed.capitalize() if m[0][0].isupper() else fixed
                found.append(_match(m.start(), len(m[0]), [value], "LOCAL_SPACE", self.name))
        return found


def pyspell_checker(lang: str = "ru", distance: int = 2, **_) -> WordChecker:
    from spellchecker import SpellChecker

    engine = SpellChecker(language=lang, distance=distance)
    return WordChecker("pyspellchecker", engine.correction)


def jamspell_checker(model_path: str | None = None, **_) -> WordChecker:
    import jamspell

    if not model_path:
        raise ValueError("a model path is needed")
    engine = jamspell.TSpellCorrector()
    engine.LoadLangModel(model_path)
    return WordChecker("jamspell", engine.FixFragment)


def symspell_checker(dictionary_path: str | None = None, distance: int = 2, **_) -> WordChecker:
    from symspellpy import SymSpell, Verbosity

    engine = SymSpell(max_dictionary_edit_distance=distance, prefix_length=7)
    if dictionary_path:
        engine.load_dictionary(dictionary_path, term_index=0, count_index=1)

    def fix(word: str) -> str | None:
        found = engine.lookup(word, Verbosity.CLOSEST, max_edit_distance=distance)
        return found[0].term if found else None

    return WordChecker("symspell", fix)


MAKERS = {"pyspellchecker": pyspell_checker, "jamspell": jamspell_checker, "symspell": symspell_checker}


class LanguageToolChecker:
    """Matches of a LanguageTool service at `url`; nothing is sent unless it is used."""

    def __init__(self, url: str, language: str = "ru-RU", timeout: float = 60.0):
        self.name, self.url, self.language, self.timeout = "languagetool", url, language, timeout

    def check(self, text: str) -> list[dict]:
        body = urllib.parse.urlencode({"text": text, "language": self.language}).encode()
        with urllib.request.urlopen(self.url, body, self.timeout) as answer:
            return json.load(answer).get("matches", [])


class WordServiceChecker:
    """Matches of a speller service that answers [{pos, len, s: [...]}, ...]; entries without suggestion are dropped."""

    def __init__(self, url: str, lang: str = "ru", timeout: float = 60.0):
        self.name, self.url, self.lang, self.timeout = "speller", url, lang, timeout

    def check(self, text: str) -> list[dict]:
        body = urllib.parse.urlencode({"text": text, "lang": self.lang}).encode()
        with urllib.request.urlopen(self.url, body, self.timeout) as answer:
            return [_match(e["pos"], e["len"], e["s"][:1], "SPELLER_SPACE", str(e.get("code", ""))) for e in json.load(answer) if e.get("s")]


def pdf_pages(files: DataFrame) -> DataFrame:
    """Page records (see operators.layout.PAGES) of PDF files read with the binaryFile source; needs PyMuPDF."""
    from inkwright.operators.layout import PAGES

    line = pa.struct([("spans", pa.list_(pa.struct([("text", pa.string()), ("size", pa.float64())])))])
    block = pa.struct([("type", pa.int32()), ("bbox", pa.list_(pa.float64())), ("lines", pa.list_(line))])
    schema = pa.schema([("doc_id", pa.string()), ("page", pa.int32()), ("width", pa.float64()), ("blocks", pa.list_(block))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import fitz

        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = []
                with fitz.open(stream=content, filetype="pdf") as pdf:
                    for n, page in enumerate(pdf, 1):
                        blocks = [{"type": b["type"], "bbox": [float(x) for x in b["bbox"]], "lines": [{"spans": [{"text": s["text"], "size": s["size"]} for s in line["spans"]]} for line in b.get("lines", [])]} for b in page.get_text("dict")["blocks"]]
                        rows.append({"doc_id": path, "page": n, "width": float(page.rect.width), "blocks": blocks})
                if rows:
                    yield from pa.Table.from_pylist(rows, schema).to_batches()

    return files.select("path", "content").mapInArrow(scan, PAGES)


def cover_image(title: str, author: str = "", width: int = 1200, height: int = 1600, colors: list[tuple[int, int, int]] | None = None) -> bytes:
    """A plain JPEG cover: bands of five colours, and title and author in between; needs Pillow."""
    import io
    import textwrap
    import zlib

    from PIL import Image, ImageDraw, ImageFont

    seed = zlib.crc32(f"{title}/{author}".encode())
    colors = colors or [tuple((seed >> 3 * k + 7 * c) % 160 + 40 for c in range(3)) for k in range(5)]
    image = Image.new("RGB", (width, height), colors[0])
    draw, font = ImageDraw.Draw(image), ImageFont.load_default(size=height // 22)
    for k, color in enumerate(colors[1:], 1):
        draw.rectangle((0, height * (k + 2) // 8, width, height), fill=color)
    for k, line in enumerate([*textwrap.wrap(title, 22), "", *textwrap.wrap(author, 26)]):
        draw.text((width // 12, height // 12 + k * height // 18), line, fill=(255, 255, 255), font=font)
    out = io.BytesIO()
    image.save(out, "JPEG", quality=90)
    return out.getvalue()
