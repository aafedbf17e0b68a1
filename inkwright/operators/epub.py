"""EPUB packages: one binary value a document, made where its chapters are."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from html import escape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTAINER = '<?xml version="1.0"?><container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/content.opf" media-type="application/oebps-package+xml"/></rootfiles></container>'


def read_template(content: bytes) -> dict[str, bytes]:
    """The files of a template package."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return {n: z.read(n) for n in z.namelist() if not n.endswith("/")}


def package_document(title: str, author: str, modified: str, chapters: list[tuple[str, str]], identifier: str, cover: bool = False) -> str:
    """The OPF document: metadata, manifest and spine, each chapter once and in order."""
    names = [f"Chapter{k:04d}.xhtml" for k in range(1, len(chapters) + 1)]
    items = "".join(f'<item id="c{k}" href="{n}" media-type="application/xhtml+xml"/>' for k, n in enumerate(names, 1))
    if cover:
        items += '<item id="cover" href="cover.jpg" media-type="image/jpeg" properties="cover-image"/>'
    spine = "".join(f'<itemref idref="c{k}"/>' for k in range(1, len(names) + 1))
    meta = f'<dc:identifier id="id">urn:uuid:{identifier}</dc:identifier><dc:title>{escape(title)}</dc:title><dc:creator>{escape(author)}</dc:creator><dc:language>ru</dc:language><meta property="dcterms:modified">{modified}</meta>'
    return f'<?xml version="1.0" encoding="utf-8"?><package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="id"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/">{meta}</metadata><manifest><item id="ncx" href="toc.ncx" media-type="application/x-dtbncx+xml"/>{items}</manifest><spine toc="ncx">{spine}</spine></package>'


def navigation(title: str, chapters: list[tuple[str, str]], identifier: str) -> str:
    """The NCX document: a point per chapter."""
    points = "".join(f'<navPoint id="n{k}" playOrder="{k}"><navLabel><text>{escape(t)}</text></navLabel><content src="Chapter{k:04d}.xhtml"/></navPoint>' for k, (t, _) in enumerate(chapters, 1))
    return f'<?xml version="1.0" encoding="utf-8"?><ncx xmlns="http://www.daisy.org/z3986/2005/ncx/" version="2005-1"><head><meta name="dtb:uid" content="urn:uuid:{identifier}"/></head><docTitle><text>{escape(title)}</text></docTitle><navMap>{points}</navMap></ncx>'


def build(title: str, author: str, chapters: list[tuple[str, str]], modified: str = "2000-01-01T00:00:00Z", template: dict[str, bytes] | None = None, cover: bytes | None = None) -> bytes:
    """An EPUB of (title, xhtml) chapters: mimetype first and stored, the rest deflated; old chapters of a template go."""
    identifier = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{title}\n{author}"))
    files = {n: b for n, b in (template or {}).items() if not n.rsplit("/", 1)[-1].startswith(("Section", "Chapter")) and n != "mimetype"}
    files |= {"META-INF/container.xml": CONTAINER.encode(), "OEBPS/content.opf": package_document(title, author, modified, chapters, identifier, cover is not None).encode(), "OEBPS/toc.ncx": navigation(title, chapters, identifier).encode()}
    files |= {f"OEBPS/Chapter{k:04d}.xhtml": x.encode() for k, (_, x) in enumerate(chapters, 1)}
    if cover is not None:
        files["OEBPS/cover.jpg"] = cover
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(zipfile.ZipInfo("mimetype", (2000, 1, 1, 0, 0, 0)), "application/epub+zip", zipfile.ZIP_STORED)
        for name in sorted(files):
            z.writestr(zipfile.ZipInfo(name, (2000, 1, 1, 0, 0, 0)), files[name], zipfile.ZIP_DEFLATED)
    return out.getvalue()


def packages(pages: DataFrame, title: str, author: str = "", key: str = "doc_id", template: dict[str, bytes] | None = None, cover: bytes | None = None) -> DataFrame:
    """key, epub: a package of each document's chapter pages."""
    files = titled(template, title, author) if template else None

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [build(title, author, [(c["title"], c["xhtml"]) for c in chapters], template=files, cover=cover) for chapters in batch.column("c").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(made, pa.binary())], [key, "epub"])

    ordered = F.array_sort(F.collect_list(F.struct("chapter_id", "title", "xhtml")))
    grouped = pages.groupBy(key).agg(ordered.alias("c"))
    return grouped.mapInArrow(make, f"{key} {pages.schema[key].dataType.simpleString()}, epub binary")


def titled(template: dict[str, bytes], title: str, author: str) -> dict[str, bytes]:
    """A template's files with title and author put into the first h1 and h2 of its title page."""
    out = {}
    for name, content in template.items():
        if re.search(r"title[^/]*\.x?html$", name, re.I):
            text = content.decode("utf-8", "replace")
            for tag, value in (("h1", title), ("h2", author)):
                text = re.sub(rf"(?is)(<{tag}[^>]*>).*?(</{tag}>)", lambda m, v=value: m[1] + escape(v) + m[2], text, count=1)
            content = text.encode()
        out[name] = content
    return out


def package_files(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, place, name, content: the text files of packages in their order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, content in zip(batch.column(key), batch.column("epub").to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    listed = [i for i in z.infolist() if i.filename == "mimetype" or i.filename.endswith((".xml", ".opf", ".ncx", ".xhtml"))]
                    texts = [z.read(i).decode("utf-8", "replace") for i in listed]
                    stored = [i.compress_type == zipfile.ZIP_STORED for i in listed]
                keys = pa.array([own.as_py()] * len(listed), own.type)
                yield pa.RecordBatch.from_arrays([keys, pa.array(range(len(listed)), pa.int32()), pa.array([i.filename for i in listed]), pa.array(stored), pa.array(texts)], [key, "place", "name", "stored", "content"])

    return packed.select(key, "epub").mapInArrow(read, f"{key} {packed.schema[key].dataType.simpleString()}, place int, name string, stored boolean, content string")
