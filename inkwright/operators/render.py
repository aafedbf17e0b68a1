"""Renderers: structured JSON, plain text, HTML and chapter pages, one row a document or chapter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwright.functions import text as T

# The beginning and end of a page.
HEAD = '<!doctype html>\n<html lang="ru">\n<head>\n<meta charset="utf-8"/>\n<title>%s</title>\n</head>\n<body>\n'
FOOT = "\n</body>\n</html>\n"


def _ordered(order: str, *columns: str) -> Column:
    return F.array_sort(F.collect_list(F.struct(order, *columns)))


def structured_json(blocks: DataFrame, file: str = "", key: str = "doc_id") -> DataFrame:
    """key, json: {"file", "blocks": [...]} with the blocks in order."""
    columns = [c for c in ("page", "role", "text", "wsize", "bbox") if c in blocks.columns]
    rows = F.transform(_ordered("block_id", *columns), lambda b: F.struct(*(b[c].alias(c) for c in columns)))
    return blocks.groupBy(key).agg(F.to_json(F.struct(F.lit(file).alias("file"), rows.alias("blocks"))).alias("json"))


def plain_text(blocks: DataFrame, order: str = "block_id", key: str = "doc_id") -> DataFrame:
    """key, text: block texts without tags, with an empty line between."""
    return blocks.groupBy(key).agg(F.array_join(F.transform(_ordered(order, "text"), lambda b: T.strip_tags(b["text"])), "\n\n").alias("text"))


def _page(title: Column, body: Column) -> Column:
    before, after = HEAD.split("%s")
    return F.concat(F.lit(before), T.escape_html(title), F.lit(after), body, F.lit(FOOT))


def html(blocks: DataFrame, title: str, order: str = "block_id", key: str = "doc_id", escape: bool = True) -> DataFrame:
    """key, html: headings as h2 and paragraphs as p; marked-up text is not escaped again."""

    def element(b: Column) -> Column:
        body = T.escape_html(b["text"]) if escape else b["text"]
        return F.when(b["role"] == "heading", F.concat(F.lit("<h2>"), body, F.lit("</h2>"))).otherwise(F.concat(F.lit("<p>"), body, F.lit("</p>")))

    return blocks.groupBy(key).agg(_page(F.lit(title), F.array_join(F.transform(_ordered(order, "role", "text"), element), "\n")).alias("html"))


def pre_html(text: Column, title: str) -> Column:
    """A page with the text as it stands."""
    return _page(F.lit(title), F.concat(F.lit("<pre>"), T.escape_html(text), F.lit("</pre>")))


def paragraphs_html(text: Column, title: str) -> Column:
    """A page with a p element for each part between blank lines."""
    parts = F.filter(F.transform(F.split(text, r"\n(?U)\s*\n", -1), T.strip), lambda p: p != "")
    return _page(F.lit(title), F.array_join(F.transform(parts, lambda p: F.concat(F.lit("<p>"), T.escape_html(p), F.lit("</p>"))), "\n"))


def flags_json(flags: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, json: the flag report of a document."""
    rows = F.transform(_ordered("block", "role", "flags"), lambda b: F.struct(b["block"].alias("block"), b["role"].alias("role"), b["flags"].alias("flags")))
    return flags.groupBy(key).agg(F.to_json(rows).alias("json"))


def chapter_xhtml(chapters: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, chapter_id, title, xhtml: a page per chapter, its title as h2 unless its first block is that heading."""

    def element(b: Column) -> Column:
        body = T.escape_html(b["text"])
        return F.when(b["role"] == "heading", F.concat(F.lit("<h2>"), body, F.lit("</h2>"))).otherwise(F.concat(F.lit("<p>"), body, F.lit("</p>")))

    blocks = _ordered("block_id", "role", "text")
    head = '<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE html>\n<html xmlns="http://www.w3.org/1999/xhtml" lang="ru">\n<head><title>'
    grouped = chapters.groupBy(key, "chapter_id").agg(F.min("title").alias("title"), blocks.alias("b"))
    opening = F.when(F.get("b", F.lit(0))["role"] == "heading", F.lit("")).otherwise(F.concat(F.lit("<h2>"), T.escape_html(F.col("title")), F.lit("</h2>\n")))
    page = F.concat(F.lit(head), T.escape_html(F.col("title")), F.lit("</title></head>\n<body>\n"), opening, F.array_join(F.transform("b", element), "\n"), F.lit("\n</body>\n</html>\n"))
    return grouped.select(key, "chapter_id", "title", page.alias("xhtml"))


def patch_title_page(page: Column, title: str, author: str) -> Column:
    """A title page's first h1 and h2 elements with the book's title and author."""
    named = F.regexp_replace(page, r"(?is)(<h1[^>]*>).*?(</h1>)", "$1" + title.replace("\\", r"\\").replace("$", r"\$") + "$2")
    return F.regexp_replace(named, r"(?is)(<h2[^>]*>).*?(</h2>)", "$1" + author.replace("\\", r"\\").replace("$", r"\$") + "$2")
