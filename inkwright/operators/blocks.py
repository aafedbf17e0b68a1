"""Blocks: from texts and HTML, heading heuristics, and merging broken paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwright.functions import text as T

#: Line boundaries of Python's splitlines.
LINES = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
# Fixed value: how a sentence ends.
END_OF_SENTENCE = r"(?U)[.!?…][»”)\]\"]?\s*$"


def _paragraph_block(paragraph: Column) -> Column:
    """struct<role, text> of one paragraph; the text is empty when there is none."""
    lines = F.filter(F.transform(F.split(T.strip(paragraph), LINES, -1), T.strip), lambda x: x != "")
    first = F.element_at(lines, 1)
    short = (F.length(first) < 100) & (T.is_upper(first) | ((F.size(lines) == 1) & (F.length(first) < 50))) & ~first.rlike("[.,;:!?]$")
    role = F.when(F.size(lines) == 0, F.lit(None)).when(short | T.section_heading(first), "heading").otherwise("paragraph")
    return F.struct(role.alias("role"), T.collapse(F.array_join(lines, " ")).alias("text"))


def paragraphs_to_blocks(paragraphs: Column) -> Column:
    """array<struct<role, text>> of an array of paragraphs."""
    return F.filter(F.transform(paragraphs, _paragraph_block), lambda b: b["text"] != "")


def text_paragraphs(text: Column) -> Column:
    """Parts between blank lines; a text without blank lines falls into its lines."""
    parts = F.split(text, r"\n(?U)\s*\n", -1)
    return F.when((F.size(parts) <= 1) & text.contains("\n"), F.split(text, LINES, -1)).otherwise(parts)


def exploded(df: DataFrame, blocks: Column, key: str) -> DataFrame:
    """A row per block: key, block_id, role, text."""
    return df.select(key, F.posexplode(blocks).alias("block_id", "b")).select(key, "block_id", "b.role", "b.text")


def text_blocks(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of plain texts."""
    return exploded(texts, paragraphs_to_blocks(text_paragraphs(F.coalesce(F.col(text), F.lit("")))), key)


HEADING_OR_PARAGRAPH = r"(?is)<h2[^>]*>(.*?)</h2>|<p[^>]*>(.*?)</p>"


def html_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Blocks of HTML: the first pre element's paragraphs if there is one, else h2 and p elements in order."""
    source = F.coalesce(F.col(html), F.lit(""))
    pre = F.regexp_extract(source, r"(?is)<pre[^>]*>(.*?)</pre>", 1)
    has_pre = source.rlike(r"(?is)<pre[^>]*>.*?</pre>")
    of_pre = paragraphs_to_blocks(F.split(T.strip_tags(T.unescape_html(pre)), r"\n(?U)\s*\n", -1))

    def block(element: Column) -> Column:
        is_heading = element.rlike(r"(?i)^<h2")
        inner = F.regexp_replace(F.regexp_replace(element, r"(?is)^<(?:h2|p)[^>]*>|</(?:h2|p)>$", ""), r"(?is)<mark[^>]*>(.*?)</mark>", "$1")
        return F.struct(F.when(is_heading, "heading").otherwise("paragraph").alias("role"), T.collapse(T.unescape_html(T.strip_tags(inner))).alias("text"))

    of_elements = F.filter(F.transform(F.regexp_extract_all(source, F.lit(HEADING_OR_PARAGRAPH), 0), block), lambda b: b["text"] != "")
    return exploded(pages, F.when(has_pre, of_pre).otherwise(of_elements), key)


def ends_sentence(text: Column) -> Column:
    return text.rlike(END_OF_SENTENCE)


def join_continuation(before: Column, after: Column) -> Column:
    """Glue a hyphenated word together; else one space unless there is one or punctuation follows."""
    glue = before.rlike(r"(?U)[-‑–—]\s*$") & after.rlike(r"^[A-Za-zА-Яа-яЁё]")
    bare = before.rlike(" $") | after.rlike(r"^[ ,.;:!?…»)\]]")
    return F.when(glue, F.concat(F.regexp_replace(before, r"(?U)[-‑–—]\s*$", ""), after)).when(bare, F.concat(before, after)).otherwise(F.concat(before, F.lit(" "), after))


def merge_paragraphs(blocks: DataFrame, key: str = "doc_id", total: str | None = None) -> DataFrame:
    """Paragraph blocks joined up to the end of a sentence; headings stand alone: key, merged_id, role, text, and `total`, a column to add up.

    Where a group ends depends on single rows, so groups are a running count over one sort by
    document, and each group's texts are folded in order. A group is as long as one broken paragraph.
    """
    own = Window.partitionBy(key).orderBy("block_id")
    carried = [total] if total else []
    rows = blocks.select(key, "block_id", "role", T.normalize_linebreaks(F.col("text")).alias("text"), *carried)
    closes = (F.col("role") == "heading") | ends_sentence(F.col("text"))
    before = F.lag(closes, 1, True).over(own)
    opens = (F.col("role") == "heading") | before
    grouped = rows.withColumn("opens", opens.cast("int")).withColumn("merged_id", F.sum("opens").over(own.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    parts = F.array_sort(F.collect_list(F.struct("block_id", "text")))
    gathered = grouped.groupBy(key, "merged_id").agg(F.min_by("role", "block_id").alias("role"), parts.alias("parts"), *(F.sum(c).alias(c) for c in carried))
    text = F.aggregate("parts", F.lit(None).cast("string"), lambda acc, x: F.when(acc.isNull(), x["text"]).otherwise(join_continuation(acc, x["text"])))
    return gathered.select(key, F.col("merged_id").cast("int").alias("merged_id"), F.when(F.col("role") == "heading", "heading").otherwise("paragraph").alias("role"), text.alias("text"), *carried)
