"""Page layout: block texts, font sizes, roles and reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwright.functions import text as T

PAGE_BLOCKS = "array<struct<type:int,bbox:array<double>,lines:array<struct<spans:array<struct<text:string,size:double>>>>>>"
PAGES = f"doc_id string, page int, width double, blocks {PAGE_BLOCKS}"


def block_text(lines: Column) -> Column:
    """Spans of a line side by side, lines one under the other, then line ends, hyphens and blanks normalised."""
    joined = F.array_join(F.transform(lines, lambda line: F.array_join(F.transform(line["spans"], lambda s: F.coalesce(s["text"], F.lit(""))), "")), "\n")
    rules = [(r"(?U)(\w)[-‑–—]\n(?=\w)", "$1"), (r"(?<!\n)\n(?!\n)", " "), (r"[ \t]{2,}", " ")]
    return T.strip(T.replace_all(T.unify_linebreaks(joined), rules))


def block_sizes(lines: Column) -> Column:
    """struct<weight, chars>: sum of size times length, and of length, over spans with a size and a text."""
    spans = F.filter(F.flatten(F.transform(lines, lambda line: line["spans"])), lambda s: (F.coalesce(s["size"], F.lit(0.0)) != 0) & (F.length(F.coalesce(s["text"], F.lit(""))) > 0))
    start = F.struct(F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("chars"))
    return F.aggregate(spans, start, lambda acc, s: F.struct((acc["weight"] + s["size"] * F.length(s["text"])).alias("weight"), (acc["chars"] + F.length(s["text"])).alias("chars")))


def page_blocks(pages: DataFrame) -> DataFrame:
    """Text blocks of pages: doc_id, page, width, block_ord, text, wsize, line_count, chars, bbox."""
    exploded = pages.select("doc_id", "page", "width", F.posexplode("blocks").alias("block_ord", "b")).where("b.type = 0")
    lines = F.col("b.lines")
    rows = exploded.select("doc_id", "page", "width", "block_ord", block_text(lines).alias("text"), block_sizes(lines).alias("s"), F.size(lines).alias("line_count"), F.col("b.bbox").alias("bbox"))
    return rows.where("text <> '' and s.chars > 0").select("doc_id", "page", "width", "block_ord", "text", (F.col("s.weight") / F.col("s.chars")).alias("wsize"), "line_count", F.col("s.chars").alias("chars"), "bbox")


def upper_median(blocks: DataFrame) -> DataFrame:
    """doc_id, page, median: the upper of the two middle font sizes, by rank and not by gathering a page's sizes."""
    own = Window.partitionBy("doc_id", "page")
    ranked = blocks.select("doc_id", "page", "wsize", F.row_number().over(own.orderBy("wsize")).alias("r"), F.count("*").over(own).alias("n"))
    return ranked.where(F.col("r") == F.floor(F.col("n") / 2) + 1).select("doc_id", "page", F.col("wsize").alias("median"))


def with_roles(blocks: DataFrame) -> DataFrame:
    """Blocks with role heading or paragraph, by size against the page's median, length and place."""
    rows = blocks.join(upper_median(blocks), ["doc_id", "page"])
    x0, x1 = F.element_at("bbox", 1), F.element_at("bbox", 3)
    short = (F.col("line_count") <= 3) & (F.col("chars") <= 200)
    centered = F.abs((x0 + x1) / 2 - F.col("width") / 2) < F.col("width") * 0.12
    wide = (x1 - x0) > F.col("width") * 0.45
    heading = ((F.col("wsize") >= F.col("median") * 1.35 + 0.5) & short) | (centered & short & ~wide)
    return rows.withColumn("role", F.when(heading, "heading").otherwise("paragraph"))


def reading_order(blocks: DataFrame, two_columns: bool = False) -> DataFrame:
    """Blocks with `place`, their order on the page from 0: by y0 then x0, or left column before right."""
    x0, y0, x1 = (F.element_at("bbox", k) for k in (1, 2, 3))
    side = ((x0 + x1) / 2 >= F.col("width") / 2).cast("int")
    keys = (side, y0, F.col("block_ord")) if two_columns else (y0, x0, F.col("block_ord"))
    return blocks.withColumn("place", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy(*keys)) - 1)


def structured(pages: DataFrame, two_columns: bool = False) -> DataFrame:
    """doc_id, block_id, page, role, text, wsize, bbox: the blocks of whole documents in reading order."""
    rows = reading_order(with_roles(page_blocks(pages)), two_columns)
    block_id = F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "place")) - 1
    return rows.select("doc_id", block_id.alias("block_id"), "page", "role", "text", "wsize", "bbox")
