"""Readers: structured JSON, page records, whole texts and HTML, and the choice among versions of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.functions import text as T
from inkwright.operators.layout import PAGES

BLOCKS = "array<struct<page:int,role:string,text:string,wsize:double,bbox:array<double>>>"


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the path), text: a row a file that is not empty."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def json_blocks(c: Column) -> Column:
    """The blocks of a document that is an object with `blocks` or a bare list; anything else is an error."""
    first = F.left(F.ltrim(c), F.lit(1))
    bare = F.from_json(c, BLOCKS)
    held = F.from_json(c, f"blocks {BLOCKS}")["blocks"]
    return F.when(first == "[", bare).when(first == "{", F.coalesce(held, F.array().cast(BLOCKS))).otherwise(F.raise_error(F.lit("neither an object nor a list")).cast(BLOCKS))


def structured_json(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, block_id, page, role, text, wsize, bbox of structured JSON files of either shape."""
    rows = whole_texts(spark, path).select("doc_id", F.posexplode(json_blocks(F.col("text"))).alias("block_id", "b"))
    return rows.select("doc_id", "block_id", "b.*").withColumn("text", F.coalesce("text", F.lit("")))


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """Page records, a JSON object a line, in the schema of operators.layout.PAGES."""
    return spark.read.schema(PAGES).json(path)


def page_texts(pages: DataFrame) -> DataFrame:
    """doc_id, text: the plain text of all pages, a line end between."""
    text = F.array_join(F.flatten(F.transform("blocks", lambda b: F.transform(b["lines"], lambda line: F.array_join(F.transform(line["spans"], lambda s: s["text"]), "")))), "\n")
    rows = pages.select("doc_id", "page", text.alias("text"))
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "\n").alias("text"))


# The versions of a document in order of preference.
PREFERENCE = ("final_clean.txt", "final.txt", "structured_rules.json", "structured.json", "final_clean.html")


def valid_version(name: Column, text: Column) -> Column:
    """Whether a version can be used: texts of 50 characters with a letter, JSON with a block that is not blank, HTML with text in elements."""
    bare = T.strip(F.coalesce(text, F.lit("")))
    is_text = (F.length(bare) >= 50) & bare.rlike(r"(?U)\p{L}")
    blocks = F.when(F.left(F.ltrim(text), F.lit(1)) == "[", F.from_json(text, BLOCKS)).otherwise(F.from_json(text, f"blocks {BLOCKS}")["blocks"])
    is_json = F.coalesce(F.exists(blocks, lambda b: T.strip(F.coalesce(b["text"], F.lit(""))) != ""), F.lit(False))
    only_pre = bare.rlike("(?i)<pre") & ~bare.rlike(r"(?i)<(?:h[1-6]|p|div|section|article|header|footer)\b")
    is_html = (T.strip(T.strip_tags(bare)) != "") & ~only_pre
    return F.when(name.rlike(r"\.txt$"), is_text).when(name.rlike(r"\.json$"), is_json).when(name.rlike(r"\.html$"), is_html).otherwise(False)


def best_version(versions: DataFrame, preference=PREFERENCE, key: str = "doc_id") -> DataFrame:
    """key, name, text: the first valid version of each document; a partially aggregated minimum."""
    rank = F.array_position(F.array(*(F.lit(n) for n in preference)), F.col("name"))
    rows = versions.where((rank > 0) & valid_version(F.col("name"), F.col("text")))
    best = F.min_by(F.struct("name", "text"), rank).alias("b")
    return rows.groupBy(key).agg(best).select(key, "b.name", "b.text")
