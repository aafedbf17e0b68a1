"""Inputs derived from the driver's tables, and the same derivations as DuckDB SQL.

The tables hold no Cyrillic; letters are mapped so that the rules have something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.operators.rules import rule_table

PLAIN, OLD = "abvgdeziklmnoprstufh", "абвгдѣзіклмнопрстуфх"
LEFT = ("стол ", "стол", "а ", "а")
RIGHT = ("конец", " конец", " б", "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """The input files have few row groups; dealing rows out lets every core work on Python and regex stages."""
    return df.repartition(key)


def old_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text in old letters."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", F.translate("text", PLAIN, OLD).alias("text")))


def old_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, block_id, text: the lines of old texts."""
    return old_texts(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("block_id", "text"))


def triggered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old texts with, at the end, a text on which one of the rules fires."""
    triggers = F.array(*(F.lit(r.sql_trigger()) for r in rule_table()))
    n = len(rule_table())
    turn = (F.floor(F.col("doc_id") / n) % 4).cast("int")
    pick = lambda values: F.get(F.array(*map(F.lit, values)), turn)
    text = F.concat("text", F.lit(" "), pick(LEFT), F.get(triggers, (F.col("doc_id") % n).cast("int")), pick(RIGHT))
    return old_texts(spark, sf_dir).select("doc_id", text.alias("text"))


def broken_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, block_id, role, text: lines of which every third has lost its end, and short upper-case ones are headings."""
    rows = old_lines(spark, sf_dir)
    text = F.when(F.col("block_id") % 3 == 1, F.regexp_replace("text", "[.!?,]+$", F.lit("-"))).when(F.col("block_id") % 3 == 2, F.regexp_replace("text", "[.!?]+$", "")).otherwise(F.col("text"))
    role = F.when(F.col("block_id") % 7 == 0, "heading").otherwise("paragraph")
    return rows.select("doc_id", "block_id", role.alias("role"), text.alias("text"))


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TEXTS_SQL = f"texts AS (SELECT doc_id, translate(text, '{PLAIN}', '{OLD}') AS text FROM documents)"
LINES_SQL = f"""{TEXTS_SQL}, parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM texts),
lines AS (SELECT doc_id, unnest(range(1, len(p) + 1)) - 1 AS block_id, unnest(p) AS text FROM parts)"""
BROKEN_SQL = f"""{LINES_SQL}, broken AS (SELECT doc_id, block_id, CASE WHEN block_id % 7 = 0 THEN 'heading' ELSE 'paragraph' END AS role,
  CASE block_id % 3 WHEN 1 THEN regexp_replace(text, '[.!?,]+$', '-') WHEN 2 THEN regexp_replace(text, '[.!?]+$', '') ELSE text END AS text FROM lines)"""


def triggered_sql() -> str:
    rules = rule_table()
    listed = ", ".join(quote(r.sql_trigger()) for r in rules)
    pick = lambda values: f"[{', '.join(map(quote, values))}][1 + (doc_id // {len(rules)}) % 4]"
    return f"{TEXTS_SQL}, triggered AS (SELECT doc_id, text || ' ' || {pick(LEFT)} || [{listed}][1 + doc_id % {len(rules)}] || {pick(RIGHT)} AS text FROM texts)"
