"""Chapters: blocks packed between headings and under a size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwright.functions import text as T
from inkwright.functions.folds import chapter_numbers

DEFAULT_TITLE = "Глава "


def split_chapters(blocks: DataFrame, max_kb: int = 50, key: str = "doc_id") -> DataFrame:
    """key, chapter_id, title, block_id, role, text: every block with its chapter.

    Sizes are UTF-8 bytes of stripped texts. The greedy fold restarts at each heading, so its arrays run from one
    heading to the next and hold sizes only, not texts; texts meet them again in a join on the block.
    """
    own = Window.partitionBy(key).orderBy("block_id")
    rows = blocks.select(key, "block_id", "role", "text", F.octet_length(T.strip(F.coalesce("text", F.lit("")))).alias("size"))
    heading = F.coalesce(F.col("role") == "heading", F.lit(False))
    runs = rows.withColumn("run", F.sum(heading.cast("int")).over(own))
    ordered = F.array_sort(F.collect_list(F.struct("block_id", heading.alias("heading"), "size")))
    folded = runs.groupBy(key, "run").agg(ordered.alias("b"))
    numbers = chapter_numbers(F.transform("b", lambda x: F.struct(x["heading"].alias("heading"), x["size"].alias("size"))), max_kb * 1024)
    per_run = folded.select(key, "run", F.arrays_zip(F.transform("b", lambda x: x["block_id"]).alias("block_id"), numbers.alias("part")).alias("z"))
    before = F.coalesce(F.sum("parts").over(Window.partitionBy(key).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = per_run.withColumn("parts", F.array_max(F.transform("z", lambda x: x["part"])) + 1).withColumn("base", before)
    placed = counted.select(key, "base", F.explode("z").alias("x")).select(key, F.col("x.block_id").alias("block_id"), (F.col("base") + F.col("x.part")).cast("int").alias("chapter_id"))
    chaptered = rows.join(placed, [key, "block_id"])
    within = Window.partitionBy(key, "chapter_id").orderBy("block_id")
    opener = F.first(F.when(F.col("role") == "heading", F.nullif(T.strip("text"), F.lit("")))).over(within)
    title = F.coalesce(opener, F.concat(F.lit(DEFAULT_TITLE), (F.col("chapter_id") + 1).cast("string")))
    return chaptered.select(key, "chapter_id", title.alias("title"), "block_id", "role", "text")
