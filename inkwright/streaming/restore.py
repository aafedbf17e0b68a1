"""Structured Streaming: documents restored as they arrive.

A document arrives as one record, so its folds need no state across records; the stateless part
of the pipeline runs on streams unchanged. Counts over event time use a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.functions import text as T
from inkwright.operators.rules import apply_rules


def restore_stream(texts: DataFrame, mode: str = "compat") -> DataFrame:
    """A stream of texts with rules applied, line breaks and punctuation normalised, and the replacements counted."""
    done = texts.withColumn("r", apply_rules(F.col("text"), mode=mode))
    return done.withColumn("text", T.normalize_punct(T.normalize_linebreaks(F.col("r.text")))).withColumn("n", F.col("r.n")).drop("r")


def replacements_by_window(restored: DataFrame, time: str = "ts", width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """start, n: replacements per window of event time, late rows up to the watermark."""
    return restored.withWatermark(time, late).groupBy(F.window(time, width)).agg(F.sum("n").alias("n")).select(F.col("window.start").alias("start"), "n")
