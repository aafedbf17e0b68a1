"""Flags on old letters and on Latin letters in Cyrillic words."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from inkwright.functions.text import LATIN, LOOKALIKE, MIXED_TOKEN, count_of

# Old letters, their modern forms and the names of their flags, in the order of the passes.
OLD_LETTERS = [("ѣ", "е", "yat"), ("Ѣ", "Е", "yat"), ("і", "и", "i"), ("І", "И", "i"), ("ѳ", "ф", "fita"), ("Ѳ", "Ф", "fita"), ("ѵ", "и", "izhitsa"), ("Ѵ", "И", "izhitsa")]
_FLAG = StructType([StructField("type", StringType()), StructField("from", StringType()), StructField("to", StringType()), StructField("pos", IntegerType())])
FLAGGED = StructType([StructField("text", StringType()), StructField("flags", ArrayType(_FLAG))])


def mark(old: str, new: str) -> str:
    return f'<mark class="flag" data-from="{old}" data-to="{new}" title="{old}→{new}">{new}</mark>'


_GROWTH = len(mark("x", "y")) - 1
_TOKEN = re.compile(MIXED_TOKEN)
_MARKED = {a: mark(a, b) for a, b in zip(LATIN, LOOKALIKE)}
_FORM = dict(zip(LATIN, LOOKALIKE))


def flag_letters(text: str) -> tuple[str, list[dict]]:
    """The marked text and its flags.

    A pass over one letter finds it in text that earlier passes have marked: its place is that in the text
    given plus what the marks before it have added, and the marks' own text holds the letter again.
    """
    flags: list[dict] = []
    for old, new, name in OLD_LETTERS:
        pieces = text.split(old)
        at = len(pieces[0])
        for piece in pieces[1:]:
            flags.append({"type": name, "from": old, "to": new, "pos": at})
            at += 1 + len(piece)
        text = mark(old, new).join(pieces)

    def in_token(match: re.Match) -> str:
        token = match[0]
        if token.isascii() or not any(c.isascii() and c.isalpha() for c in token):
            return token
        flags.extend({"type": "latin_to_cyr", "from": c, "to": _FORM[c], "pos": None} for c in token if c in _FORM)
        return "".join(_MARKED.get(c, c) for c in token)

    return _TOKEN.sub(in_token, text), flags


@F.pandas_udf(FLAGGED)
def flagged(texts: pd.Series) -> pd.DataFrame:
    """Marked text and flags, in Arrow batches: positions depend on the marks of earlier passes."""
    return pd.DataFrame([flag_letters(t or "") for t in texts], columns=["text", "flags"])


def flag_blocks(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, block, role, text (marked), flags: every block, also without flags."""
    done = blocks.withColumn("f", flagged("text"))
    return done.select(key, F.col("merged_id").alias("block"), "role", F.col("f.text").alias("text"), F.col("f.flags").alias("flags"))


def flag_counts(text: Column) -> dict[str, Column]:
    """How many flags of each type flag_letters gives a text, natively.

    Marks stand between the parts of a word, so words end at old letters.
    """
    text = F.coalesce(text, F.lit(""))
    found = {}
    for name in dict.fromkeys(x[2] for x in OLD_LETTERS):
        found[name] = sum((count_of(text, F.lit(old)) for old, _, kind in OLD_LETTERS if kind == name), F.lit(0).cast("long"))
    parts = F.regexp_extract_all(F.translate(text, "".join(x[0] for x in OLD_LETTERS), "|" * len(OLD_LETTERS)), F.lit(MIXED_TOKEN), 0)
    mixed = F.filter(parts, lambda t: t.rlike("[A-Za-z]") & t.rlike("[^\\x00-\\x7F]"))
    latin = F.array_join(mixed, "")
    found["latin_to_cyr"] = (F.length(latin) - F.length(F.translate(latin, LATIN, ""))).cast("long")
    return found


def count_flags(blocks: DataFrame) -> DataFrame:
    """type, n: flags by type, of all blocks; types without flags are left out."""
    own = flag_counts(F.col("text"))
    sums = blocks.agg(*(F.sum(c).alias(name) for name, c in own.items()))
    rows = F.explode(F.array(*(F.struct(F.lit(name).alias("type"), F.col(name).alias("n")) for name in own)))
    return sums.select(rows.alias("r")).select("r.type", "r.n").where("n > 0")


def flag_summary(flags: DataFrame) -> DataFrame:
    """type, n: flags by type."""
    return flags.select(F.explode("flags").alias("f")).groupBy(F.col("f.type").alias("type")).agg(F.count("*").alias("n"))
