"""Sentence and context diagnostics over a lexicon (word, pos, normal)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from inkwright.functions import text as T
from inkwright.operators.engines import loaded

SPANS = "array<struct<sentence:string,tokens:array<string>,start_char:int,end_char:int>>"

# Pronouns looked at by the checker alone, and by the whole pipeline.
PRONOUNS = ("он", "она", "они", "мы", "вы", "ты", "оно", "я")
PIPELINE_PRONOUNS = PRONOUNS[:-1]
JOINED_KINDS = ("NOUN", "ADJF", "ADJS", "PRTF", "PRTS", "VERB")
NO_WARNINGS = "Ошибок не найдено."


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])(?U)\s+", -1)


def words(sentence: Column) -> Column:
    return F.regexp_extract_all(sentence, F.lit(r"(?U)\b[\w']+\b"), 0)


def sentence_rows(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, sentence_id, sentence, tokens."""
    rows = texts.select(key, F.posexplode(sentences(F.coalesce("text", F.lit("")))).alias("sentence_id", "sentence"))
    return rows.withColumn("tokens", words(F.col("sentence")))


def bigrams(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, sentence_id, idx, w1, w2, snippet, sentence: adjacent words within a sentence, with up to one word before and one after."""
    pairs = F.transform(F.sequence(F.lit(0), F.size("tokens") - 2), lambda i: F.struct(F.get("tokens", i).alias("w1"), F.get("tokens", i + 1).alias("w2"), F.array_join(F.slice("tokens", F.greatest(i, F.lit(1)), F.when(i == 0, 3).otherwise(4)), " ").alias("snippet")))
    some = rows.where(F.size("tokens") > 1)
    out = some.select(key, "sentence_id", F.posexplode(pairs).alias("idx", "p"), "sentence")
    return out.select(key, "sentence_id", "idx", "p.w1", "p.w2", "p.snippet", T.strip("sentence").alias("sentence"))


def _with(pairs: DataFrame, lexicon: DataFrame, word: str, flag: str, where: Column) -> DataFrame:
    known = lexicon.where(where).select(F.col("word").alias("_w")).distinct().withColumn(flag, F.lit(True))
    return pairs.join(known, F.lower(word) == F.col("_w"), "left").drop("_w").withColumn(flag, F.coalesce(flag, F.lit(False)))


def pronoun_warnings(texts: DataFrame, lexicon: DataFrame, pronouns=PRONOUNS, key: str = "doc_id") -> DataFrame:
    """Pairs of a pronoun and a word that the lexicon does not know as a verb."""
    pairs = bigrams(sentence_rows(texts, key), key)
    named = _with(pairs, lexicon, "w1", "by_form", (F.col("pos") == "NPRO") & F.col("normal").isin(*pronouns))
    named = named.where(F.col("by_form") | F.lower("w1").isin(*pronouns))
    bad = _with(named, lexicon, "w2", "verb", F.col("pos").isin("VERB", "INFN")).where(~F.col("verb"))
    message = F.format_string("Пара %s + %s в предложении «%s» (%s) выглядит неправильно: %s не распознан как глагол.", "w1", "w2", "sentence", "snippet", "w2")
    return bad.select(key, "sentence_id", "idx", F.lit("pronoun").alias("kind"), "w1", "w2", "snippet", F.lit(None).cast("string").alias("norm"), message.alias("message"))


def split_word_warnings(texts: DataFrame, lexicon: DataFrame, key: str = "doc_id") -> DataFrame:
    """Pairs that the lexicon knows as one word whose normal form neither part has.

    Of several parses of a word its first one counts, by the lexicon's column `ord`; without it the least normal form.
    """
    pairs = bigrams(sentence_rows(texts, key), key).where(F.length("w1") + F.length("w2") >= 5)
    joined = F.lower(F.regexp_replace(F.concat("w1", "w2"), "[^А-Яа-яёЁ]", ""))
    first = F.min_by("normal", F.struct("ord", "normal")) if "ord" in lexicon.columns else F.min("normal")
    whole = lexicon.where(F.col("pos").isin(*JOINED_KINDS)).groupBy(F.col("word").alias("joined")).agg(first.alias("norm"))
    forms = lexicon.select(F.col("word").alias("part"), F.col("normal").alias("norm")).distinct()
    found = pairs.withColumn("joined", joined).where("joined <> ''").join(whole, "joined")
    for word in ("w1", "w2"):
        found = found.withColumn("part", F.lower(word)).join(forms, ["part", "norm"], "left_anti").drop("part")
    message = F.format_string("Похоже, что «%s %s» в «%s» должно быть «%s» (норма: %s). Рассмотрите склейку.", "w1", "w2", "snippet", "joined", "norm")
    return found.select(key, "sentence_id", "idx", F.lit("split").alias("kind"), "w1", "w2", "snippet", "norm", message.alias("message"))


def warnings(texts: DataFrame, lexicon: DataFrame, pronouns=PRONOUNS, key: str = "doc_id") -> DataFrame:
    return pronoun_warnings(texts, lexicon, pronouns, key).unionByName(split_word_warnings(texts, lexicon, key))


def report(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, report: the messages in order, or that there are none."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("sentence_id", "kind", "idx", "message"))), lambda x: x["message"])
    return docs.select(key).distinct().join(found.groupBy(key).agg(F.array_join(lines, "\n").alias("report")), key, "left").select(key, F.coalesce("report", F.lit(NO_WARNINGS)).alias("report"))


def rejoin_sentences(blocks: DataFrame, split=sentences) -> DataFrame:
    """Paragraph blocks with their sentences joined by one space; headings and blank blocks stay."""
    joined = F.array_join(F.filter(F.transform(split(F.col("text")), T.strip), lambda s: s != ""), " ")
    keep = (F.col("role") == "heading") | (T.strip(F.coalesce("text", F.lit(""))) == "")
    return blocks.withColumn("text", F.when(keep, F.col("text")).otherwise(joined))


class SentenceEngine(Protocol):
    """A model of sentences: (first character, character after the last, tokens) of each sentence in order."""

    def split(self, text: str) -> Iterable[tuple[int, int, list[str]]]: ...


def span_rows_with(texts: DataFrame, load: Callable[[], SentenceEngine], key: str = "doc_id") -> DataFrame:
    """span_rows() by an engine that each Python worker loads once; a text on which it fails is one sentence of no tokens."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = loaded(load)
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                try:
                    found.append([{"sentence": text[i:j], "tokens": list(tokens), "start_char": i, "end_char": j} for i, j, tokens in engine.split(text)])
                except ValueError:
                    found.append([{"sentence": text, "tokens": [], "start_char": 0, "end_char": len(text)}])
            kind = pa.list_(pa.struct([("sentence", pa.string()), ("tokens", pa.list_(pa.string())), ("start_char", pa.int32()), ("end_char", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, kind)], [key, "found"])

    made = texts.select(key, "text").mapInArrow(scan, StructType([texts.schema[key], StructField("found", DataType.fromDDL(SPANS))]))
    return made.select(key, F.posexplode("found").alias("sentence_id", "x")).select(key, "sentence_id", "x.*")


def rejoin_with(blocks: DataFrame, load: Callable[[], SentenceEngine]) -> DataFrame:
    """rejoin_sentences() by an engine that each Python worker loads once; a block on which it fails stays as it is."""

    @F.pandas_udf(StringType())
    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        engine = loaded(load)
        for texts in batches:
            out = []
            for text in texts:
                try:
                    parts = [text[i:j].strip() for i, j, _ in engine.split(text or "")]
                    out.append(" ".join(p for p in parts if p) or text)
                except ValueError:
                    out.append(text)
            yield pd.Series(out, dtype=object)

    keep = (F.col("role") == "heading") | (T.strip(F.coalesce("text", F.lit(""))) == "")
    return blocks.withColumn("text", F.when(keep, F.col("text")).otherwise(joined("text")))


def span_rows(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, sentence_id, sentence, tokens, start_char, end_char: token_spans in rows, with a running sum in place of a fold."""
    text = F.coalesce("text", F.lit(""))
    gaps = F.concat(F.transform(F.regexp_extract_all(text, F.lit(r"(?<=[.!?])(?U)\s+"), 0), F.length), F.array(F.lit(0)))
    rows = texts.select(key, F.posexplode(F.arrays_zip(sentences(text).alias("sentence"), gaps.alias("gap"))).alias("sentence_id", "x")).select(key, "sentence_id", "x.sentence", "x.gap")
    own = Window.partitionBy(key).orderBy("sentence_id").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("sentence") + F.col("gap")).over(own) - F.col("gap")
    placed = rows.withColumn("end_char", end.cast("int"))
    return placed.select(key, "sentence_id", "sentence", words(F.col("sentence")).alias("tokens"), (F.col("end_char") - F.length("sentence")).alias("start_char"), "end_char")


def token_spans(text: Column, split=sentences) -> Column:
    """array<struct<sentence, tokens, start_char, end_char>> with the built-in splitter."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<sentence:string,tokens:array<string>,start_char:int,end_char:int>>").alias("out"))

    gaps = F.regexp_extract_all(text, F.lit(r"(?<=[.!?])(?U)\s+"), 0)
    parts = split(text)
    sizes = F.zip_with(parts, F.concat(gaps, F.array(F.lit(""))), lambda s, g: F.struct(s.alias("s"), F.length(s).alias("n"), F.length(g).alias("g")))

    def place(acc: Column, x: Column) -> Column:
        end = acc["at"] + x["n"]
        entry = F.struct(x["s"].alias("sentence"), words(x["s"]).alias("tokens"), acc["at"].alias("start_char"), end.alias("end_char"))
        return F.struct((end + x["g"]).alias("at"), F.concat(acc["out"], F.array(entry)).alias("out"))

    return F.aggregate(sizes, state, place, lambda acc: acc["out"])
