"""Named entities of two versions of a text: difference and synchronisation."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from inkwright.functions.folds import replace_in_order
from inkwright.operators.engines import loaded

DEFAULT_TYPES = ("PER", "LOC")
MENTIONS = "array<struct<text:string,normal:string,type:string>>"


def parse_types(types: str) -> list[str]:
    return [x.strip().upper() for x in types.split(",") if x.strip()]


def capitalised_mentions(text: Column) -> Column:
    """A stand-in for a model: capitalised words of at least four letters inside sentences, their lower case as normal form, type PER."""
    found = F.regexp_extract_all(text, F.lit(r"(?U)(?<=[\p{L},] )\p{Lu}\p{Ll}{3,}"), 0)
    return F.transform(found, lambda w: F.struct(w.alias("text"), F.lower(w).alias("normal"), F.lit("PER").alias("type")))


def extract(texts: DataFrame, side: str, types=DEFAULT_TYPES, find: Callable[[Column], Column] = capitalised_mentions, key: str = "doc_id") -> DataFrame:
    """key, side, ord, text, normal, type: mentions of the allowed types in order; an empty normal form is the text."""
    rows = texts.select(key, F.posexplode(find(F.coalesce("text", F.lit("")))).alias("ord", "m"))
    rows = rows.select(key, F.lit(side).alias("side"), "ord", F.col("m.text").alias("text"), F.coalesce(F.nullif(F.col("m.normal"), F.lit("")), F.col("m.text")).alias("normal"), F.col("m.type").alias("type"))
    return rows.where(F.col("type").isin(*types))


class EntityEngine(Protocol):
    """A model of entities: (text, normal form or "", type) of each mention in order."""

    def mentions(self, text: str) -> Iterable[tuple[str, str, str]]: ...


def extract_with(texts: DataFrame, side: str, load: Callable[[], EntityEngine], types=DEFAULT_TYPES, key: str = "doc_id") -> DataFrame:
    """extract() by an engine that each Python worker loads once; a text on which it fails has no mentions."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = loaded(load)
        mention = pa.struct([("text", pa.string()), ("normal", pa.string()), ("type", pa.string())])
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                try:
                    found.append([{"text": t, "normal": n, "type": k} for t, n, k in engine.mentions(text or "")])
                except ValueError:
                    found.append([])
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, pa.list_(mention))], [key, "found"])

    rows = texts.select(key, "text").mapInArrow(scan, StructType([texts.schema[key], StructField("found", DataType.fromDDL(MENTIONS))]))
    return extract(rows.withColumn("text", F.lit("")), side, types, lambda _: F.col("found"), key)


def dedupe(mentions: DataFrame, key: str = "doc_id") -> DataFrame:
    """The first mention of each (normal, type); a minimum that is aggregated before the shuffle."""
    first = F.min_by(F.struct("ord", "text"), "ord").alias("m")
    return mentions.groupBy(key, "side", "normal", "type").agg(first).select(key, "side", F.col("m.ord").alias("ord"), F.col("m.text").alias("text"), "normal", "type")


def keyed(mentions: DataFrame, key: str = "doc_id") -> DataFrame:
    """For each (normal, type) the text of the last mention, in the place of the first."""
    agg = mentions.groupBy(key, "normal", "type").agg(F.max_by("text", "ord").alias("text"), F.min("ord").alias("ord"))
    return agg.select(key, "ord", "text", "normal", "type")


def difference(source: DataFrame, clean: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, missing_in, type, normal, text: what only one side has."""
    on = [key, "normal", "type"]
    a, b = keyed(source, key), keyed(clean, key)
    gone = a.join(b, on, "left_anti").select(key, F.lit("clean").alias("missing_in"), "type", "normal", "text")
    new = b.join(a, on, "left_anti").select(key, F.lit("source").alias("missing_in"), "type", "normal", "text")
    return gone.unionByName(new)


def replacement_pairs(source: DataFrame, clean: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, ord, type, old, new: entities of both sides whose texts differ, in the clean text's order."""
    a = keyed(source, key).select(key, "normal", "type", F.col("text").alias("new"))
    b = keyed(clean, key).select(key, "normal", "type", "ord", F.col("text").alias("old"))
    return b.join(a, [key, "normal", "type"]).where("old <> new").select(key, "ord", "type", "old", "new")


def synchronise(texts: DataFrame, pairs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, text, applied: each text with its pairs replaced one after the other."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "type", "old", "new")))
    gathered = pairs.groupBy(key).agg(F.transform(ordered, lambda p: F.struct(p["type"].alias("type"), p["old"].alias("old"), p["new"].alias("new"))).alias("pairs"))
    joined = texts.select(key, "text").join(gathered, key, "left")
    done = joined.withColumn("d", replace_in_order(F.col("text"), F.coalesce("pairs", F.array().cast("array<struct<type:string,old:string,new:string>>"))))
    return done.select(key, F.col("d.text").alias("text"), F.col("d.applied").alias("applied"))


def _listing(df: DataFrame, key: str) -> DataFrame:
    line = F.concat(F.lit("- "), "type", F.lit(": "), "normal", F.lit(" ("), "text", F.lit(")"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("type", "normal", line.alias("line")))), lambda x: x["line"])
    return df.groupBy(key, "missing_in").agg(F.array_join(lines, "\n").alias("lines"))


# The sentences of the reports.
ONLY_SOURCE = "Из PDF (современное написание) оказались только в PDF:"
NONE_GONE = "Из PDF ничего не исчезло в final_clean.txt."
ONLY_CLEAN = "Из final_clean.txt появились новые сущности:"
NONE_NEW = "Из final_clean.txt ничего не добавлено по сравнению с PDF."
NOTHING_APPLIED = "Замены не применялись: текст уже совпадает с PDF."
APPLIED = "Применённые замены (читальный текст → PDF):"


def difference_report(docs: DataFrame, diff: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, report: both sections for every document."""
    lines = _listing(diff, key)
    part = lambda side, name: lines.where(F.col("missing_in") == side).select(key, F.col("lines").alias(name))
    rows = docs.select(key).distinct().join(part("clean", "gone"), key, "left").join(part("source", "new"), key, "left")
    gone = F.coalesce(F.concat(F.lit(ONLY_SOURCE + "\n"), "gone"), F.lit(NONE_GONE))
    new = F.coalesce(F.concat(F.lit(ONLY_CLEAN + "\n"), "new"), F.lit(NONE_NEW))
    return rows.select(key, F.concat(gone, F.lit("\n\n"), new).alias("report"))


def sync_report(synced: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, report: the replacements made."""
    line = lambda a: F.concat(F.lit("- "), a["type"], F.lit(": "), a["old"], F.lit(" → "), a["new"], F.lit(" (заменено "), a["count"].cast("string"), F.lit(" раз)"))
    text = F.when(F.size("applied") == 0, F.lit(NOTHING_APPLIED)).otherwise(F.concat(F.lit(APPLIED + "\n"), F.array_join(F.transform("applied", line), "\n")))
    return synced.select(key, text.alias("report"))
