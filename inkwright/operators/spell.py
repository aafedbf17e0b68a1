"""Spell checking: chunks, checkers, matches and patches."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType
from pyspark.storagelevel import StorageLevel

from inkwright.functions import text as T
from inkwright.functions.folds import chunk_paragraphs, patched

MATCH = "struct<offset:int,length:int,replacements:array<struct<value:string>>,rule:struct<id:string,description:string>>"
MATCHES = f"array<{MATCH}>"
# Parts of the identifiers of rules whose matches are safe to apply.
SAFE = ("MORFOLOGIK", "SPACE", "DOUBLE_PUNCTUATION")
CYRILLIC_WORD = r"(?U)\b[А-Яа-яёЁ]+\b"


class Checker(Protocol):
    """Finds matches in one text; `name` labels its statistics."""

    name: str

    def check(self, text: str) -> list[dict]: ...


def chunks(texts: DataFrame, limit: int = 6000, key: str = "doc_id") -> DataFrame:
    """key, chunk_id, text."""
    return texts.select(key, F.posexplode(chunk_paragraphs(F.col("text"), limit)).alias("chunk_id", "text"))


def safe_matches(matches: Column) -> Column:
    """Only matches of safe rules."""
    return F.filter(matches, lambda m: F.upper(F.coalesce(m["rule"]["id"], F.lit(""))).rlike("|".join(SAFE)))


def dictionary_words(texts: DataFrame) -> DataFrame:
    """word, n: the distinct lower-case Cyrillic words of all texts, so that each is looked up once."""
    return texts.select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(CYRILLIC_WORD), 0)).alias("w")).groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n"))


def _deletions(word: Column, distance: int) -> Column:
    """Hashes of a word and of what is left of it after up to `distance` deletions."""
    found = F.array(word)
    for _ in range(distance):
        shorter = F.transform(found, lambda w: F.when(F.length(w) > 0, F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.left(w, i - 1), F.substr(w, i + 1)))).otherwise(F.array().cast("array<string>")))
        found = F.array_distinct(F.concat(found, F.flatten(shorter)))
    return F.transform(found, lambda w: F.xxhash64(w))


def corrections(words: DataFrame, dictionary: DataFrame, distance: int = 2, prefix: int = 2) -> DataFrame:
    """word, fixed: the nearest dictionary term of each unknown word within an edit distance.

    dictionary: term, freq. Candidates share the deletion-free prefix of `prefix` characters and differ in length by at most
    the distance, an equi-join on (prefix, length); ties go to the more frequent term, then to the first. With prefix 0
    every term within the distance is a candidate: two words that near have a common rest after at most that many deletions in
    each, and the join is on hashes of such rests.
    Words that the dictionary has, or that nothing is near, are left out.
    """
    unknown = words.join(dictionary.select(F.col("term").alias("word")), "word", "left_anti")
    if prefix:
        spread = F.explode(F.sequence(F.length("word") - distance, F.length("word") + distance))
        left = unknown.select("word", F.left("word", F.lit(prefix)).alias("p"), spread.alias("len"))
        right = dictionary.select("term", "freq", F.left("term", F.lit(prefix)).alias("p"), F.length("term").alias("len"))
        pairs = left.join(right, ["p", "len"])
    else:
        left = unknown.select("word", F.explode(_deletions(F.col("word"), distance)).alias("rest"))
        right = dictionary.select("term", "freq", F.explode(_deletions(F.col("term"), distance)).alias("rest"))
        pairs = left.join(right, "rest").select("word", "term", "freq").distinct()
    near = pairs.withColumn("d", F.levenshtein("word", "term", distance)).where("d >= 0")
    return near.groupBy("word").agg(F.min_by("term", F.struct("d", -F.col("freq"), "term")).alias("fixed"))


def local_matches(texts: DataFrame, fixes: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, text, matches: a match for each word that has a correction, spelled with the word's first capital."""
    found = F.regexp_extract_all("text", F.lit(CYRILLIC_WORD), 0)
    between = F.split("text", CYRILLIC_WORD, -1)
    words = F.posexplode(F.arrays_zip(F.transform(F.slice(between, 1, F.size(found)), lambda g: F.length(g)).alias("gap"), found.alias("w")))
    rows = texts.select(key, words.alias("pos", "x")).select(key, "pos", "x.gap", "x.w")
    # a running sum and not a fold, whose array would be copied at every word
    own = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(key, (F.sum(F.col("gap") + F.length("w")).over(own) - F.length("w")).cast("int").alias("offset"), "w", F.lower("w").alias("word"))
    hits = rows.join(fixes, "word").where("fixed <> word")
    value = F.when(F.left("w", F.lit(1)) != F.lower(F.left("w", F.lit(1))), T.capitalize(F.col("fixed"))).otherwise(F.col("fixed"))
    match = F.struct("offset", F.length("w").alias("length"), F.array(F.struct(value.alias("value"))).alias("replacements"), F.struct(F.lit("LOCAL").alias("id"), F.lit("dictionary").alias("description")).alias("rule"))
    gathered = hits.groupBy(key).agg(F.array_sort(F.collect_list(match)).alias("matches"))
    return texts.select(key, "text").join(gathered, key, "left").withColumn("matches", F.coalesce("matches", F.array().cast(MATCHES)))


def correct(texts: DataFrame, dictionary: DataFrame, distance: int = 2, key: str = "doc_id", prefix: int = 2) -> DataFrame:
    """key, text, matches, applied: texts with unknown words corrected; the dictionary is asked once a distinct word."""
    rows = local_matches(texts, corrections(dictionary_words(texts), dictionary, distance, prefix), key)
    done = rows.select(key, F.size("matches").alias("matches"), patched(F.col("text"), F.col("matches")).alias("done"))
    return done.select(key, "done.text", "matches", F.col("done.n").alias("applied"))


def check_chunks(chunked: DataFrame, checker: Checker, key: str = "doc_id", pause: float = 0.0) -> DataFrame:
    """The chunks with matches, a checker's; a chunk on which it fails has none."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                try:
                    found.append([{"offset": m.get("offset", 0), "length": m.get("length", 0), "replacements": [{"value": r.get("value")} for r in m.get("replacements") or []], "rule": {"id": (m.get("rule") or {}).get("id"), "description": (m.get("rule") or {}).get("description")}} for m in checker.check(text or "")])
                except Exception:  # noqa: BLE001  a failing service leaves the text as it is
                    found.append([])
                if pause:
                    time.sleep(pause)
            value = pa.struct([("value", pa.string())])
            rule = pa.struct([("id", pa.string()), ("description", pa.string())])
            match = pa.struct([("offset", pa.int32()), ("length", pa.int32()), ("replacements", pa.list_(value)), ("rule", rule)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(match))], [*batch.schema.names, "matches"])

    return chunked.mapInArrow(scan, StructType([*chunked.schema.fields, StructField("matches", DataType.fromDDL(MATCHES))]))


def run_chunks(texts: DataFrame, checkers: Sequence[Checker], limit: int = 6000, key: str = "doc_id", safe_only: bool = True, pause: float = 0.0) -> DataFrame:
    """key, chunk_id, text, checks: corrected chunks, with (checker, matches, applied) of each checker in order.

    Every checker sees what the one before made of a chunk, once.
    """
    kind = "array<struct<checker:string,matches:int,applied:int>>"
    rows = chunks(texts, limit, key).withColumn("checks", F.array().cast(kind))
    for checker in checkers:
        found = check_chunks(rows, checker, key, pause)
        matches = safe_matches(F.col("matches")) if safe_only else F.col("matches")
        found = found.select(key, "chunk_id", "checks", F.size(matches).alias("matches"), patched(F.col("text"), matches).alias("done"))
        one = F.array(F.struct(F.lit(checker.name).alias("checker"), F.col("matches"), F.col("done.n").alias("applied")).cast("struct<checker:string,matches:int,applied:int>"))
        rows = found.select(key, "chunk_id", F.col("done.text").alias("text"), F.concat("checks", one).alias("checks"))
    return rows


def run(texts: DataFrame, checkers: Sequence[Checker], limit: int = 6000, key: str = "doc_id", safe_only: bool = True, pause: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Corrected texts, and statistics (checker, matches, applied).

    Chunks are kept on disk after their first use, so that a checker, which may be a service, is not asked again for the other result.
    """
    rows = run_chunks(texts, checkers, limit, key, safe_only, pause).persist(StorageLevel.DISK_ONLY)
    return whole_texts(rows, key), check_counts(rows)


def whole_texts(chunked: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, text: chunks put together again."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_id", "text"))), lambda x: x["text"]), "")
    return chunked.groupBy(key).agg(joined.alias("text"))


def check_counts(chunked: DataFrame) -> DataFrame:
    """checker, matches, applied: matches that were found count, applied or not, as do those that were applied."""
    rows = chunked.select(F.posexplode("checks").alias("k", "c"))
    return rows.groupBy("k", "c.checker").agg(F.sum("c.matches").alias("matches"), F.sum("c.applied").alias("applied")).orderBy("k").select("checker", "matches", "applied")


_MAKERS: dict = {}


def register_checker(kind: str, make) -> None:
    """Add a kind of checker to those that create_checker knows."""
    _MAKERS[kind] = make


def create_checker(kind: str = "auto", **options) -> Checker:
    """A registered checker; "auto" takes the first that can be made."""
    from inkwright.operators import adapters

    makers = adapters.MAKERS | _MAKERS
    if kind != "auto":
        if kind not in makers:
            raise ValueError(f"unknown checker {kind!r}")
        return makers[kind](**options)
    for make in makers.values():
        try:
            return make(**options)
        except (ImportError, TypeError, ValueError):
            continue
    raise ImportError("no spell checker is installed")
