"""Ordered folds over arrays: greedy packing, patching and sequential replacement.

Their state depends on what came before within one document, so they are aggregates over an
ordered array; documents are independent of each other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_paragraphs(text: Column, limit: int = 6000) -> Column:
    """array<string>: paragraphs (between blank lines) packed greedily into chunks of at most `limit` characters.

    Each paragraph brings two line ends with it; one longer than the limit is a chunk of its own.
    """
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def step(acc: Column, p: Column) -> Column:
        piece = F.concat(p, F.lit("\n\n"))
        full = (F.length(acc["cur"]) + F.length(piece) > limit) & (acc["cur"] != "")
        done = F.when(full, F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])
        return F.struct(done.alias("done"), F.when(full, piece).otherwise(F.concat(acc["cur"], piece)).alias("cur"))

    last = lambda acc: F.when(acc["cur"] != "", F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])
    return F.aggregate(F.split(F.coalesce(text, F.lit("")), "\n\n", -1), state, step, last)


def chunk_numbers(sizes: Column, limit: int) -> Column:
    """array<int>: the chunk of each size under the same packing, from sizes alone."""
    state = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("id"), F.lit(0).cast("long").alias("cur"))

    def step(acc: Column, n: Column) -> Column:
        n = n.cast("long")
        full = (acc["cur"] + n > limit) & (F.size(acc["ids"]) > 0)
        number = F.when(full, acc["id"] + 1).otherwise(acc["id"])
        return F.struct(F.concat(acc["ids"], F.array(number)).alias("ids"), number.alias("id"), F.when(full, n).otherwise(acc["cur"] + n).alias("cur"))

    return F.aggregate(sizes, state, step, lambda acc: acc["ids"])


def _patched(text: Column, matches: Column) -> Column:
    ordered = F.array_sort(F.transform(F.coalesce(matches, F.array().cast("array<struct<offset:int,length:int,replacements:array<struct<value:string>>,rule:struct<id:string,description:string>>>")), lambda m, i: F.struct(m["offset"].alias("offset"), i.alias("ord"), m["length"].alias("length"), F.get(m["replacements"], F.lit(0))["value"].alias("value"))))
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"), F.lit(0).alias("n"))

    def step(acc: Column, m: Column) -> Column:
        use = (m["offset"] >= acc["at"]) & m["value"].isNotNull()
        between = F.substr(text, acc["at"] + 1, m["offset"] - acc["at"])
        return F.when(use, F.struct(F.concat(acc["out"], between, m["value"]).alias("out"), (m["offset"] + m["length"]).alias("at"), (acc["n"] + 1).alias("n"))).otherwise(acc)

    return F.aggregate(ordered, state, step)


def patched(text: Column, matches: Column) -> Column:
    """struct<text, n>: what apply_matches and applied_matches give, from one fold once its fields are taken from a column."""
    done = _patched(text, matches)
    whole = F.transform(F.array(done), lambda d: F.struct(F.concat(d["out"], F.substr(text, d["at"] + 1)).alias("text"), F.when(text.isNull(), 0).otherwise(d["n"]).alias("n")))
    return F.element_at(whole, 1)


def apply_matches(text: Column, matches: Column) -> Column:
    """The text with each match's first replacement put in, in order of offset; overlapping matches and ones without replacement are skipped.

    Places beyond the end of the text are clipped to it. A null text stays null.
    """
    done = _patched(text, matches)
    return F.concat(done["out"], F.substr(text, done["at"] + 1))


def applied_matches(text: Column, matches: Column) -> Column:
    """How many matches apply_matches puts in; none into a null text."""
    return F.when(text.isNull(), 0).otherwise(_patched(text, matches)["n"])


def replace_in_order(text: Column, pairs: Column) -> Column:
    """struct<text, applied>: literal replacements one after the other on the running text.

    pairs: array<struct<type, old, new>>; applied lists those that occurred, with their counts.
    """
    state = F.struct(F.coalesce(text, F.lit("")).alias("text"), F.array().cast("array<struct<type:string,old:string,new:string,count:bigint>>").alias("applied"))

    def step(acc: Column, p: Column) -> Column:
        usable = (F.coalesce(p["old"], F.lit("")) != "") & (p["old"] != p["new"]) & acc["text"].contains(p["old"])
        n = ((F.length(acc["text"]) - F.length(F.replace(acc["text"], p["old"], F.lit("")))) / F.length(p["old"])).cast("long")
        entry = F.struct(p["type"].alias("type"), p["old"].alias("old"), p["new"].alias("new"), n.alias("count"))
        return F.when(usable, F.struct(F.replace(acc["text"], p["old"], p["new"]).alias("text"), F.concat(acc["applied"], F.array(entry)).alias("applied"))).otherwise(acc)

    return F.aggregate(pairs, state, step)


def chapter_numbers(blocks: Column, limit_bytes: int) -> Column:
    """array<int>: the chapter of each block, given array<struct<heading boolean, size>> in order.

    A heading opens a chapter; otherwise a block that would make its chapter larger than the limit opens one.
    """
    state = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("id"), F.lit(0).cast("long").alias("size"))

    def step(acc: Column, b: Column) -> Column:
        some = F.size(acc["ids"]) > 0
        n = b["size"].cast("long")
        fresh = some & (b["heading"] | (acc["size"] + n > limit_bytes))
        number = F.when(fresh, acc["id"] + 1).otherwise(acc["id"])
        return F.struct(F.concat(acc["ids"], F.array(number)).alias("ids"), number.alias("id"), F.when(fresh | b["heading"], n).otherwise(acc["size"] + n).alias("size"))

    return F.aggregate(blocks, state, step, lambda acc: acc["ids"])
