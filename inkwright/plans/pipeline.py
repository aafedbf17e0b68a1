"""The restoration pipeline as one lazy plan of optional stages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.functions import text as T
from inkwright.operators import blocks as B
from inkwright.operators import chapters, context, entities, flags, render, rules, spell


@dataclass(frozen=True)
class Spec:
    """Which stages run, with the defaults of the command line tools."""

    rules: bool = True
    mode: str = "compat"
    rejoin: bool = False
    dictionary: DataFrame | None = None
    distance: int = 2
    checkers: tuple = ()
    chunk_size: int = 6000
    context_lexicon: DataFrame | None = None
    pronouns: tuple[str, ...] = context.PIPELINE_PRONOUNS
    source_mentions: DataFrame | None = None
    types: tuple[str, ...] = entities.DEFAULT_TYPES
    entity_engine: Callable[[], entities.EntityEngine] | None = None
    sentence_engine: Callable[[], context.SentenceEngine] | None = None
    clean: bool = False
    chapter_kb: int = 50
    title: str = ""
    author: str = ""
    rule_table: tuple[rules.Rule, ...] | None = None
    template: dict[str, bytes] | None = None
    cover: bytes | None = None


def modernized(blocks: DataFrame, use_rules: bool = True, mode: str = "compat", rejoin: bool = False, table=None, engine=None) -> DataFrame:
    """Merged blocks doc_id, merged_id, role, text, and n, the replacements made in each: one pass over the texts."""
    rewritten = rules.rewrite_blocks(blocks, table, mode) if use_rules else blocks.withColumn("n", F.lit(0).cast("long"))
    if rejoin:
        rewritten = context.rejoin_with(rewritten, engine) if engine else context.rejoin_sentences(rewritten)
    normal = rewritten.withColumn("text", T.normalize_punct(T.normalize_linebreaks(F.col("text"))))
    return B.merge_paragraphs(normal, total="n")


def modernize(blocks: DataFrame, use_rules: bool = True, mode: str = "compat", rejoin: bool = False, table=None, engine=None) -> tuple[DataFrame, DataFrame]:
    """Merged blocks (doc_id, merged_id, role, text), and the replacements of each document."""
    merged = modernized(blocks, use_rules, mode, rejoin, table, engine)
    return merged.drop("n"), rules.rules_applied(merged)


def run(blocks: DataFrame, spec: Spec) -> dict[str, DataFrame]:
    """All results by name; nothing runs before one of them is used.

    merged, rules_applied, flags, text, and, as the specification asks: corrected, stats, warnings,
    entity_diff, synced, chapters, epub. A text passes each correction that is switched on before the
    next stage reads it.
    """
    merged, counts = modernize(blocks, spec.rules, spec.mode, spec.rejoin, spec.rule_table, spec.sentence_engine)
    out = {"merged": merged, "rules_applied": counts, "flags": flags.flag_blocks(merged)}
    texts = render.plain_text(merged, "merged_id")
    if spec.dictionary is not None:
        out["corrected"] = spell.correct(texts, spec.dictionary, spec.distance, prefix=0)
        texts = out["corrected"].select("doc_id", "text")
    if spec.checkers:
        texts, out["stats"] = spell.run(texts, spec.checkers, spec.chunk_size)
    if spec.context_lexicon is not None:
        out["warnings"] = context.warnings(texts, spec.context_lexicon, spec.pronouns)
    if spec.source_mentions is not None:
        clean = entities.extract_with(texts, "clean", spec.entity_engine, spec.types) if spec.entity_engine else entities.extract(texts, "clean", spec.types)
        out["entity_diff"] = entities.difference(spec.source_mentions, clean)
        out["synced"] = entities.synchronise(texts, entities.replacement_pairs(spec.source_mentions, clean))
        texts = out["synced"].select("doc_id", "text")
    if spec.clean:
        texts = texts.withColumn("text", T.cleanup(F.col("text")))
    out["text"] = texts
    if spec.title:
        out["chapters"] = chapters.split_chapters(B.text_blocks(texts), spec.chapter_kb)
        from inkwright.operators import epub

        out["epub"] = epub.packages(render.chapter_xhtml(out["chapters"]), spec.title, spec.author, template=spec.template, cover=spec.cover)
    return out
