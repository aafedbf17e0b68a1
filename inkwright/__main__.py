"""Command line: python -m inkwright STAGE --in PATH --out PATH, each stage over all files of a folder.

`run` is the whole chain: each result becomes a folder of OUT, and the folders made are listed at the end. A result that fails ends the
run with status 1, but for those of entities, which are left out with a note.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from inkwright.functions import text as T
from inkwright.operators import adapters, blocks, chapters, context, entities, epub, layout, render, rules, spell
from inkwright.plans import pipeline
from inkwright.sources import readers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="inkwright", description=__doc__)
    stages = top.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str, **options) -> None:
        p = stages.add_parser(name, help=text)
        p.add_argument("--in", dest="source", required=True)
        p.add_argument("--out", required=True)
        for option, default in options.items():
            flag = f"--{option.replace('_', '-')}"
            p.add_argument(flag, action="store_true") if default is False else p.add_argument(flag, default=default, type=type(default) if default is not None else str)

    stage("extract", "page records to blocks", two_columns=False)
    stage("rules", "blocks through the spelling rules", mode="compat", rules=None)
    stage("modernize", "blocks to merged text", mode="compat", no_rules=False, rules=None)
    stage("spell", "texts through a dictionary (columns term, freq)", dictionary=None, distance=2)
    stage("context", "warnings by a lexicon (columns word, pos, normal)", lexicon=None, pronouns=",".join(context.PRONOUNS))
    stage("entities", "mentions of two folders of texts compared, and the clean ones synchronised", other=None, types=",".join(entities.DEFAULT_TYPES))
    stage("clean", "texts through post-cleaning")
    stage("epub", "texts to packages", title=None, author="", max_chapter_size=50, template=None, cover=None)
    whole = {"mode": "compat", "no_rules": False, "rules": None, "rejoin": False, "dictionary": None, "distance": 2, "language_tool": None, "speller": None, "chunk_size": 6000}
    whole |= {"lexicon": None, "pronouns": ",".join(context.PIPELINE_PRONOUNS), "other": None, "types": ",".join(entities.DEFAULT_TYPES), "entity_engine": None, "sentence_engine": None, "clean": False}
    stage("run", "blocks through the whole chain", **whole, title=None, author="", max_chapter_size=50, template=None, cover=None)
    return top


def _content(path: str | None) -> bytes | None:
    if not path:
        return None
    with open(path, "rb") as f:
        return f.read()


def _template(args: argparse.Namespace) -> dict[str, bytes] | None:
    content = _content(args.template)
    return epub.read_template(content) if content else None


def _maker(name: str | None):
    """The function that "module:function" names, which makes an engine in a worker."""
    if not name:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def specification(spark: SparkSession, args: argparse.Namespace) -> pipeline.Spec:
    """What the options of `run` ask for."""
    checkers = [adapters.LanguageToolChecker(args.language_tool)] if args.language_tool else []
    checkers += [adapters.WordServiceChecker(args.speller)] if args.speller else []
    kinds, names = entities.parse_types(args.types), _maker(args.entity_engine)
    version = _named(readers.whole_texts(spark, args.other)) if args.other else None
    other = None if version is None else entities.extract_with(version, "source", names, kinds) if names else entities.extract(version, "source", kinds)
    table = lambda path: spark.read.parquet(path) if path else None
    return pipeline.Spec(
        rules=not args.no_rules, mode=args.mode, rejoin=args.rejoin, dictionary=table(args.dictionary), distance=args.distance, checkers=tuple(checkers), chunk_size=args.chunk_size, context_lexicon=table(args.lexicon),
        pronouns=tuple(args.pronouns.split(",")), source_mentions=other, types=tuple(kinds), entity_engine=names, sentence_engine=_maker(args.sentence_engine), clean=args.clean, chapter_kb=args.max_chapter_size, title=args.title or "", author=args.author,
        rule_table=tuple(rules.read_rules(spark, args.rules)) if args.rules else None, template=_template(args), cover=_content(args.cover),
    )


def _named(texts):
    """Documents by their file names without ending, so that versions of one meet."""
    return texts.withColumn("doc_id", F.regexp_replace(F.element_at(F.split("doc_id", "/"), -1), r"\.[^.]*$", ""))


def run_all(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """Every result written; the folders made, in order."""
    made = []
    for name, result in pipeline.run(_named(readers.structured_json(spark, args.source)), specification(spark, args)).items():
        place = f"{args.out}/{name}"
        try:
            result.write.parquet(place)
        except Exception as error:  # noqa: BLE001  a stage's failure ends the run, whatever it is
            print(f"{name} failed: {error}", file=sys.stderr)
            if name not in ("entity_diff", "synced"):
                raise SystemExit(1) from error
            continue
        made.append(place)
    print("\n".join(made))
    return made


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.stage == "run":
        run_all(spark, args)
        return
    own = rules.read_rules(spark, args.rules) if getattr(args, "rules", None) else None
    if args.stage == "extract":
        out = layout.structured(readers.page_records(spark, args.source), args.two_columns)
    elif args.stage == "rules":
        out = rules.rewrite_blocks(readers.structured_json(spark, args.source), own, args.mode)
    elif args.stage == "modernize":
        out = pipeline.modernize(readers.structured_json(spark, args.source), not args.no_rules, args.mode, table=own)[0]
    else:
        texts = readers.whole_texts(spark, args.source)
        if args.stage == "spell":
            out = spell.correct(texts, spark.read.parquet(args.dictionary), args.distance)
        elif args.stage == "context":
            out = context.warnings(texts, spark.read.parquet(args.lexicon), tuple(args.pronouns.split(",")))
        elif args.stage == "entities":
            kinds = tuple(entities.parse_types(args.types))
            name = F.element_at(F.split("doc_id", "/"), -1)
            a, b = (entities.extract(t.withColumn("doc_id", name), side, kinds) for t, side in ((readers.whole_texts(spark, args.other), "source"), (texts, "clean")))
            out = entities.synchronise(texts.withColumn("doc_id", name), entities.replacement_pairs(a, b))
        elif args.stage == "clean":
            out = texts.withColumn("text", T.cleanup(F.col("text")))
        else:
            out = epub.packages(render.chapter_xhtml(chapters.split_chapters(blocks.text_blocks(texts), args.max_chapter_size)), args.title or "", args.author, template=_template(args), cover=_content(args.cover))
    out.write.parquet(args.out)


if __name__ == "__main__":
    run(SparkSession.builder.appName("inkwright").getOrCreate(), parser().parse_args())
