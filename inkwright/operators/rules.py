"""Ordered spelling-reform rules: the table, and how it is applied and counted."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- Fixed values: the rules' texts in their order. A dot that ends a pattern stands, in compatible mode, for any
# character but a line end, and is written as a dot.
HARD_SIGN_ENDS = ["", ".", ",", "-", ":", '"', "!", ";", "\n"]
LETTERS = [("ѣ", "е"), ("θ", "ф"), ("і", "и"), ("Ѣ", "Е"), ("І", "И"), ("Θ", "Ф")]
WORDS = [
    (" придти", " прийти"), (" Придти", " Прийти"), ("черезчур", "чересчур"), ("Черезчур", "Чересчур"), (" подле", " возле"), ("Подле", "Возле"), (" ужь", " уж"),
    (" Ужь", " Уж"), (" ея", " ее"), ("Ея", "Ее"), (" нея", " нее"), (" Нея", " Нее"), (" оне", " они"), ("Оне", "Они"),
]
PREFIXES = [(" разс", " расс"), ("Разс", "Расс"), (" безс", " бесс"), ("Безс", "Бесс"), (" безп", " бесп"), ("Безп", "Бесп")]
ENDINGS = [
    ("каго", "кого"), ("наго", "ного"), ("баго", "бого"), ("маго", "мого"), ("лаго", "лого"), ("таго", "того"), ("хаго", "хого"), ("раго", "рого"), ("ваго", "вого"),
    ("даго", "дого"), ("гаго", "гого"), ("щаго", "щего"), ("няго", "него"), ("шаго", "шего"), ("чаго", "чего"), ("жаго", "жего"), ("щияся", "щиеся"), ("шияся", "шиеся"),
    ("ныя", "ные"), ("мыя", "мые"), ("рыя", "рые"), ("выя", "вые"), ("зыя", "зые"), ("тыя", "тые"), ("лыя", "лые"), ("ския", "ские"),
]
LEXICAL = [
    ("такия", "такие"), ("оффициал", "официал"), ("прочия", "прочие"), ("великия", "великие"), ("всякия", "всякие"), ("такия", "такие"), ("ще-бы", "ще бы"), ("сли-б", "сли б"),
    ("ысокия", "ысокие"), ("третьяго", "третьего"), ("каждаго", "каждого"), (" мало по малу ", " мало-помалу "), ("ольшия", "ольшие"), ("другия", "другие"), ("ерния ", "ерние "),
    ("овидимому ", "о-видимому, "), ("чорт", "черт"), ("террасс", "террас"), ("последния", "последние"), ("аваллер", "авалер"), ("десятаго", "десятого"), ("новичек", "новичок"),
    ("шопот", "шепот"), ("галлер", "галер"), ("ладкия", "ладкие"), ("де-ж ", "де ж "), ("езполез", "есполез"), ("голыя", "голые"), ("разсуд", "рассуд"), ("как-будто", "как будто"),
    ("впродолжение", "в продолжение"), ("Впродолжение", "В продолжение"), ("-ли,", " ли,"), ("Голыя", "Голые"), ("если-б", "если б"), ("дальнейшия", "дальнейшие"), ("Многия", "Многие"),
    ("многия", "многие"), ("безчисл", "бесчисл"), ("безконеч", "бесконеч"), ("однех", "одних"), ("-же ", " же "), ("втупик", "в тупик"), ("днакож", "днако ж"), ("-ли ", " ли "),
    ("-ж ", " ж "), ("слиб", "сли б"), ("стоящия", "стоящие"), ("корридор", "коридор"), ("новыя", "новые"), ("широкия", "широкие"), ("передния", "передние"), (" рости ", " расти "),
    ("чужия", "чужие"), ("нынешния", "нынешние"), ("девятаго", "девятого"), ("прежняго", "прежнего"), ("глубокия", "глубокие"), ("няньчи", "нянчи"), (" одне.", " одни."),
    ("возст", "восст"), ("решотк", "решетк"), ("танцовал", "танцевал"), (" нея,", " нее,"), ("что-ж", "что ж"),
]
# ---- End of the fixed values.


@dataclass(frozen=True)
class Rule:
    """A literal text and its replacement, or a regular expression with one."""

    pattern: str
    replacement: str
    regex: bool = False

    def sql_trigger(self) -> str:
        """A text on which the rule fires."""
        return "домъ" if self.regex else self.pattern[:-1] + "!" if self.pattern.endswith(".") else self.pattern


def rule_table() -> list[Rule]:
    """All rules in order."""
    three, two = [" ", ", ", "."], [" ", ", "]
    pairs = [(sign + end, end) for sign in "ъЪ" for end in HARD_SIGN_ENDS]
    pairs += LETTERS
    pairs += [(old + end, new + end) for k, (old, new) in enumerate(WORDS) for end in (two if k % 2 else three)]
    pairs += PREFIXES
    pairs += [(old + end, new + end) for old, new in ENDINGS for end in three]
    return [Rule(r"([А-Яа-яёЁ]+)ъ\b", r"\1", True), *(Rule(*p) for p in pairs + LEXICAL)]


def live_rules(rules: Iterable[Rule]) -> list[Rule]:
    """The rules less literal ones that a literal rule before them leaves nothing to match.

    A rule is dead when its pattern contains an earlier pattern that is always rewritten. Text and count stay the same.
    """
    kept: list[Rule] = []
    for rule in rules:
        dead = not rule.regex and any(not k.regex and not k.pattern.endswith(".") and k.pattern in rule.pattern and k.pattern not in k.replacement for k in kept)
        if not dead:
            kept.append(rule)
    return kept


def _compiled(rules: Iterable[Rule], mode: str) -> list[tuple[str | re.Pattern, str]]:
    out: list[tuple[str | re.Pattern, str]] = []
    for rule in rules:
        if rule.regex:
            try:
                out.append((re.compile(rule.pattern), rule.replacement))
            except re.error:
                continue  # an invalid expression is skipped
        elif mode == "compat" and rule.pattern.endswith("."):
            out.append((re.compile(re.escape(rule.pattern[:-1]) + "."), rule.replacement))
        else:
            out.append((rule.pattern, rule.replacement))
    return out


def rewrite(text: str, steps: list[tuple[str | re.Pattern, str]]) -> tuple[str, int]:
    """The text after all steps in order, and how many replacements they made."""
    total = 0
    for find, replacement in steps:
        if isinstance(find, str):
            n = text.count(find)
            if n:
                text = text.replace(find, replacement)
        else:
            text, n = find.subn(replacement, text)
        total += n
    return text, total


def apply_rules(c: Column, rules: Iterable[Rule] | None = None, mode: str = "compat") -> Column:
    """struct<text, n>: the rewritten text and the number of replacements, in Arrow batches.

    mode "compat" lets a dot that ends a pattern stand for any character, "strict" only for a dot.
    """
    steps = _compiled(live_rules(rule_table()) if rules is None else rules, mode)

    @F.pandas_udf("struct<text:string,n:long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([rewrite(t or "", steps) for t in texts], columns=["text", "n"])

    return run(c)


def rewrite_blocks(blocks: DataFrame, rules: Iterable[Rule] | None = None, mode: str = "compat") -> DataFrame:
    """Blocks with their text rewritten and a column `n`, the replacements made in it."""
    done = blocks.withColumn("done", apply_rules(F.col("text"), rules, mode))
    return done.withColumn("text", F.col("done.text")).withColumn("n", F.col("done.n")).drop("done")


def rules_applied(rewritten: DataFrame) -> DataFrame:
    """doc_id, rules_applied."""
    return rewritten.groupBy("doc_id").agg(F.sum("n").alias("rules_applied"))


def rules_frame(spark, rules: Iterable[Rule] | None = None) -> DataFrame:
    """The rules as a table: ord, pattern, repl, regex."""
    rows = [(k, r.pattern, r.replacement, r.regex) for k, r in enumerate(rule_table() if rules is None else rules)]
    return spark.createDataFrame(rows, "ord int, pattern string, repl string, regex boolean")


def read_rules(spark, path: str) -> list[Rule]:
    """Rules of a file: a JSON object a line with pattern, repl and, if it is a regular expression, regex; in the file's order."""
    lines = spark.read.text(path, wholetext=True).orderBy(F.col("_metadata.file_path")).collect()
    rows = [json.loads(line) for text in lines for line in text["value"].splitlines() if line.strip()]
    return [Rule(r["pattern"], r["repl"], bool(r.get("regex", False))) for r in rows]


def rewrite_html(pages: DataFrame) -> DataFrame:
    """Pages whose html column the rules change, with the new html."""
    done = pages.withColumn("new", apply_rules(F.col("html"))["text"]).where(F.col("new") != F.col("html"))
    return done.withColumn("html", F.col("new")).drop("new")
