"""Text normalisation as column expressions.

Python's white-space and word classes are written (?U): Java's are ASCII without it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Latin letters that look like Cyrillic ones, and those.
LATIN = "AaBEeKkMHOoPpCcTXxYy"
LOOKALIKE = "АаВЕеКкМНОоРрСсТХхУу"
# Odd symbols and what replaces them; the not sign goes.
ODD = "■‐‑‒–―“”„‟¬"
ODD_FOR = " ----—«»«»"

CYRILLIC = "А-Яа-яЁё"
HYPHENS = "[-‑–—]"


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends; trim() removes only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def replace_all(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Ordered regular-expression replacements."""
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def map_matches(c: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """Replace each match of a pattern (which never matches nothing) by a function of it, natively.

    The text between matches and the matches themselves are two arrays that are zipped together.
    """
    between = F.split(c, pattern, -1)
    found = F.concat(F.transform(F.regexp_extract_all(c, F.lit(pattern), 0), change), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, found, lambda a, b: F.concat(a, b)), "")


def unify_linebreaks(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def normalize_linebreaks(c: Column) -> Column:
    """Line ends, invisible characters, hyphenation at line ends, single line ends to spaces, runs of blanks."""
    c = unify_linebreaks(F.coalesce(c, F.lit("")))
    # The patterns of line breaks in their order.
    rules = [("[​‌‍­]", ""), (rf"(?U)([\w{CYRILLIC}]){HYPHENS}\n(?=[\w{CYRILLIC}])", "$1"), (r"(?<!\n)\n(?!\n)", " "), (r"[ \t]{2,}", " ")]
    return strip(replace_all(c, rules))


def normalize_punct(c: Column) -> Column:
    """Dashes, ellipses, space around punctuation, straight quotes; the order matters."""
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("–"), F.lit("—"))
    # The patterns of punctuation in their order.
    rules = [
        (r"(?U)\s*—\s*", " — "),
        (r"(?<!\.)\.\.\.(?!\.)", "…"),
        (r"(?U)(?<=\S)\s-\s(?=\S)", " — "),
        (r"(?U)(?<=\s)--(?=\s)", " — "),
        (r"(?U)\s+([,.:;?!…»)])", "$1"),
        (rf"([.;:?!…])(?=[{CYRILLIC}])", "$1 "),
        (rf"(?U)(?<!\d),(?=[{CYRILLIC}])", ", "),
        (r"[ \t]{2,}", " "),
        (r'"([^"]+)"', "«$1»"),
        (r"'([^']+)'", "„$1“"),
    ]
    return strip(replace_all(c, rules))


def replace_odd_symbols(c: Column) -> Column:
    return F.translate(c, ODD, ODD_FOR)


MIXED_TOKEN = "[A-Za-zЀ-ӿ]+(?:-[A-Za-zЀ-ӿ]+)*"


def mixed_latin_to_cyrillic(c: Column) -> Column:
    """In tokens of both scripts, Latin look-alikes become Cyrillic."""
    both = lambda t: t.rlike("[Ѐ-ӿ]") & t.rlike("[A-Za-z]")
    return map_matches(c, MIXED_TOKEN, lambda t: F.when(both(t), F.translate(t, LATIN, LOOKALIKE)).otherwise(t))


# Fixed value: letters set apart.
SPACED = r"(?U)(?<!\S)(?:[А-ЯЁа-яё]\s){2,}[А-ЯЁа-яё](?!\S)"


def join_spaced_letters(c: Column) -> Column:
    """Letters set apart by white space are one word; only plain spaces go."""
    return map_matches(c, SPACED, lambda t: F.replace(t, F.lit(" "), F.lit("")))


_WORDS = re.compile(r"(?<![\w-])[А-ЯЁа-яё]+(?:\s+[А-ЯЁа-яё]+)+(?![\w-])")


def _close(match: re.Match) -> str:
    parts = match[0].split()
    joined = "".join(parts)
    few_long = sum(len(p) > 2 for p in parts) <= 1
    return joined if few_long and len(joined) >= 4 else match[0]


@F.pandas_udf(StringType())
def close_small_gaps(texts: pd.Series) -> pd.Series:
    """Join a whole run of Cyrillic words when at most one has over two letters.

    Arrow batches of Python's expressions: Java's engine recurses once a word and overflows on long runs.
    """
    return texts.map(lambda t: None if t is None else _WORDS.sub(_close, t))


def fix_ocr(c: Column) -> Column:
    """Misread prepositions before words that call for another."""
    # Words that call for another preposition, and the patterns.
    after = "дороге|стене|полу|небу|земле|воде|берегу|берегам"
    degree = "мере|степени|крайней|меньшей|большей"
    return replace_all(c, [(r"(?iuU)\bпа\s+([а-яё])", "на $1"), (rf"(?iuU)\bто\s+({after})\b", "по $1"), (rf"(?iuU)\bто\s+({degree})\b", "по $1")])


def cleanup(c: Column) -> Column:
    """The post-cleaning steps in their fixed order."""
    c = unify_linebreaks(F.coalesce(c, F.lit("")))
    c = replace_odd_symbols(F.regexp_replace(c, "[​‌‍­]", ""))
    # The patterns of cleaning in their order.
    c = replace_all(c, [(r"(?U)\s*—\s*", " — "), (rf"(?U)([\w{CYRILLIC}]){HYPHENS}\n(?=[\w{CYRILLIC}])", "$1"), (r"(?<!\n)\n(?!\n)", " "), (r"[ \t]{2,}", " ")])
    return strip(mixed_latin_to_cyrillic(fix_ocr(close_small_gaps(join_spaced_letters(c)))))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def _literal(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def escape_html(c: Column) -> Column:
    return _literal(c, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")])


def unescape_html(c: Column) -> Column:
    """Five references in this order, so that a doubly escaped one is decoded twice."""
    return _literal(c, [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"')])


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def file_name(c: Column) -> Column:
    return F.replace(F.regexp_replace(c, r'[<>:"/\\|?*]', "_"), F.lit(" "), F.lit("_"))


def section_heading(c: Column) -> Column:
    """Part, chapter, section or book with a number; a Roman numeral; three asterisks."""
    c = strip(F.coalesce(c, F.lit("")))
    return c.rlike(r"(?iuU)^(?:Часть|Глава|Раздел|Книга)\b.*\d") | c.rlike(r"(?iU)^[IVXLCDM]+\b") | c.rlike(r"(?U)^\*\s*\*\s*\*")


def is_upper(c: Column) -> Column:
    return (c == F.upper(c)) & (c != F.lower(c))


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 2**31 - 1)))


def count_of(c: Column, part: Column) -> Column:
    """How often a text, not empty, occurs without overlap."""
    return ((F.length(c) - F.length(F.replace(c, part, F.lit("")))) / F.length(part)).cast("long")


# Prepositions that do not stand at the end of a line.
HANGING = ("в", "к", "с", "у", "о", "по", "из", "от", "до", "об", "на", "за", "над", "при", "про")


def hanging_prepositions(lines: Column) -> Column:
    """array<string>: title lines with a preposition at a line's end moved to the next line."""
    numbered = F.transform(lines, lambda line, i: F.struct(line.alias("line"), (i == F.size(lines) - 1).alias("last")))
    state = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("held"))

    def step(acc: Column, x: Column) -> Column:
        line = F.when(acc["held"] == "", x["line"]).otherwise(strip(F.concat(acc["held"], F.lit(" "), x["line"])))
        parts = F.filter(F.split(line, r"(?U)\s+", -1), lambda w: w != "")
        tail = F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))
        hangs = ~x["last"] & F.lower(tail).isin(*HANGING)
        before = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), " ")
        kept = F.when(hangs, before).otherwise(line)
        return F.struct(F.when(strip(kept) == "", acc["out"]).otherwise(F.concat(acc["out"], F.array(kept))).alias("out"), F.when(hangs, tail).otherwise(F.lit("")).alias("held"))

    return F.aggregate(numbered, state, step, lambda acc: acc["out"])


def round_up(c: Column, step: int = 64, low: int = 64, high: int = 1024) -> Column:
    """The next multiple of a step, within bounds; the lower bound for what is not positive."""
    return F.when(c <= 0, F.lit(low)).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), (F.ceil(c / step) * step).cast("int"))))


def parse_color(value: str) -> tuple[int, int, int]:
    """A colour of three or six hexadecimal digits."""
    digits = value.strip().lstrip("#")
    if not re.fullmatch(r"[0-9A-Fa-f]{3}|[0-9A-Fa-f]{6}", digits):
        raise ValueError(f"not a colour: {value!r}")
    if len(digits) == 3:
        digits = "".join(d * 2 for d in digits)
    return tuple(int(digits[k : k + 2], 16) for k in (0, 2, 4))


def parse_palette(value: str) -> list[tuple[int, int, int]]:
    """Exactly five colours divided by spaces, commas or semicolons."""
    colors = [parse_color(x) for x in re.split(r"[\s,;]+", value.strip()) if x]
    if len(colors) != 5:
        raise ValueError("a palette has five colours")
    return colors
