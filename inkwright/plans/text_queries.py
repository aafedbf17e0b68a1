"""Queries and SQL of the rules, text functions and block operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.functions import text as T
from inkwright.functions.folds import chunk_paragraphs
from inkwright.operators import blocks as B
from inkwright.operators import chapters, flags, render, rules
from inkwright.plans import inputs as I  # noqa: E741
from inkwright.plans import pipeline
from inkwright.plans.inputs import quote

STRIP = r"regexp_replace(%s, '^\s+|\s+$', '', 'g')"


def strip(e: str) -> str:
    return STRIP % e


def again(e: str, pattern: str, replacement: str) -> str:
    """A replacement whose matches may share a character, done twice for want of lookaround."""
    once = f"regexp_replace({e}, '{pattern}', '{replacement}', 'g')"
    return f"regexp_replace({once}, '{pattern}', '{replacement}', 'g')"


def sub(e: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({e}, '{pattern}', '{replacement}', 'g')"


# ---------------------------------------------------------------- rules


def rules_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.triggered(spark, sf_dir).select("doc_id", rules.apply_rules(F.col("text"))["text"].alias("text"))


def rules_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.triggered(spark, sf_dir).select("doc_id", rules.apply_rules(F.col("text"))["n"].alias("n"))


def rules_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.triggered(spark, sf_dir).select("doc_id", rules.apply_rules(F.col("text"), mode="strict")["text"].alias("text"))


def _rules_sql(column: str, strict: bool = False) -> str:
    """All rules folded in order; the expression for a hard sign at a word's end leaves nothing the next rule would not take."""
    listed = []
    for r in rules.rule_table()[1:]:
        dot = r.pattern.endswith(".") and not strict
        pattern = (r.pattern[:-1].replace("-", r"\-") + "[^\\n]") if dot else r.pattern
        text = lambda s: "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
        listed.append(f"{{'t': '', 'n': 0, 'p': {text(pattern)}, 'r': {text(r.replacement)}, 'k': {str(dot).lower()}}}")
    state = "{'t': text, 'n': 0, 'p': '', 'r': '', 'k': false}"
    step = """{'t': CASE WHEN x.k THEN regexp_replace(acc.t, x.p, x.r, 'g') ELSE replace(acc.t, x.p, x.r) END,
      'n': acc.n + CASE WHEN x.k THEN len(regexp_extract_all(acc.t, x.p)) ELSE ((length(acc.t) - length(replace(acc.t, x.p, ''))) // length(x.p)) END::INTEGER, 'p': '', 'r': '', 'k': false}"""
    value = "s.t AS text" if column == "text" else "s.n::BIGINT AS n"
    return f"WITH {I.triggered_sql()} SELECT doc_id, {value} FROM (SELECT doc_id, list_reduce([{', '.join(listed)}], lambda acc, x: {step}, {state}) AS s FROM triggered)"


# ---------------------------------------------------------------- text functions


def _on_texts(change):
    return lambda spark, sf_dir: I.old_texts(spark, sf_dir).select("doc_id", change(F.col("text")).alias("text"))


def _lit(c, *pairs):
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


BREAKS = [(". ", ".\r\n"), (", ", "-\n"), (" т", "\n\nт")]
PUNCT = [(", ", " - "), (". ", "... "), (" т", " ,т"), (" д", ' "д'), ("а ", 'а" ')]
ODD = [("а", "“"), ("е ", "■ "), ("с", "‒"), ("о", "¬о")]
OCR = [(". ", " па "), ("на ", "то мере ")]


def _lit_sql(e: str, pairs) -> str:
    for a, b in pairs:
        chars = lambda s: "'" + s.replace("'", "''").replace("\r\n", "' || chr(13) || chr(10) || '").replace("\n", "' || chr(10) || '") + "'"
        e = f"replace({e}, {chars(a)}, {chars(b)})"
    return e


normalize_linebreaks = _on_texts(lambda c: T.normalize_linebreaks(_lit(c, *BREAKS)))
normalize_punct = _on_texts(lambda c: T.normalize_punct(_lit(c, *PUNCT)))
odd_symbols = _on_texts(lambda c: T.replace_odd_symbols(_lit(c, *ODD)))
mixed_script = _on_texts(T.mixed_latin_to_cyrillic)
ocr_fixes = _on_texts(lambda c: T.fix_ocr(_lit(c, *OCR)))
spaced_letters = _on_texts(lambda c: T.join_spaced_letters(F.regexp_replace(F.left(c, F.lit(2**31 - 1)), "([а-я])(?=[а-я]{2}\\b)", "$1 ")))
small_gaps = _on_texts(lambda c: T.close_small_gaps(F.regexp_replace(c, "([а-я]{2})(?=[а-я])", "$1 ")))
cleanup = _on_texts(lambda c: T.cleanup(_lit(c, *ODD[1:2], *OCR)))
file_names = _on_texts(lambda c: T.file_name(F.replace(c, F.lit("."), F.lit("?:"))))
html_escape = lambda spark, sf_dir: I.table(spark, sf_dir, "pages").select("page_id", T.escape_html(F.col("html")).alias("text"))
html_unescape = lambda spark, sf_dir: I.table(spark, sf_dir, "pages").select("page_id", T.unescape_html(F.col("html")).alias("text"))
strip_tags = lambda spark, sf_dir: I.table(spark, sf_dir, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))

W = r"[\p{L}\p{N}_]"
_linebreaks = sub(again(again(_lit_sql(_lit_sql("text", BREAKS), [("\r\n", "\n")]).replace("chr(13) || chr(10) || ''", "chr(13) || chr(10)"), rf"({W})[-‑–—]\n({W})", r"\1\2"), r"([^\n])\n([^\n])", r"\1 \2"), r"[ \t]{2,}", " ")
LINEBREAKS_SQL = f"WITH {I.TEXTS_SQL} SELECT doc_id, {strip(_linebreaks)} AS text FROM texts"


def _punct_sql(e: str) -> str:
    e = f"replace({e}, '–', '—')"
    e = sub(e, r"\s*—\s*", " — ")
    e = again(e, r"(^|[^.])\.\.\.($|[^.])", r"\1…\2")
    e = again(e, r"(\S)\s-\s(\S)", r"\1 — \2")
    e = again(e, r"(\s)--(\s)", r"\1 — \2")
    e = sub(e, r"\s+([,.:;?!…»)])", r"\1")
    e = sub(e, "([.;:?!…])([А-Яа-яЁё])", r"\1 \2")
    e = again(e, r"(^|[^0-9]),([А-Яа-яЁё])", r"\1, \2")
    e = sub(e, r"[ \t]{2,}", " ")
    e = sub(e, '"([^"]+)"', r"«\1»")
    return strip(sub(e, "''([^'']+)''", r"„\1“"))


PUNCT_SQL = f"WITH {I.TEXTS_SQL} SELECT doc_id, {_punct_sql(_lit_sql('text', PUNCT))} AS text FROM texts"
ODD_SQL = f"WITH {I.TEXTS_SQL} SELECT doc_id, translate({_lit_sql('text', ODD)}, '{T.ODD}', '{T.ODD_FOR}') AS text FROM texts"
MIXED_SQL = f"""WITH {I.TEXTS_SQL} SELECT doc_id, array_to_string(list_transform(
  regexp_extract_all(text, '[A-Za-z\\x{{0400}}-\\x{{04FF}}]+(?:-[A-Za-z\\x{{0400}}-\\x{{04FF}}]+)*|[^A-Za-z\\x{{0400}}-\\x{{04FF}}]+'),
  lambda t: CASE WHEN regexp_matches(t, '[\\x{{0400}}-\\x{{04FF}}]') AND regexp_matches(t, '[A-Za-z]') AND NOT regexp_matches(t, '^[^A-Za-z\\x{{0400}}-\\x{{04FF}}]') THEN translate(t, '{T.LATIN}', '{T.LOOKALIKE}') ELSE t END), '') AS text FROM texts"""
_ocr = sub(_lit_sql("text", OCR), rf"(?i)(^|[^\p{{L}}\p{{N}}_])па\s+([а-яё])", r"\1на \2")
_ocr = sub(_ocr, rf"(?i)(^|[^\p{{L}}\p{{N}}_])то\s+(дороге|стене|полу|небу|земле|воде|берегу|берегам)($|[^\p{{L}}\p{{N}}_])", r"\1по \2\3")
OCR_SQL = f"WITH {I.TEXTS_SQL} SELECT doc_id, {again(_ocr, '(?i)(^|[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_])то' + chr(92) + 's+(мере|степени|крайней|меньшей|большей)($|[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_])', chr(92) + '1по ' + chr(92) + '2' + chr(92) + '3')} AS text FROM texts"
FILE_SQL = f"""WITH {I.TEXTS_SQL} SELECT doc_id, translate(replace(text, '.', '?:'), '<>:"/\\|?* ', '__________') AS text FROM texts"""
ESCAPE_SQL = "SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS text FROM pages"
_unescape = "replace(replace(replace(replace(replace(%s, '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"')"
UNESCAPE_SQL = f"SELECT page_id, {_unescape % 'html'} AS text FROM pages"
TAGS_SQL = "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages"


# ---------------------------------------------------------------- blocks


def section_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, as it stands and with a keyword before it."""
    lines = I.spread(I.table(spark, sf_dir, "documents")).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("block_id", "text"))
    named = F.when(F.col("block_id") % 3 == 0, F.concat(F.lit(" глава "), "block_id", F.lit(". "), "text")).when(F.col("block_id") % 5 == 0, F.concat(F.lit("* * *"), "text")).otherwise(F.col("text"))
    return lines.select("doc_id", "block_id", T.section_heading(named).alias("heading"))


HEADINGS_SQL = r"""
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
lines AS (SELECT doc_id, unnest(range(1, len(p) + 1)) - 1 AS block_id, unnest(p) AS text FROM parts),
named AS (SELECT doc_id, block_id, trim(CASE WHEN block_id % 3 = 0 THEN ' глава ' || block_id || '. ' || text WHEN block_id % 5 = 0 THEN '* * *' || text ELSE text END) AS t FROM lines)
SELECT doc_id, block_id::INTEGER AS block_id, regexp_matches(t, '(?i)^(часть|глава|раздел|книга)([^\p{L}\p{N}_].*)?[0-9]') OR regexp_matches(t, '(?i)^[IVXLCDM]+($|[^\p{L}\p{N}_])') OR regexp_matches(t, '^\*\s*\*\s*\*') AS heading FROM named
"""


def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.table(spark, sf_dir, "pages").select("page_id", _lit(F.col("html"), ("<h1", "<h2"), ("</h1>", "</h2>")).alias("html"))
    return B.html_blocks(I.spread(pages, "page_id"))


HTML_BLOCKS_SQL = rf"""
WITH found AS (SELECT page_id, list_transform(regexp_extract_all(replace(replace(html, '<h1', '<h2'), '</h1>', '</h2>'), '(?is)<h2[^>]*>(?:.*?)</h2>|<p[^>]*>(?:.*?)</p>'),
  lambda e: {{'role': CASE WHEN lower(e[1:3]) = '<h2' THEN 'heading' ELSE 'paragraph' END,
    'text': {strip("regexp_replace(" + _unescape % "regexp_replace(e, '<[^>]+>', '', 'g')" + r", '\s+', ' ', 'g')")}}}) AS b FROM pages),
kept AS (SELECT page_id, list_filter(b, lambda x: x.text <> '') AS b FROM found)
SELECT page_id, (unnest(range(1, len(b) + 1)) - 1)::INTEGER AS block_id, unnest(b).role AS role, unnest(b).text AS text FROM kept
"""


def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit(". "), F.lit(".\n \n"))).otherwise(F.col("text")).alias("text"))
    return B.text_blocks(I.spread(docs))


TEXT_BLOCKS_SQL = r"""
WITH texts AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, '. ', '.' || chr(10) || ' ' || chr(10)) ELSE text END AS t FROM documents),
parts AS (SELECT doc_id, CASE WHEN NOT regexp_matches(t, '\n\s*\n') THEN string_split(t, chr(10)) ELSE string_split(regexp_replace(t, '\n\s*\n', chr(1), 'g'), chr(1)) END AS p FROM texts),
lined AS (SELECT doc_id, list_filter(list_transform(p, lambda x: list_filter(list_transform(string_split(x, chr(10)), lambda y: trim(y, ' ' || chr(9) || chr(13))), lambda y: y <> '')), lambda x: len(x) > 0) AS p FROM parts),
rows AS (SELECT doc_id, unnest(range(1, len(p) + 1)) - 1 AS block_id, unnest(p) AS l FROM lined),
firsts AS (SELECT doc_id, block_id, l, l[1] AS f FROM rows)
SELECT doc_id, block_id::INTEGER AS block_id,
  CASE WHEN (length(f) < 100 AND ((f = upper(f) AND f <> lower(f)) OR (len(l) = 1 AND length(f) < 50)) AND NOT regexp_matches(f, '[.,;:!?]$'))
    OR regexp_matches(f, '(?i)^[IVXLCDM]+($|[^\p{L}\p{N}_])') OR regexp_matches(f, '^\*\s*\*\s*\*') THEN 'heading' ELSE 'paragraph' END AS role,
  regexp_replace(array_to_string(l, ' '), '\s+', ' ', 'g') AS text FROM firsts
"""


def merge_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.merge_paragraphs(I.broken_blocks(spark, sf_dir))


_MERGED_CTE = rf"""{I.BROKEN_SQL},
clean AS (SELECT doc_id, block_id, role, {strip(sub("text", r"[ \t]{2,}", " "))} AS text FROM broken),
ended AS (SELECT *, role = 'heading' OR regexp_matches(text, '[.!?…][»”)\]"]?\s*$') AS closes FROM clean),
opened AS (SELECT *, (role = 'heading' OR coalesce(lag(closes) OVER w, true))::INTEGER AS opens FROM ended WINDOW w AS (PARTITION BY doc_id ORDER BY block_id)),
grouped AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY block_id) - 1 AS merged_id FROM opened),
listed AS (SELECT doc_id, merged_id, arg_min(role, block_id) AS role, list(text ORDER BY block_id) AS l FROM grouped GROUP BY ALL),
merged AS (SELECT doc_id, merged_id::INTEGER AS merged_id, role, list_reduce(l, lambda a, b: CASE
    WHEN regexp_matches(a, '[-‑–—]\s*$') AND regexp_matches(b, '^[A-Za-zА-Яа-яЁё]') THEN regexp_replace(a, '[-‑–—]\s*$', '') || b
    WHEN regexp_matches(a, ' $') OR regexp_matches(b, '^[ ,.;:!?…»)\]]') THEN a || b ELSE a || ' ' || b END) AS text FROM listed)"""
MERGE_SQL = f"WITH {_MERGED_CTE} SELECT doc_id, merged_id, role, text FROM merged"


def chapter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = I.broken_blocks(spark, sf_dir).withColumn("role", F.when(F.col("block_id") % 11 == 5, "heading").otherwise("paragraph"))
    return chapters.split_chapters(blocks, 1).select("doc_id", "chapter_id", "title", "block_id")


CHAPTERS_SQL = rf"""
WITH {I.BROKEN_SQL},
rows AS (SELECT doc_id, block_id, block_id % 11 = 5 AS h, octet_length(encode({strip("text")}))::BIGINT AS n, {strip("text")} AS t FROM broken),
listed AS (SELECT doc_id, list({{'id': block_id, 'h': h, 'n': n, 'c': -1::INTEGER, 'z': 0::BIGINT}} ORDER BY block_id) AS l FROM rows GROUP BY doc_id),
walked AS (SELECT doc_id, list_reduce(list_transform(l, lambda x: [x]), lambda a, b: list_append(a, {{'id': b[1].id, 'h': b[1].h, 'n': b[1].n,
    'c': CASE WHEN b[1].h OR (a[-1].z + CASE WHEN len(a) = 1 THEN a[1].n ELSE 0 END) + b[1].n > 1024 THEN (CASE WHEN len(a) = 1 THEN 0 ELSE a[-1].c END) + 1 ELSE (CASE WHEN len(a) = 1 THEN 0 ELSE a[-1].c END) END,
    'z': CASE WHEN b[1].h OR (a[-1].z + CASE WHEN len(a) = 1 THEN a[1].n ELSE 0 END) + b[1].n > 1024 THEN b[1].n ELSE (a[-1].z + CASE WHEN len(a) = 1 THEN a[1].n ELSE 0 END) + b[1].n END}})) AS l FROM listed),
flat AS (SELECT doc_id, unnest(l) AS x FROM walked),
placed AS (SELECT doc_id, x.id AS block_id, greatest(x.c, 0) AS chapter_id FROM flat)
SELECT doc_id, chapter_id, coalesce(first_value(CASE WHEN h THEN nullif(t, '') END) OVER (PARTITION BY doc_id, chapter_id ORDER BY block_id), 'Глава ' || (chapter_id + 1)) AS title, block_id::INTEGER AS block_id
FROM placed JOIN rows USING (doc_id, block_id)
"""


# ---------------------------------------------------------------- flags, chunks, rendering, pipeline


def letter_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = I.old_lines(spark, sf_dir).select("doc_id", F.col("block_id").alias("merged_id"), F.lit("paragraph").alias("role"), "text")
    found = flags.flag_blocks(merged)
    number = lambda kind: F.size(F.filter("flags", lambda f: f["type"] == kind)).alias(kind)
    return found.select("doc_id", "block", F.length("text").alias("marked_length"), number("yat"), number("i"), number("latin_to_cyr"))


FLAGS_SQL = rf"""
WITH {I.LINES_SQL}, pieces AS (SELECT doc_id, block_id, text, length(text) - length(replace(text, 'ѣ', '')) AS yat, length(text) - length(replace(text, 'і', '')) AS i,
  coalesce(list_sum(list_transform(list_filter(regexp_extract_all(translate(text, 'ѣі', '||'), '[A-Za-z\x{{0400}}-\x{{04FF}}]+(?:-[A-Za-z\x{{0400}}-\x{{04FF}}]+)*'),
    lambda t: regexp_matches(t, '[\x{{0400}}-\x{{04FF}}]') AND regexp_matches(t, '[A-Za-z]')), lambda t: len(regexp_extract_all(t, '[{T.LATIN}]')))), 0) AS lat FROM lines)
SELECT doc_id, block_id::INTEGER AS block, (length(text) + {flags._GROWTH} * (yat + i + lat))::INTEGER AS marked_length, yat::INTEGER AS yat, i::INTEGER AS i, lat::INTEGER AS latin_to_cyr FROM pieces
"""


def flag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = I.old_lines(spark, sf_dir).select("doc_id", F.col("block_id").alias("merged_id"), F.lit("paragraph").alias("role"), "text")
    return flags.count_flags(merged)


FLAG_SUMMARY_SQL = f"WITH f AS ({FLAGS_SQL}) SELECT 'yat' AS type, sum(yat)::BIGINT AS n FROM f UNION ALL SELECT 'i', sum(i)::BIGINT FROM f UNION ALL SELECT 'latin_to_cyr', sum(latin_to_cyr)::BIGINT FROM f"


def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.spread(I.table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit(". "), F.lit("\n\n")).alias("text")))
    return docs.select("doc_id", F.posexplode(chunk_paragraphs(F.col("text"), 600)).alias("chunk_id", "text"))


CHUNKS_SQL = r"""
WITH p AS (SELECT doc_id, list_transform(string_split(replace(text, '. ', chr(10) || chr(10)), chr(10) || chr(10)), lambda x: [x || chr(10) || chr(10)]) AS l FROM documents),
w AS (SELECT doc_id, list_reduce(l, lambda a, b: CASE WHEN length(a[-1]) + length(b[1]) > 600 THEN list_append(a, b[1]) ELSE list_append(a[:-2], a[-1] || b[1]) END) AS c FROM p)
SELECT doc_id, (unnest(range(1, len(c) + 1)) - 1)::INTEGER AS chunk_id, unnest(c) AS text FROM w
"""


def render_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.html(I.broken_blocks(spark, sf_dir), "A & B")


RENDER_SQL = f"""
WITH {I.BROKEN_SQL}, e AS (SELECT doc_id, block_id, role, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS t FROM broken)
SELECT doc_id, replace({quote(render.HEAD)}, '%s', 'A &amp; B') || string_agg(CASE WHEN role = 'heading' THEN '<h2>' || t || '</h2>' ELSE '<p>' || t || '</p>' END, chr(10) ORDER BY block_id) || {quote(render.FOOT)} AS html FROM e GROUP BY doc_id
"""


def plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.plain_text(I.broken_blocks(spark, sf_dir))


PLAIN_SQL = f"WITH {I.BROKEN_SQL} SELECT doc_id, string_agg(regexp_replace(text, '<[^>]+>', '', 'g'), chr(10) || chr(10) ORDER BY block_id) AS text FROM broken GROUP BY doc_id"


def pipeline_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, normalisation and merging over whole documents: blocks, characters and replacements of each."""
    merged = pipeline.modernized(I.broken_blocks(spark, sf_dir))
    return merged.groupBy("doc_id").agg(F.count("*").alias("blocks"), F.sum(F.length("text")).alias("chars"), F.sum("n").alias("rules_applied"))


def epub_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A package of each document, and how many chapters it holds."""
    out = pipeline.run(I.broken_blocks(spark, sf_dir), pipeline.Spec(title="Book", author="Author", chapter_kb=4))
    sizes = out["chapters"].groupBy("doc_id").agg(F.countDistinct("chapter_id").alias("chapters"))
    return out["epub"].join(sizes, "doc_id").select("doc_id", "chapters", F.hex(F.substring("epub", 1, 2)).alias("magic"))


QUERIES = {
    "rules_apply": rules_apply, "rules_count": rules_count, "rules_strict": rules_strict, "normalize_linebreaks": normalize_linebreaks, "normalize_punct": normalize_punct,
    "odd_symbols": odd_symbols, "mixed_script": mixed_script, "spaced_letters": spaced_letters, "small_gaps": small_gaps, "ocr_fixes": ocr_fixes, "cleanup": cleanup,
    "file_names": file_names, "html_escape": html_escape, "html_unescape": html_unescape, "strip_tags": strip_tags, "section_headings": section_headings, "html_blocks": html_blocks,
    "text_blocks": text_blocks, "merge_paragraphs": merge_paragraphs, "chapters": chapter_rows, "letter_flags": letter_flags, "flag_summary": flag_summary,
    "chunk_paragraphs": chunk_rows, "render_html": render_html, "plain_text": plain_text, "pipeline_core": pipeline_core, "epub_packages": epub_sizes,
}

ORACLES = {
    "rules_apply": _rules_sql("text"), "rules_count": _rules_sql("n"), "rules_strict": _rules_sql("text", True), "normalize_linebreaks": LINEBREAKS_SQL, "normalize_punct": PUNCT_SQL,
    "odd_symbols": ODD_SQL, "mixed_script": MIXED_SQL, "ocr_fixes": OCR_SQL, "file_names": FILE_SQL, "html_escape": ESCAPE_SQL, "html_unescape": UNESCAPE_SQL,
    "strip_tags": TAGS_SQL, "section_headings": HEADINGS_SQL, "html_blocks": HTML_BLOCKS_SQL, "text_blocks": TEXT_BLOCKS_SQL, "merge_paragraphs": MERGE_SQL, "chapters": CHAPTERS_SQL,
    "letter_flags": FLAGS_SQL, "flag_summary": FLAG_SUMMARY_SQL, "chunk_paragraphs": CHUNKS_SQL, "render_html": RENDER_SQL, "plain_text": PLAIN_SQL,
}
