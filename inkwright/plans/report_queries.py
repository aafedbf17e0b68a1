"""Queries and SQL of places, reports, renderers, packages and whole chains."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.functions import text as T
from inkwright.functions.folds import replace_in_order
from inkwright.operators import chapters, context, entities, epub, flags, layout, render, rules, spell
from inkwright.plans import inputs as I  # noqa: E741
from inkwright.plans import record_queries as R
from inkwright.plans import text_queries as Q
from inkwright.plans.inputs import quote
from inkwright.sources import readers

N = "chr(10)"

# ---------------------------------------------------------------- page records


def _page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page records: an order is a page, its lines are text blocks of one or two lines, some of them pictures."""
    li = I.table(spark, sf_dir, "lineitem")
    x0 = (F.col("l_partkey") % 400).cast("double")
    box = F.array(x0, (F.col("l_suppkey") % 50).cast("double"), x0 + F.col("l_quantity") * 4, F.lit(900.0))
    span = lambda text: F.array(F.struct(text.alias("text"), F.col("l_quantity").alias("size")))
    first = F.struct(span(F.concat("l_returnflag", F.repeat(F.lit("x"), (F.col("l_partkey") % 7).cast("int")), F.when(F.col("l_suppkey") % 2 == 0, "-").otherwise(""))).alias("spans"))
    second = F.struct(span(F.col("l_linestatus")).alias("spans"))
    block = F.struct(F.col("l_linenumber").alias("at"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.when(F.col("l_partkey") % 11 == 0, 1).otherwise(0).alias("type"), box.alias("bbox"), F.array(first, second).alias("lines"))
    listed = F.transform(F.array_sort(F.collect_list(block)), lambda b: F.struct(b["type"].alias("type"), b["bbox"].alias("bbox"), b["lines"].alias("lines")))
    pages = li.groupBy("l_orderkey").agg(listed.alias("blocks"))
    return pages.select((F.col("l_orderkey") % 500).cast("string").alias("doc_id"), F.col("l_orderkey").cast("int").alias("page"), F.lit(600.0).alias("width"), "blocks")


_RECORDS_CTE = """recs AS (SELECT (l_orderkey % 500)::VARCHAR AS doc_id, l_orderkey::INTEGER AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) AS k, l_partkey % 11 = 0 AS picture,
  (l_partkey % 400)::DOUBLE AS x0, (l_suppkey % 50)::DOUBLE AS y0, (l_partkey % 400)::DOUBLE + l_quantity * 4 AS x1, l_quantity AS wsize,
  l_returnflag || repeat('x', (l_partkey % 7)::INTEGER) || CASE WHEN l_suppkey % 2 = 0 THEN '-' ELSE '' END AS a, l_linestatus AS b FROM lineitem)"""


def structured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to numbered blocks: texts, sizes, roles and reading order at once."""
    return layout.structured(_page_records(spark, sf_dir)).select("doc_id", "block_id", "page", "role", "text", "wsize")


STRUCTURED_SQL = f"""WITH {_RECORDS_CTE}, made AS (SELECT *, CASE WHEN right(a, 1) = '-' THEN left(a, length(a) - 1) || b ELSE a || ' ' || b END AS text, length(a) + length(b) AS chars FROM recs WHERE NOT picture),
med AS (SELECT page, list_sort(list(wsize))[len(list(wsize)) // 2 + 1] AS median FROM made GROUP BY page),
roled AS (SELECT *, CASE WHEN (wsize >= median * 1.35 + 0.5 AND chars <= 200) OR (abs((x0 + x1) / 2 - 300) < 600 * 0.12::DOUBLE AND chars <= 200 AND NOT x1 - x0 > 600 * 0.45::DOUBLE) THEN 'heading' ELSE 'paragraph' END AS role FROM made JOIN med USING (page))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY page, y0, x0, k) - 1)::INTEGER AS block_id, page, role, text, wsize FROM roled"""


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.page_texts(_page_records(spark, sf_dir))


PAGE_TEXTS_SQL = f"WITH {_RECORDS_CTE} SELECT doc_id, string_agg(a || {N} || b, {N} ORDER BY page, k) AS text FROM recs GROUP BY doc_id"


def rounded_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = I.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") - 100).cast("int").alias("size"))
    return sizes.select("l_orderkey", "l_linenumber", "size", T.round_up(F.col("size")).cast("int").alias("rounded"))


ROUNDED_SQL = "SELECT l_orderkey, l_linenumber, (l_partkey - 100)::INTEGER AS size, CASE WHEN l_partkey <= 100 THEN 64 ELSE greatest(64, least(1024, (l_partkey - 100 + 63) // 64 * 64)) END::INTEGER AS rounded FROM lineitem"

# ---------------------------------------------------------------- rules over pages


def rewritten_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a text at their end on which one of the rules fires, but for every fifth; the changed ones."""
    table = rules.rule_table()
    triggers = F.array(*(F.lit(r.sql_trigger()) for r in table))
    html = F.concat("html", F.when(F.col("page_id") % 5 == 0, "").otherwise(F.concat(F.lit(" "), F.get(triggers, (F.col("page_id") % len(table)).cast("int")), F.lit(" б"))))
    return rules.rewrite_html(I.spread(I.table(spark, sf_dir, "pages").select("page_id", html.alias("html")), "page_id"))


def _rewritten_sql() -> str:
    listed = ", ".join(quote(r.sql_trigger()) for r in rules.rule_table())
    derived = f"triggered AS (SELECT page_id AS doc_id, html || CASE WHEN page_id % 5 = 0 THEN '' ELSE ' ' || [{listed}][1 + page_id % {len(rules.rule_table())}] || ' б' END AS text FROM pages)"
    folded = Q._rules_sql("text").replace(f"WITH {I.triggered_sql()}", f"WITH {derived}")
    return f"SELECT f.doc_id AS page_id, f.text AS html FROM ({folded}) f JOIN (WITH {derived} SELECT * FROM triggered) t USING (doc_id) WHERE f.text <> t.text"


# ---------------------------------------------------------------- runs of letters and short words


def _apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old texts with a space after every second letter of a word."""
    return I.old_texts(spark, sf_dir).select("doc_id", F.regexp_replace("text", "([а-я])([а-я])", "$1 $2").alias("text"))


_APART_CTE = f"{I.TEXTS_SQL}, apart AS (SELECT doc_id, regexp_replace(text, '([а-я])([а-я])', '\\1 \\2', 'g') AS text FROM texts)"


def spaced_letters_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _apart(spark, sf_dir).select("doc_id", T.join_spaced_letters(F.col("text")).alias("text"))


def _runs_cte(source: str, name: str, piece: str, whole: str, gap: str, joined: str) -> str:
    """Texts of `source` in which runs of pieces like `whole`, divided by gaps like `gap`, are replaced by `joined` (of r: texts, gaps and their number)."""
    return f"""{name}_p AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS k, unnest(p) AS x FROM (SELECT doc_id, regexp_extract_all(text, '{piece}') AS p FROM {source})),
{name}_f AS (SELECT *, regexp_full_match(x, '{whole}') AS own, regexp_full_match(x, '{gap}') AS gap, lag(x) OVER w AS b, lead(x) OVER w AS n FROM {name}_p WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
{name}_l AS (SELECT *, own OR (gap AND coalesce(regexp_full_match(b, '{whole}'), false) AND coalesce(regexp_full_match(n, '{whole}'), false)) AS linked FROM {name}_f),
{name}_g AS (SELECT *, sum((NOT linked)::INTEGER) OVER (PARTITION BY doc_id ORDER BY k) AS g FROM {name}_l),
{name}_r AS (SELECT doc_id, g, linked, min(k) AS k, list(x ORDER BY k) AS parts, list(x ORDER BY k) FILTER (WHERE own) AS own FROM {name}_g GROUP BY doc_id, g, linked),
{name} AS (SELECT t.doc_id, coalesce(r.text, '') AS text FROM {source} t LEFT JOIN (SELECT doc_id, string_agg(CASE WHEN linked THEN {joined} ELSE array_to_string(parts, '') END, '' ORDER BY k) AS text FROM {name}_r GROUP BY doc_id) r USING (doc_id))"""


def _spaced_cte(source: str, name: str) -> str:
    return _runs_cte(source, name, r"\S+|\s", "[А-ЯЁа-яё]", r"\s", "CASE WHEN len(own) >= 3 THEN array_to_string(list_filter(parts, lambda x: x <> ' '), '') ELSE array_to_string(parts, '') END")


def _gaps_cte(source: str, name: str) -> str:
    return _runs_cte(source, name, r"[\p{L}\p{N}_-]+|[^\p{L}\p{N}_-]+", "[А-ЯЁа-яё]+", r"\s+", "CASE WHEN len(own) >= 2 AND len(list_filter(own, lambda x: length(x) > 2)) <= 1 AND length(array_to_string(own, '')) >= 4 THEN array_to_string(own, '') ELSE array_to_string(parts, '') END")


SPACED_SQL = f"WITH {_APART_CTE}, {_spaced_cte('apart', 'done')} SELECT doc_id, text FROM done"


def _gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old texts with a space after every second letter but in long words."""
    return I.old_texts(spark, sf_dir).select("doc_id", F.regexp_replace("text", "([а-я]{2})([а-я])", "$1 $2").alias("text"))


_GAPPED_CTE = f"{I.TEXTS_SQL}, gapped AS (SELECT doc_id, regexp_replace(text, '([а-я]{{2}})([а-я])', '\\1 \\2', 'g') AS text FROM texts)"


def small_gaps_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gapped(spark, sf_dir).select("doc_id", T.close_small_gaps(F.col("text")).alias("text"))


SMALL_GAPS_SQL = f"WITH {_GAPPED_CTE}, {_gaps_cte('gapped', 'done')} SELECT doc_id, text FROM done"


def cleaned_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps of the post-cleaning, on texts with odd symbols, letters apart and misread prepositions."""
    return _apart(spark, sf_dir).select("doc_id", T.cleanup(Q._lit(F.col("text"), *Q.ODD[1:2], *Q.OCR)).alias("text"))


def _cleaned_sql() -> str:
    first = f"translate(replace(replace({Q._lit_sql('text', [*Q.ODD[1:2], *Q.OCR])}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '{T.ODD}', '{T.ODD_FOR}')"
    first = Q.sub(first, r"\s*—\s*", " — ")
    first = Q.again(first, rf"({Q.W})[-‑–—]\n({Q.W})", r"\1\2")
    first = Q.sub(Q.again(first, r"([^\n])\n([^\n])", r"\1 \2"), r"[ \t]{2,}", " ")
    mixed = Q.MIXED_SQL.split("SELECT doc_id, ", 2)[-1].rsplit(" AS text FROM texts", 1)[0]
    ocr = Q.OCR_SQL.split("SELECT doc_id, ", 2)[-1].rsplit(" AS text FROM texts", 1)[0].replace(Q._lit_sql("text", Q.OCR), "text")
    return f"WITH {_APART_CTE}, one AS (SELECT doc_id, {first} AS text FROM apart), {_spaced_cte('one', 'two')}, {_gaps_cte('two', 'three')}, four AS (SELECT doc_id, {ocr} AS text FROM three), five AS (SELECT doc_id, {mixed} AS text FROM four) SELECT doc_id, {Q.strip('text')} AS text FROM five"


# ---------------------------------------------------------------- flags


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.old_lines(spark, sf_dir).select("doc_id", F.col("block_id").alias("merged_id"), F.lit("paragraph").alias("role"), "text")


def flag_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flag: its type, letters and place."""
    found = flags.flag_blocks(_lines(spark, sf_dir)).select("doc_id", "block", F.explode("flags").alias("f"))
    return found.select("doc_id", "block", "f.type", F.col("f.from").alias("old"), F.col("f.to").alias("new"), "f.pos")


_G = flags._GROWTH
_TOKENS = r"regexp_extract_all(translate(text, 'ѣі', '||'), '[A-Za-z\x{0400}-\x{04FF}]+(?:-[A-Za-z\x{0400}-\x{04FF}]+)*')"
_MIXED = rf"list_filter({_TOKENS}, lambda t: regexp_matches(t, '[\x{{0400}}-\x{{04FF}}]') AND regexp_matches(t, '[A-Za-z]'))"
_LATIN = f"regexp_extract_all(array_to_string({_MIXED}, ''), '[{T.LATIN}]')"
FLAG_PLACES_SQL = f"""WITH {I.LINES_SQL}, letters AS (SELECT doc_id, block_id, unnest(range(length(text))) AS p, unnest(string_split(text, '')) AS c FROM lines WHERE text <> ''),
placed AS (SELECT *, coalesce(sum((c = 'ѣ')::INTEGER) OVER (PARTITION BY doc_id, block_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS yats FROM letters),
latin AS (SELECT doc_id, block_id, unnest({_LATIN}) AS c FROM lines)
SELECT doc_id, block_id::INTEGER AS block, 'yat' AS type, 'ѣ' AS old, 'е' AS new, p::INTEGER AS pos FROM placed WHERE c = 'ѣ'
UNION ALL SELECT doc_id, block_id::INTEGER, 'i', 'і', 'и', (p + {_G} * yats)::INTEGER FROM placed WHERE c = 'і'
UNION ALL SELECT doc_id, block_id::INTEGER, 'latin_to_cyr', c, translate(c, '{T.LATIN}', '{T.LOOKALIKE}'), NULL FROM latin"""


def flag_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag report of each document as JSON."""
    return render.flags_json(flags.flag_blocks(_lines(spark, sf_dir)))


_ONE_FLAG = """'{"type":"' || %s || '","from":"' || %s || '","to":"' || %s || '"' || %s || '}'"""
FLAG_REPORTS_SQL = f"""WITH {I.LINES_SQL}, letters AS (SELECT doc_id, block_id, unnest(range(length(text))) AS p, unnest(string_split(text, '')) AS c FROM lines WHERE text <> ''),
placed AS (SELECT *, coalesce(sum((c = 'ѣ')::INTEGER) OVER (PARTITION BY doc_id, block_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS yats FROM letters),
latin AS (SELECT doc_id, block_id, unnest(range(len(l))) AS p, unnest(l) AS c FROM (SELECT doc_id, block_id, {_LATIN} AS l FROM lines)),
one AS (SELECT doc_id, block_id, 1 AS pass, p, {_ONE_FLAG % ("'yat'", "'ѣ'", "'е'", "',\"pos\":' || p")} AS j FROM placed WHERE c = 'ѣ'
  UNION ALL SELECT doc_id, block_id, 2, p, {_ONE_FLAG % ("'i'", "'і'", "'и'", f"',\"pos\":' || (p + {_G} * yats)")} FROM placed WHERE c = 'і'
  UNION ALL SELECT doc_id, block_id, 3, p, {_ONE_FLAG % ("'latin_to_cyr'", "c", f"translate(c, '{T.LATIN}', '{T.LOOKALIKE}')", "''")} FROM latin),
per AS (SELECT doc_id, block_id, string_agg(j, ',' ORDER BY pass, p) AS j FROM one GROUP BY ALL)
SELECT doc_id, '[' || string_agg('{{"block":' || block_id || ',"role":"paragraph","flags":[' || coalesce(j, '') || ']}}', ',' ORDER BY block_id) || ']' AS json FROM lines LEFT JOIN per USING (doc_id, block_id) GROUP BY doc_id"""


def marked_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the flags' marks in the text, which is not escaped again."""
    marked = flags.flag_blocks(_lines(spark, sf_dir)).select("doc_id", F.col("block").alias("block_id"), "role", "text")
    return render.html(marked, "A & B", escape=False)


def _marked_sql() -> str:
    private = "".join(chr(0xE000 + k) for k in range(len(T.LATIN)))
    token = rf"CASE WHEN regexp_matches(t, '[\x{{0400}}-\x{{04FF}}]') AND regexp_matches(t, '[A-Za-z]') AND NOT regexp_matches(t, '^[^A-Za-z\x{{0400}}-\x{{04FF}}]') THEN translate(t, '{T.LATIN}', '{private}') ELSE t END"
    pieces = r"regexp_extract_all(translate(text, 'ѣі', chr(57600) || chr(57601)), '[A-Za-z\x{0400}-\x{04FF}]+(?:-[A-Za-z\x{0400}-\x{04FF}]+)*|[^A-Za-z\x{0400}-\x{04FF}]+')"
    text = f"array_to_string(list_transform({pieces}, lambda t: {token}), '')"
    for code, (old, new) in [(57600, ("ѣ", "е")), (57601, ("і", "и")), *((0xE000 + k, p) for k, p in enumerate(zip(T.LATIN, T.LOOKALIKE)))]:
        text = f"replace({text}, chr({code}), {quote(flags.mark(old, new))})"
    return f"WITH {I.LINES_SQL}, m AS (SELECT doc_id, block_id, {text} AS t FROM lines) SELECT doc_id, replace({quote(render.HEAD)}, '%s', 'A &amp; B') || string_agg('<p>' || t || '</p>', {N} ORDER BY block_id) || {quote(render.FOOT)} AS html FROM m GROUP BY doc_id"


# ---------------------------------------------------------------- spelling


def spell_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of two checkers in a row; the second finds what the first has left."""
    docs = I.spread(I.table(spark, sf_dir, "documents")).select("doc_id", F.replace(F.translate("text", "ab", "аб"), F.lit(". "), F.lit(".\n\n")).alias("text"))
    return spell.check_counts(spell.run_chunks(docs, [R._DoubleSpaces(), _Again()], 600))


class _Again(R._DoubleSpaces):
    name = "again"


SPELL_COUNTS_SQL = "SELECT 'double_spaces' AS checker, n AS matches, n AS applied FROM (SELECT sum((length(t) - length(replace(t, 'а б', ''))) // 3)::BIGINT AS n FROM (SELECT translate(text, 'ab', 'аб') AS t FROM documents)) UNION ALL SELECT 'again', 0, 0"

# ---------------------------------------------------------------- sentences and warnings


def sentence_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.span_rows(R._docs(spark, sf_dir)).select("doc_id", "sentence_id", "start_char", "end_char", F.size("tokens").alias("tokens"))


PLACES_SQL = f"""WITH {R.SENTENCES_CTE}, gaps AS (SELECT doc_id, unnest(range(len(g))) AS sentence_id, unnest(g) AS gap FROM (SELECT doc_id, list_append(list_transform(regexp_extract_all(text, '[.!?]\\s+'), lambda x: length(x) - 1), 0) AS g FROM docs)),
ends AS (SELECT doc_id, sentence_id, sentence, sum(length(sentence) + gap) OVER (PARTITION BY doc_id ORDER BY sentence_id) - gap AS e FROM sentences JOIN gaps USING (doc_id, sentence_id))
SELECT doc_id, sentence_id::INTEGER AS sentence_id, (e - length(sentence))::INTEGER AS start_char, e::INTEGER AS end_char, len(list_filter(regexp_extract_all(sentence, '[\\p{{L}}\\p{{M}}\\p{{N}}_'']+'), lambda t: regexp_matches(t, '[^'']')))::INTEGER AS tokens FROM ends"""


def rejoined_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken blocks with two spaces after every sentence, joined by one again; headings keep theirs."""
    blocks = I.broken_blocks(spark, sf_dir).withColumn("text", F.replace("text", F.lit(". "), F.lit(".  ")))
    return context.rejoin_sentences(blocks).select("doc_id", "block_id", "role", "text")


REJOINED_SQL = f"""WITH {I.BROKEN_SQL}, wide AS (SELECT doc_id, block_id, role, replace(text, '. ', '.  ') AS text FROM broken)
SELECT doc_id, block_id::INTEGER AS block_id, role, CASE WHEN role = 'heading' OR {Q.strip('text')} = '' THEN text ELSE
  array_to_string(list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: {Q.strip('s')}), lambda s: s <> ''), ' ') END AS text FROM wide"""


def _first_parses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old texts, and a lexicon of their frequent long words with two parses each, of which the first is not the least."""
    texts = I.old_texts(spark, sf_dir)
    words = spell.dictionary_words(texts).where("n >= 3 AND length(word) >= 6").select("word", F.lit("NOUN").alias("pos"))
    parse = lambda k, normal: words.select("word", "pos", normal.alias("normal"), F.lit(k).alias("ord"))
    return texts, parse(0, F.left("word", F.lit(6))).unionByName(parse(1, F.lit("а")))


def split_word_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, lexicon = _first_parses(spark, sf_dir)
    return context.split_word_warnings(texts, lexicon).select("doc_id", "sentence_id", "idx", "w1", "w2", "norm", "message")


_OLD_PAIRS = R.BIGRAM_CTE.replace("docs AS (SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents)", f"{I.TEXTS_SQL}, docs AS (SELECT doc_id, text FROM texts)")
SPLIT_NORMS_SQL = f"""WITH {_OLD_PAIRS}, lexicon AS (SELECT word, left(word, 6) AS norm FROM (SELECT lower(unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'))) AS word FROM texts) WHERE regexp_full_match(word, '[а-яё]+') GROUP BY word HAVING count(*) >= 3 AND length(word) >= 6),
joined AS (SELECT doc_id, sentence_id, idx, t, t[idx + 1] AS w1, t[idx + 2] AS w2, lower(regexp_replace(t[idx + 1] || t[idx + 2], '[^А-Яа-яёЁ]', '', 'g')) AS j FROM pairs WHERE length(t[idx + 1]) + length(t[idx + 2]) >= 5)
SELECT doc_id, sentence_id::INTEGER AS sentence_id, idx::INTEGER AS idx, w1, w2, l.norm, 'Похоже, что «' || w1 || ' ' || w2 || '» в «' || array_to_string(t[greatest(idx, 1):idx + 3], ' ') || '» должно быть «' || j || '» (норма: ' || l.norm || '). Рассмотрите склейку.' AS message
FROM joined JOIN lexicon l ON l.word = j WHERE NOT EXISTS (FROM lexicon x WHERE x.word IN (lower(w1), lower(w2)) AND x.norm = l.norm)"""


SPLIT_WORDS_SQL = SPLIT_NORMS_SQL.split(", 'Похоже")[0] + " " + SPLIT_NORMS_SQL[SPLIT_NORMS_SQL.index("FROM joined JOIN") :]


def warning_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of each document, with a line for every pair that stands out."""
    docs = R._docs(spark, sf_dir)
    return context.report(docs, context.pronoun_warnings(docs, R._lexicon(spark, sf_dir), R._PRONOUNS))


WARNINGS_SQL = R.PRONOUN_SQL.replace("SELECT doc_id, sentence_id::INTEGER AS sentence_id,", f"SELECT doc_id, sentence_id, (SELECT {Q.strip('s.sentence')} FROM sentences s WHERE s.doc_id = pairs.doc_id AND s.sentence_id = pairs.sentence_id) AS sentence,", 1)
WARNINGS_SQL = f"""WITH found AS ({WARNINGS_SQL}), lines AS (SELECT doc_id, string_agg('Пара ' || w1 || ' + ' || w2 || ' в предложении «' || sentence || '» (' || snippet || ') выглядит неправильно: ' || w2 || ' не распознан как глагол.', {N} ORDER BY sentence_id, idx) AS report FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(report, {quote(context.NO_WARNINGS)}) AS report FROM documents d LEFT JOIN lines USING (doc_id)"""

# ---------------------------------------------------------------- entities


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Texts, and the same with some letters changed."""
    texts = I.spread(I.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return texts, texts.withColumn("text", F.replace(F.replace("text", F.lit("Th"), F.lit("TH")), F.lit("In"), F.lit("Un")))


def entity_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of the types of a written list."""
    return entities.extract(_versions(spark, sf_dir)[0], "source", entities.parse_types(" per, ,Loc"))


_MARKED = "regexp_replace(%s, '([\\p{L},]) ', '\\1 ' || chr(1), 'g')"
_FOUND = "list_transform(regexp_extract_all(%s, '\\x01\\p{Lu}\\p{Ll}{3,}'), lambda w: substr(w, 2))"
_NAMES = "SELECT doc_id, unnest(range(len(l))) AS ord, unnest(l) AS text FROM (SELECT doc_id, " + _FOUND % (_MARKED % "%s") + " AS l FROM documents)"
MENTIONS_SQL = f"SELECT doc_id, 'source' AS side, ord::INTEGER AS ord, text, lower(text) AS normal, 'PER' AS type FROM ({_NAMES % 'text'})"


def entity_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document's two versions name differently, as a report a document."""
    texts, changed = _versions(spark, sf_dir)
    return entities.difference_report(texts, entities.difference(entities.extract(texts, "source"), entities.extract(changed, "clean")))


_CHANGED = "replace(replace(text, 'Th', 'TH'), 'In', 'Un')"
_BOTH = f"ka AS (SELECT doc_id, lower(text) AS normal, arg_max(text, ord) AS text FROM ({_NAMES % 'text'}) GROUP BY ALL), kb AS (SELECT doc_id, lower(text) AS normal, arg_max(text, ord) AS text FROM ({_NAMES % _CHANGED}) GROUP BY ALL)"
_LINE = "string_agg('- PER: ' || normal || ' (' || text || ')', chr(10) ORDER BY encode(normal))"
ENTITY_REPORTS_SQL = f"""WITH {_BOTH}, gone AS (SELECT doc_id, {_LINE} AS lines FROM ka ANTI JOIN kb USING (doc_id, normal) GROUP BY doc_id), come AS (SELECT doc_id, {_LINE} AS lines FROM kb ANTI JOIN ka USING (doc_id, normal) GROUP BY doc_id)
SELECT d.doc_id, coalesce({quote(entities.ONLY_SOURCE)} || {N} || g.lines, {quote(entities.NONE_GONE)}) || {N} || {N} || coalesce({quote(entities.ONLY_CLEAN)} || {N} || c.lines, {quote(entities.NONE_NEW)}) AS report
FROM documents d LEFT JOIN gone g USING (doc_id) LEFT JOIN come c USING (doc_id)"""

_PAIRS = (("the", "THE"), ("THEr", "ther"), ("", "x"), ("ion", "iOn"))


def sync_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit("PER").alias("type"), F.lit(a).alias("old"), F.lit(b).alias("new")) for a, b in _PAIRS))
    done = I.spread(I.table(spark, sf_dir, "documents")).select("doc_id", replace_in_order(F.col("text"), pairs).alias("d"))
    return entities.sync_report(done.select("doc_id", F.col("d.applied").alias("applied")))


_ENTRY = "CASE WHEN n%d > 0 THEN {'o': %d, 't': '- PER: %s → %s (заменено ' || n%d || ' раз)'} END"
_ENTRIES = ", ".join(_ENTRY % (k, k, a, b, k) for k, (a, b) in enumerate((("the", "THE"), ("THEr", "ther"), ("ion", "iOn"))))
SYNC_REPORTS_SQL = f"""WITH s1 AS (SELECT doc_id, text AS t0, replace(text, 'the', 'THE') AS t1 FROM documents), s2 AS (SELECT *, replace(t1, 'THEr', 'ther') AS t2 FROM s1),
counted AS (SELECT doc_id, (length(t0) - length(replace(t0, 'the', ''))) // 3 AS n0, (length(t1) - length(replace(t1, 'THEr', ''))) // 4 AS n1, (length(t2) - length(replace(t2, 'ion', ''))) // 3 AS n2 FROM s2),
listed AS (SELECT doc_id, list_transform(list_filter([{_ENTRIES}], lambda x: x IS NOT NULL), lambda x: x.t) AS l FROM counted)
SELECT doc_id, CASE WHEN len(l) = 0 THEN {quote(entities.NOTHING_APPLIED)} ELSE {quote(entities.APPLIED)} || {N} || array_to_string(l, {N}) END AS report FROM listed"""

# ---------------------------------------------------------------- renderers and packages


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's blocks as one JSON object, read back for the comparison: its file name and blocks."""
    made = render.structured_json(I.broken_blocks(spark, sf_dir), "book.pdf")
    rows = made.select("doc_id", F.get_json_object("json", "$.file").alias("file"), F.posexplode(readers.json_blocks(F.col("json"))).alias("block_id", "b"))
    return rows.select("doc_id", "file", "block_id", "b.role", "b.text")


JSON_DOCUMENTS_SQL = f"WITH {I.BROKEN_SQL} SELECT doc_id, 'book.pdf' AS file, block_id::INTEGER AS block_id, role, text FROM broken"
_ESC = "replace(replace(replace(replace(replace(%s, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
_HEAD, _FOOT = quote(render.HEAD), quote(render.FOOT)


def pre_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "documents").select("doc_id", render.pre_html(F.col("text"), "A < B").alias("html"))


PRE_SQL = f"SELECT doc_id, replace({_HEAD}, '%s', 'A &lt; B') || '<pre>' || {_ESC % 'text'} || '</pre>' || {_FOOT} AS html FROM documents"


def paragraph_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit(". "), F.lit(".\n \n")).alias("text"))
    return docs.select("doc_id", render.paragraphs_html(F.col("text"), "A").alias("html"))


PARAGRAPHS_SQL = f"""WITH parts AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(replace(text, '. ', '.' || {N} || ' ' || {N}), '\\n\\s*\\n', chr(1), 'g'), chr(1)), lambda p: {Q.strip('p')}), lambda p: p <> '') AS p FROM documents)
SELECT doc_id, replace({_HEAD}, '%s', 'A') || array_to_string(list_transform(p, lambda x: '<p>' || {_ESC % 'x'} || '</p>'), {N}) || {_FOOT} AS html FROM parts"""


def title_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "pages").select("page_id", render.patch_title_page(F.concat(F.lit("<h2 class='a'>old\nname</h2>"), "html"), "Cost $1", "A \\ B").alias("html"))


TITLE_SQL = r"SELECT page_id, regexp_replace(regexp_replace('<h2 class=''a''>old' || chr(10) || 'name</h2>' || html, '(?is)(<h1[^>]*>).*?(</h1>)', '\1Cost $1\2', 'g'), '(?is)(<h2[^>]*>).*?(</h2>)', '\1A \\ B\2', 'g') AS html FROM pages"


def _chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = I.broken_blocks(spark, sf_dir).withColumn("role", F.when(F.col("block_id") % 11 == 5, "heading").otherwise("paragraph"))
    return chapters.split_chapters(blocks, 1)


def chapter_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.chapter_xhtml(_chapters(spark, sf_dir))


_XHTML = '<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE html>\n<html xmlns="http://www.w3.org/1999/xhtml" lang="ru">\n<head><title>'
_PAGES_CTE = f"""chaptered AS ({Q.CHAPTERS_SQL}), {I.BROKEN_SQL},
body AS (SELECT c.doc_id, c.chapter_id, c.block_id, c.title, b.block_id % 11 = 5 AS h, {_ESC % 'b.text'} AS t FROM chaptered c JOIN broken b ON b.doc_id = c.doc_id AND b.block_id = c.block_id),
pages_ AS (SELECT doc_id, chapter_id, min(title) AS title, {quote(_XHTML)} || {_ESC % 'min(title)'} || '</title></head>' || {N} || '<body>' || {N} || CASE WHEN arg_min(h, block_id) THEN '' ELSE '<h2>' || {_ESC % 'min(title)'} || '</h2>' || {N} END ||
  string_agg(CASE WHEN h THEN '<h2>' || t || '</h2>' ELSE '<p>' || t || '</p>' END, {N} ORDER BY block_id) || {N} || '</body>' || {N} || '</html>' || {N} AS xhtml FROM body GROUP BY doc_id, chapter_id)"""
CHAPTER_PAGES_SQL = f"WITH {_PAGES_CTE} SELECT doc_id, chapter_id::INTEGER AS chapter_id, title, xhtml FROM pages_"


def package_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of every document's package, in order, read from the archives."""
    return epub.package_files(epub.packages(chapter_pages(spark, sf_dir), "Book & Co", "Author"))


_ID = uuid.uuid5(uuid.NAMESPACE_URL, "Book & Co\nAuthor")
_OPF = epub.package_document("Book & Co", "Author", "2000-01-01T00:00:00Z", [], str(_ID))
_NCX = epub.navigation("Book & Co", [], str(_ID))


def _package_sql() -> str:
    opf_a, rest = _OPF.split("</manifest>")
    opf_b, opf_c = rest.split("</spine>")
    ncx_a, ncx_b = _NCX.split("</navMap>")
    label = _ESC % "title"
    return f"""WITH {_PAGES_CTE}, numbered AS (SELECT *, chapter_id + 1 AS k, 'Chapter' || lpad((chapter_id + 1)::VARCHAR, 4, '0') || '.xhtml' AS name FROM pages_),
made AS (SELECT doc_id, 'mimetype' AS name, true AS stored, 'application/epub+zip' AS content, 0 AS first FROM numbered GROUP BY doc_id
  UNION ALL SELECT doc_id, 'META-INF/container.xml', false, {quote(epub.CONTAINER)}, 1 FROM numbered GROUP BY doc_id
  UNION ALL SELECT doc_id, 'OEBPS/content.opf', false, {quote(opf_a)} || string_agg('<item id="c' || k || '" href="' || name || '" media-type="application/xhtml+xml"/>', '' ORDER BY k) || {quote("</manifest>" + opf_b)} || string_agg('<itemref idref="c' || k || '"/>', '' ORDER BY k) || {quote("</spine>" + opf_c)}, 1 FROM numbered GROUP BY doc_id
  UNION ALL SELECT doc_id, 'OEBPS/toc.ncx', false, {quote(ncx_a)} || string_agg('<navPoint id="n' || k || '" playOrder="' || k || '"><navLabel><text>' || {label} || '</text></navLabel><content src="' || name || '"/></navPoint>', '' ORDER BY k) || {quote("</navMap>" + ncx_b)}, 1 FROM numbered GROUP BY doc_id
  UNION ALL SELECT doc_id, 'OEBPS/' || name, false, xhtml, 1 FROM numbered)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY first, encode(name)) - 1)::INTEGER AS place, name, stored, content FROM made"""


# ---------------------------------------------------------------- the whole core


def _core_sql() -> str:
    """Rules, line breaks, punctuation and merging of broken blocks; blocks, characters and replacements of each document."""
    folded = Q._rules_sql("text").replace(f"WITH {I.triggered_sql()} SELECT doc_id, s.t AS text", "SELECT doc_id, block_id, role, s.t AS text, s.n AS n").replace("FROM (SELECT doc_id,", "FROM (SELECT doc_id, block_id, role,").replace("FROM triggered)", "FROM broken)")
    breaks = Q.sub(Q.again(Q.again("text", rf"({Q.W})[-‑–—]\n({Q.W})", r"\1\2"), r"([^\n])\n([^\n])", r"\1 \2"), r"[ \t]{2,}", " ")
    normal = Q._punct_sql(Q.strip(breaks))
    merged = Q._MERGED_CTE.replace(f"{I.BROKEN_SQL},", f"{I.BROKEN_SQL}, ruled AS ({folded}), punctuated AS (SELECT doc_id, block_id, role, n, {normal} AS text FROM ruled),", 1).replace("AS text FROM broken)", "AS text FROM punctuated)")
    return f"WITH {merged}, sizes AS (SELECT doc_id, count(*) AS blocks, sum(length(text))::BIGINT AS chars FROM merged GROUP BY doc_id), counts AS (SELECT doc_id, sum(n)::BIGINT AS rules_applied FROM ruled GROUP BY doc_id) SELECT * FROM sizes JOIN counts USING (doc_id)"


QUERIES = {
    "structured_pages": structured_pages, "page_texts": page_texts, "rounded_sizes": rounded_sizes, "rewritten_html": rewritten_html, "spaced_letters_joined": spaced_letters_joined, "small_gaps_closed": small_gaps_closed,
    "cleaned_texts": cleaned_texts, "flag_places": flag_places, "flag_reports": flag_reports, "marked_html": marked_html, "spell_counts": spell_counts, "sentence_places": sentence_places, "rejoined_blocks": rejoined_blocks,
    "split_word_norms": split_word_norms, "warning_reports": warning_reports, "entity_mentions": entity_mentions, "entity_reports": entity_reports, "sync_reports": sync_reports, "json_documents": json_documents,
    "pre_pages": pre_pages, "paragraph_pages": paragraph_pages, "title_pages": title_pages, "chapter_pages": chapter_pages, "package_files": package_files,
}

ORACLES = {
    "structured_pages": STRUCTURED_SQL, "page_texts": PAGE_TEXTS_SQL, "rounded_sizes": ROUNDED_SQL, "rewritten_html": _rewritten_sql(), "spaced_letters_joined": SPACED_SQL, "small_gaps_closed": SMALL_GAPS_SQL,
    "cleaned_texts": _cleaned_sql(), "flag_places": FLAG_PLACES_SQL, "flag_reports": FLAG_REPORTS_SQL, "marked_html": _marked_sql(), "spell_counts": SPELL_COUNTS_SQL, "sentence_places": PLACES_SQL, "rejoined_blocks": REJOINED_SQL,
    "split_word_norms": SPLIT_NORMS_SQL, "split_words": SPLIT_WORDS_SQL, "warning_reports": WARNINGS_SQL, "entity_mentions": MENTIONS_SQL, "entity_reports": ENTITY_REPORTS_SQL, "sync_reports": SYNC_REPORTS_SQL, "json_documents": JSON_DOCUMENTS_SQL,
    "pre_pages": PRE_SQL, "paragraph_pages": PARAGRAPHS_SQL, "title_pages": TITLE_SQL, "chapter_pages": CHAPTER_PAGES_SQL, "package_files": _package_sql(), "pipeline_core": _core_sql(),
}
