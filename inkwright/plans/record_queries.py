"""Queries and SQL of layout, spelling, context, entity and source operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.functions.folds import patched, replace_in_order
from inkwright.operators import context, entities, layout, spell
from inkwright.plans import inputs as I  # noqa: E741
from inkwright.sources import readers

# ---------------------------------------------------------------- layout


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with whole numbers for sizes and places, from order lines: an order is a page."""
    li = I.table(spark, sf_dir, "lineitem")
    x0 = (F.col("l_partkey") % 400).cast("double")
    return li.select(
        (F.col("l_orderkey") % 500).alias("doc_id"), F.col("l_orderkey").alias("page"), F.lit(600.0).alias("width"), F.col("l_linenumber").alias("block_ord"), F.col("l_returnflag").alias("text"),
        F.col("l_quantity").alias("wsize"), (F.col("l_suppkey") % 5).cast("int").alias("line_count"), (F.col("l_partkey") % 300).alias("chars"),
        F.array(x0, (F.col("l_suppkey") % 50).cast("double"), x0 + F.col("l_quantity") * 4, F.lit(900.0)).alias("bbox"),
    )


def page_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.with_roles(_pages(spark, sf_dir)).select("doc_id", "page", "block_ord", "median", "role")


def reading_order_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.reading_order(_pages(spark, sf_dir)).select("doc_id", "page", "block_ord", "place")


def reading_order_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.reading_order(_pages(spark, sf_dir), two_columns=True).select("doc_id", "page", "block_ord", "place")


_PAGES_SQL = """pages_ AS (SELECT l_orderkey % 500 AS doc_id, l_orderkey AS page, l_linenumber AS block_ord, l_quantity AS wsize, l_suppkey % 5 AS line_count, l_partkey % 300 AS chars,
  (l_partkey % 400)::DOUBLE AS x0, (l_suppkey % 50)::DOUBLE AS y0, (l_partkey % 400)::DOUBLE + l_quantity * 4 AS x1 FROM lineitem)"""
ROLES_SQL = f"""WITH {_PAGES_SQL}, med AS (SELECT page, list_sort(list(wsize))[len(list(wsize)) // 2 + 1] AS median FROM pages_ GROUP BY page)
SELECT doc_id, page, block_ord, median, CASE WHEN (wsize >= median * 1.35 + 0.5 AND line_count <= 3 AND chars <= 200)
  OR (abs((x0 + x1) / 2 - 300) < 600 * 0.12::DOUBLE AND line_count <= 3 AND chars <= 200 AND NOT x1 - x0 > 600 * 0.45::DOUBLE) THEN 'heading' ELSE 'paragraph' END AS role FROM pages_ JOIN med USING (page)"""
ONE_SQL = f"WITH {_PAGES_SQL} SELECT doc_id, page, block_ord, (row_number() OVER (PARTITION BY doc_id, page ORDER BY y0, x0, block_ord) - 1)::INTEGER AS place FROM pages_"
TWO_SQL = f"WITH {_PAGES_SQL} SELECT doc_id, page, block_ord, (row_number() OVER (PARTITION BY doc_id, page ORDER BY (x0 + x1) / 2 >= 300, y0, block_ord) - 1)::INTEGER AS place FROM pages_"


def weighted_font(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans gathered into blocks: text and mean size of each order's lines."""
    li = I.table(spark, sf_dir, "lineitem")
    span = F.struct("l_linenumber", F.struct(F.concat("l_returnflag", F.repeat(F.lit("x"), (F.col("l_partkey") % 7).cast("int"))).alias("text"), F.when(F.col("l_suppkey") % 9 == 0, 0.0).otherwise(F.col("l_quantity")).alias("size")).alias("s"))
    lines = F.transform(F.array_sort(F.collect_list(span)), lambda x: F.struct(F.array(x["s"]).alias("spans")))
    blocks = li.groupBy("l_orderkey").agg(lines.alias("lines"))
    pages = blocks.select(F.col("l_orderkey").cast("string").alias("doc_id"), F.lit(1).alias("page"), F.lit(600.0).alias("width"), F.array(F.struct(F.lit(0).alias("type"), F.array(*[F.lit(0.0)] * 4).alias("bbox"), "lines")).alias("blocks"))
    return layout.page_blocks(pages).select("doc_id", "text", "wsize", "line_count", "chars")


FONT_SQL = """
SELECT l_orderkey::VARCHAR AS doc_id, string_agg(l_returnflag || repeat('x', (l_partkey % 7)::INTEGER), ' ' ORDER BY l_linenumber, l_returnflag || repeat('x', (l_partkey % 7)::INTEGER)) AS text,
  sum(l_quantity * (1 + l_partkey % 7)) FILTER (WHERE l_suppkey % 9 <> 0) / sum(1 + l_partkey % 7) FILTER (WHERE l_suppkey % 9 <> 0) AS wsize, count(*)::INTEGER AS line_count,
  sum(1 + l_partkey % 7) FILTER (WHERE l_suppkey % 9 <> 0)::BIGINT AS chars
FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (WHERE l_suppkey % 9 <> 0) > 0
"""

# ---------------------------------------------------------------- spelling


def _with_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with matches that overlap, lack replacements, lie beyond the end or have rules of several kinds."""
    rule = lambda i: F.element_at(F.array(*map(F.lit, ("MORFOLOGIK_RULE", "Style", "multiple_spaces", "COMMA", None))), (i % 5 + 1).cast("int"))
    match = lambda i: F.struct((i * 7 + F.col("doc_id") % 5).cast("int").alias("offset"), (i % 4 + 3 + i % 3 * 4).cast("int").alias("length"), F.when(i % 4 == 1, F.array().cast("array<struct<value:string>>")).otherwise(F.array(F.struct(F.concat(F.lit("X"), i.cast("string")).alias("value")))).alias("replacements"), F.struct(rule(i).alias("id"), F.lit("").alias("description")).alias("rule"))
    docs = I.spread(I.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.withColumn("matches", F.transform(F.sequence(F.lit(0), F.lit(9)), match))


def safe_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_matches(spark, sf_dir).select("doc_id", F.size(spell.safe_matches(F.col("matches"))).alias("safe"))


def patched_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _with_matches(spark, sf_dir).select("doc_id", patched(F.col("text"), F.col("matches")).alias("done"))
    return done.select("doc_id", "done.text", F.col("done.n").alias("applied"))


_IDS = "['MORFOLOGIK_RULE', 'Style', 'multiple_spaces', 'COMMA', NULL]"
SAFE_SQL = f"SELECT doc_id, len(list_filter(range(10), lambda i: regexp_matches(upper(coalesce({_IDS}[i % 5 + 1], '')), '{'|'.join(spell.SAFE)}')))::INTEGER AS safe FROM documents"
PATCH_SQL = """
WITH m AS (SELECT doc_id, text, list_transform(range(10), lambda i: {'o': i * 7 + doc_id % 5, 'l': i % 4 + 3 + i % 3 * 4, 'v': CASE WHEN i % 4 <> 1 THEN 'X' || i END, 't': '', 'a': 0}) AS ms FROM documents),
d AS (SELECT doc_id, text, list_reduce(ms, lambda acc, x: CASE WHEN x.o >= acc.o AND x.v IS NOT NULL
  THEN {'o': x.o + x.l, 'l': 0, 'v': '', 't': acc.t || substr(text, acc.o + 1, x.o - acc.o) || x.v, 'a': acc.a + 1} ELSE acc END, {'o': 0, 'l': 0, 'v': '', 't': '', 'a': 0}) AS s FROM m)
SELECT doc_id, s.t || substr(text, s.o + 1) AS text, CASE WHEN text IS NULL THEN 0 ELSE s.a END::INTEGER AS applied FROM d
"""


def word_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of old texts that the dictionary lacks, however rare, and the nearest of the frequent ones."""
    words = spell.dictionary_words(I.old_texts(spark, sf_dir))
    dictionary = words.where("n >= 100").select(F.col("word").alias("term"), F.col("n").alias("freq"))
    return spell.corrections(words, dictionary, prefix=0)


#: DuckDB counts edits in bytes: each letter becomes one byte.
_LOWER, _ASCII = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456"

_BYTES = f"translate(%s, '{_LOWER}', '{_ASCII}')"
_PIECES_CTE = f"""{I.TEXTS_SQL}, pieces AS (SELECT doc_id, unnest(range(len(p))) AS k, unnest(p) AS x FROM (SELECT doc_id, regexp_extract_all(text, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+|[^\\p{{L}}\\p{{M}}\\p{{N}}_]+') AS p FROM texts)),
words AS (SELECT lower(x) AS word, count(*) AS n FROM pieces WHERE regexp_full_match(x, '[А-Яа-яёЁ]+') GROUP BY 1)"""


def _fixes_cte(frequent: int) -> str:
    """The nearest of the words seen at least so often, for every other word."""
    return f"""dict AS (SELECT word AS term, n AS freq FROM words WHERE n >= {frequent}),
near AS (SELECT word, term, freq, levenshtein({_BYTES % 'word'}, {_BYTES % 'term'}) AS d FROM words JOIN dict ON abs(length(word) - length(term)) <= 2 WHERE n < {frequent}),
fixes AS (SELECT word, term FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY d, freq DESC, encode(term)) AS r FROM near WHERE d <= 2) WHERE r = 1)"""


CORRECTIONS_SQL = f"WITH {_PIECES_CTE}, {_fixes_cte(100)} SELECT word, term AS fixed FROM fixes"
CORRECTED_SQL = f"""WITH {_PIECES_CTE}, {_fixes_cte(200)},
fixed AS (SELECT doc_id, k, x, CASE WHEN regexp_matches(x, '^[А-ЯЁ]') THEN upper(left(term, 1)) || lower(substr(term, 2)) ELSE term END AS y FROM pieces LEFT JOIN fixes ON lower(x) = word AND regexp_full_match(x, '[А-Яа-яёЁ]+')),
joined AS (SELECT doc_id, string_agg(coalesce(y, x), '' ORDER BY k) AS text, count(y)::INTEGER AS n FROM fixed GROUP BY doc_id)
SELECT t.doc_id, coalesce(j.text, t.text) AS text, coalesce(n, 0) AS matches, coalesce(n, 0) AS applied FROM texts t LEFT JOIN joined j USING (doc_id)"""


def corrected_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = I.old_texts(spark, sf_dir)
    dictionary = spell.dictionary_words(texts).where("n >= 200").select(F.col("word").alias("term"), F.col("n").alias("freq"))
    return spell.correct(texts, dictionary, prefix=0)


class _DoubleSpaces:
    name = "double_spaces"

    def check(self, text: str) -> list[dict]:
        found, at = [], text.find("а б")
        while at >= 0:
            found.append({"offset": at + 1, "length": 1, "replacements": [{"value": "  "}], "rule": {"id": "MULTIPLE_SPACES"}})
            at = text.find("а б", at + 1)
        return found


def spell_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts through chunking, a checker, the safe rules and patching, and back together."""
    docs = I.spread(I.table(spark, sf_dir, "documents")).select("doc_id", F.replace(F.translate("text", "ab", "аб"), F.lit(". "), F.lit(".\n\n")).alias("text"))
    return spell.whole_texts(spell.run_chunks(docs, [_DoubleSpaces()], 600))


SPELL_RUN_SQL = "SELECT doc_id, regexp_replace(replace(translate(text, 'ab', 'аб'), '. ', '.' || chr(10) || chr(10)), 'а б', 'а  б', 'g') || chr(10) || chr(10) AS text FROM documents"

# ---------------------------------------------------------------- sentences and context


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.spread(I.table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("text")))


def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.sentence_rows(_docs(spark, sf_dir)).select("doc_id", "sentence_id", "sentence", F.size("tokens").alias("tokens"))


def bigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = context.bigrams(context.sentence_rows(_docs(spark, sf_dir)))
    return pairs.groupBy("w1", "w2").agg(F.count("*").alias("n"))


def _lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in for a dictionary of forms: kinds and normal forms by the length of a word."""
    words = I.table(spark, sf_dir, "benchmark").select(F.explode(context.words(F.lower("text"))).alias("word")).distinct()
    kind = F.get(F.array(*map(F.lit, ("VERB", "NOUN", "NPRO"))), (F.length("word") % 3).cast("int"))
    return words.select("word", kind.alias("pos"), F.left("word", F.lit(5)).alias("normal"))


_PRONOUNS = ("of", "and", "there")


def pronoun_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = context.pronoun_warnings(_docs(spark, sf_dir), _lexicon(spark, sf_dir), _PRONOUNS)
    return found.select("doc_id", "sentence_id", "idx", "w1", "w2", "snippet")


def split_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of old-letter words; the lexicon holds words of the same texts."""
    texts = I.old_texts(spark, sf_dir)
    words = spell.dictionary_words(texts).where("n >= 3 AND length(word) >= 6").select("word", F.lit("NOUN").alias("pos"), F.left("word", F.lit(6)).alias("normal"))
    return context.split_word_warnings(texts, words).select("doc_id", "sentence_id", "idx", "w1", "w2", "norm")


SENTENCES_CTE = r"""docs AS (SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents),
marked AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS p FROM docs),
sentences AS (SELECT doc_id, unnest(range(len(p))) AS sentence_id, unnest(p) AS sentence FROM marked)"""
SPLIT_SQL = f"WITH {SENTENCES_CTE} SELECT doc_id, sentence_id::INTEGER AS sentence_id, sentence, len(list_filter(regexp_extract_all(sentence, '[\\p{{L}}\\p{{M}}\\p{{N}}_'']+'), lambda t: regexp_matches(t, '[^'']')))::INTEGER AS tokens FROM sentences"
BIGRAM_CTE = f"""{SENTENCES_CTE}, tokens AS (SELECT doc_id, sentence_id, list_transform(list_filter(regexp_extract_all(sentence, '[\\p{{L}}\\p{{M}}\\p{{N}}_'']+'), lambda t: regexp_matches(t, '[^'']')), lambda t: trim(t, '''')) AS t FROM sentences),
pairs AS (SELECT doc_id, sentence_id, t, unnest(range(len(t) - 1)) AS idx FROM tokens WHERE len(t) > 1)"""
BIGRAMS_SQL = f"WITH {BIGRAM_CTE} SELECT t[idx + 1] AS w1, t[idx + 2] AS w2, count(*) AS n FROM pairs GROUP BY ALL"
LEXICON_CTE = r"""lexicon AS (SELECT word, ['VERB', 'NOUN', 'NPRO'][1 + length(word) % 3] AS pos, left(word, 5) AS normal FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+')) AS word FROM benchmark))"""
PRONOUN_SQL = f"""WITH {BIGRAM_CTE}, {LEXICON_CTE}
SELECT doc_id, sentence_id::INTEGER AS sentence_id, idx::INTEGER AS idx, t[idx + 1] AS w1, t[idx + 2] AS w2, array_to_string(t[greatest(idx, 1):idx + 3], ' ') AS snippet FROM pairs
WHERE (lower(t[idx + 1]) IN {_PRONOUNS} OR EXISTS (FROM lexicon WHERE word = lower(t[idx + 1]) AND pos = 'NPRO' AND normal IN {_PRONOUNS}))
  AND NOT EXISTS (FROM lexicon WHERE word = lower(t[idx + 2]) AND pos IN ('VERB', 'INFN'))"""

# ---------------------------------------------------------------- entities


_NAME = "[A-Z][a-z]{2,}"


def _mentions(spark: SparkSession, sf_dir: str, odd: int) -> DataFrame:
    """Capitalised words of the documents with even or odd ids, by language: the two sides of a comparison."""
    docs = I.table(spark, sf_dir, "documents").where(F.col("doc_id") % 2 == odd)
    found = docs.select("lang", "doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(_NAME), 0)).alias("k", "text"))
    kind = F.when(F.length("text") % 2 == 0, "PER").otherwise("LOC")
    return found.select("lang", F.lit(str(odd)).alias("side"), (F.col("doc_id") * 100000 + F.col("k")).alias("ord"), F.when(F.col("doc_id") % 3 == 0, F.upper("text")).otherwise(F.col("text")).alias("text"), F.lower("text").alias("normal"), kind.alias("type"))


def mention_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First mentions in all documents, side by side."""
    both = _mentions(spark, sf_dir, 0).unionByName(_mentions(spark, sf_dir, 1))
    return entities.dedupe(both, "lang").select("lang", "side", "ord", "text", "normal", "type")


def mention_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.difference(_mentions(spark, sf_dir, 0), _mentions(spark, sf_dir, 1), "lang")


def mention_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.replacement_pairs(_mentions(spark, sf_dir, 0), _mentions(spark, sf_dir, 1), "lang")


def sync_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four replacements in order on every document; the second undoes a part of the first."""
    pairs = F.array(*(F.struct(F.lit("PER").alias("type"), F.lit(a).alias("old"), F.lit(b).alias("new")) for a, b in (("the", "THE"), ("THEr", "ther"), ("", "x"), ("ion", "iOn"))))
    done = I.spread(I.table(spark, sf_dir, "documents")).select("doc_id", replace_in_order(F.col("text"), pairs).alias("d"))
    return done.select("doc_id", "d.text", F.coalesce(F.aggregate("d.applied", F.lit(0).cast("long"), lambda a, x: a + x["count"]), F.lit(0)).alias("replaced"))


def entity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    diff = mention_diff(spark, sf_dir)
    langs = I.table(spark, sf_dir, "documents").select("lang")
    return entities.difference_report(langs, diff, "lang")


_MENTIONS = "SELECT lang, doc_id * 100000 + k - 1 AS ord, CASE WHEN doc_id %% 3 = 0 THEN upper(w) ELSE w END AS text, lower(w) AS normal, CASE WHEN length(w) %% 2 = 0 THEN 'PER' ELSE 'LOC' END AS type FROM (SELECT lang, doc_id, unnest(range(1, len(l) + 1)) AS k, unnest(l) AS w FROM (SELECT lang, doc_id, regexp_extract_all(text, '[A-Z][a-z]{2,}') AS l FROM documents WHERE doc_id %% 2 = %d))"
_MENTIONS_CTE = f"a AS ({_MENTIONS % 0}), b AS ({_MENTIONS % 1})"
_KEYED_CTE = _MENTIONS_CTE + ", ka AS (SELECT lang, normal, type, arg_max(text, ord) AS text, min(ord) AS ord FROM a GROUP BY ALL), kb AS (SELECT lang, normal, type, arg_max(text, ord) AS text, min(ord) AS ord FROM b GROUP BY ALL)"
DEDUPE_SQL = f"WITH {_MENTIONS_CTE}, sides AS (SELECT *, '0' AS side FROM a UNION ALL SELECT *, '1' FROM b) SELECT lang, side, min(ord) AS ord, arg_min(text, ord) AS text, normal, type FROM sides GROUP BY lang, side, normal, type"
DIFF_SQL = f"WITH {_KEYED_CTE} SELECT lang, 'clean' AS missing_in, type, normal, text FROM ka ANTI JOIN kb USING (lang, normal, type) UNION ALL SELECT lang, 'source', type, normal, text FROM kb ANTI JOIN ka USING (lang, normal, type)"
PAIRS_SQL = f"WITH {_KEYED_CTE} SELECT kb.lang, kb.ord, kb.type, kb.text AS old, ka.text AS new FROM kb JOIN ka USING (lang, normal, type) WHERE kb.text <> ka.text"
SYNC_SQL = """
WITH s1 AS (SELECT doc_id, text AS t0, replace(text, 'the', 'THE') AS t1 FROM documents), s2 AS (SELECT *, replace(t1, 'THEr', 'ther') AS t2 FROM s1), s3 AS (SELECT *, replace(t2, 'ion', 'iOn') AS t3 FROM s2)
SELECT doc_id, t3 AS text, ((length(t0) - length(replace(t0, 'the', ''))) // 3 + (length(t1) - length(replace(t1, 'THEr', ''))) // 4 + (length(t2) - length(replace(t2, 'ion', ''))) // 3)::BIGINT AS replaced FROM s3
"""
REPORT_SQL = f"""
WITH d AS ({DIFF_SQL}), l AS (SELECT lang, missing_in, string_agg('- ' || type || ': ' || normal || ' (' || text || ')', chr(10) ORDER BY type, normal) AS lines FROM d GROUP BY ALL)
SELECT s.lang, coalesce({I.quote(entities.ONLY_SOURCE)} || chr(10) || g.lines, {I.quote(entities.NONE_GONE)}) || chr(10) || chr(10) || coalesce({I.quote(entities.ONLY_CLEAN)} || chr(10) || n.lines, {I.quote(entities.NONE_NEW)}) AS report
FROM (SELECT DISTINCT lang FROM documents) s LEFT JOIN l g ON g.lang = s.lang AND g.missing_in = 'clean' LEFT JOIN l n ON n.lang = s.lang AND n.missing_in = 'source'
"""

# ---------------------------------------------------------------- sources


def source_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several versions of each document, some of them not valid; the first valid one."""
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = docs.where("doc_id % 3 <> 0").select("doc_id", F.lit("final_clean.txt").alias("name"), F.when(F.col("doc_id") % 2 == 0, F.left("text", F.lit(40))).otherwise(F.col("text")).alias("text"))
    json = docs.select("doc_id", F.lit("structured.json").alias("name"), F.to_json(F.struct(F.array(F.struct(F.when(F.col("doc_id") % 5 == 0, " ").otherwise("a").alias("text"))).alias("blocks"))).alias("text"))
    page = docs.select("doc_id", F.lit("final_clean.html").alias("name"), F.concat(F.when(F.col("doc_id") % 7 == 0, "<pre>").otherwise("<p>"), F.left("text", F.lit(20))).alias("text"))
    return readers.best_version(clean.unionByName(json).unionByName(page)).select("doc_id", "name")


PRIORITY_SQL = r"""
SELECT doc_id, CASE WHEN doc_id % 3 <> 0 AND doc_id % 2 <> 0 AND length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 50 THEN 'final_clean.txt' WHEN doc_id % 5 <> 0 THEN 'structured.json' ELSE 'final_clean.html' END AS name
FROM documents WHERE NOT (doc_id % 5 = 0 AND doc_id % 7 = 0 AND NOT (doc_id % 3 <> 0 AND doc_id % 2 <> 0 AND length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 50))
"""


def json_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of documents in either JSON shape."""
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.struct(F.lit(1).alias("page"), F.lit("paragraph").alias("role"), x.alias("text")))
    docs = I.table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.to_json(lines)).otherwise(F.to_json(F.struct(lines.alias("blocks")))).alias("json"))
    rows = docs.select("doc_id", F.posexplode(readers.json_blocks(F.col("json"))).alias("block_id", "b"))
    return rows.select("doc_id", "block_id", "b.role", "b.text")


JSON_SQL = "SELECT doc_id, unnest(range(len(p)))::INTEGER AS block_id, 'paragraph' AS role, unnest(p) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)"

QUERIES = {
    "page_median_role": page_roles, "reading_order_one": reading_order_one, "reading_order_two": reading_order_two, "weighted_font": weighted_font, "safe_matches": safe_matches,
    "apply_matches": patched_texts, "dictionary_corrections": word_corrections, "corrected_texts": corrected_texts, "spell_run": spell_run, "sentence_split": sentence_split, "bigrams": bigram_counts,
    "pronoun_warnings": pronoun_warnings, "split_words": split_words, "mention_dedupe": mention_dedupe, "mention_diff": mention_diff, "mention_pairs": mention_pairs,
    "sync_apply": sync_apply, "entity_report": entity_report, "source_priority": source_priority, "json_shapes": json_shapes,
}

#: The names of forms that once were more than others of these queries.
_WHOLE = ("safe_matches", "apply_matches", "dictionary_corrections", "mention_dedupe", "mention_diff", "mention_pairs", "entity_report")
QUERIES |= {f"{name}_whole": QUERIES[name] for name in _WHOLE}

ORACLES = {
    "page_median_role": ROLES_SQL, "reading_order_one": ONE_SQL, "reading_order_two": TWO_SQL, "weighted_font": FONT_SQL, "safe_matches": SAFE_SQL, "apply_matches": PATCH_SQL,
    "dictionary_corrections": CORRECTIONS_SQL, "corrected_texts": CORRECTED_SQL, "spell_run": SPELL_RUN_SQL, "sentence_split": SPLIT_SQL, "bigrams": BIGRAMS_SQL, "pronoun_warnings": PRONOUN_SQL, "mention_dedupe": DEDUPE_SQL,
    "mention_diff": DIFF_SQL, "mention_pairs": PAIRS_SQL, "sync_apply": SYNC_SQL, "entity_report": REPORT_SQL, "source_priority": PRIORITY_SQL, "json_shapes": JSON_SQL,
}
ORACLES |= {f"{name}_whole": ORACLES[name] for name in _WHOLE}
