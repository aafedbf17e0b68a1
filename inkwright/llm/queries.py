"""The training-data queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.llm import chat, ctw, dropout_bpe, embed_dedup, html, minhash, packing, quality, topk, toxicity
from inkwright.llm.common import table


def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.with_places(chat.rotate_perspectives(table(spark, sf_dir, "conversations")))


_ESCAPED = r"regexp_replace(regexp_replace(%s, '<(\\*)\|', '<\\\\\1|', 'g'), '\|(\\*)>', '|\\\\\1>', 'g')"
_ROTATED = """said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content
  FROM conversations WHERE conv_id IS NOT NULL
), people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
rotated AS (SELECT conv_id, perspective, turn,
  CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
  CASE WHEN speaker NOT IN ('system', perspective) THEN speaker END AS name,
  content,
  CASE WHEN speaker = 'system' THEN '<|system|>' WHEN speaker = perspective THEN '<|assistant|>'
       ELSE '<|user name=' || {name} || '|>' END || chr(10) || {content} || '<|end|>' || chr(10) AS rendered,
  CASE WHEN speaker <> 'system' AND speaker = perspective THEN 1 ELSE 0 END AS mask
FROM said JOIN people USING (conv_id))""".replace("{name}", _ESCAPED % "speaker").replace("{content}", _ESCAPED % "content")
OP1_SQL = f"""
WITH {_ROTATED}, placed AS (SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, rendered ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM rotated)
SELECT conv_id, perspective, turn, role, name, content, rendered, mask, e - length(rendered) AS start, e AS "end",
  CASE WHEN mask = 1 THEN e - length(rendered) + 14 END AS mask_start, CASE WHEN mask = 1 THEN e - 1 END AS mask_end FROM placed
"""


def dialogue_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole dialogues as text from every perspective, in segments of four turns, with the spans to train on."""
    made = chat.render_samples(chat.rotate_perspectives(table(spark, sf_dir, "conversations")), 4)
    masks = F.array_join(F.transform("masks", lambda m: F.concat(m["start"], F.lit("-"), m["end"])), " ")
    return made.select("conv_id", "perspective", "segment", "text", masks.alias("masks"))


SAMPLES_SQL = f"""
WITH {_ROTATED}, placed AS (SELECT *, floor(turn / 4)::BIGINT AS segment, sum(length(rendered)) OVER (PARTITION BY conv_id, perspective, floor(turn / 4) ORDER BY turn, rendered ROWS UNBOUNDED PRECEDING) AS e FROM rotated)
SELECT conv_id, perspective, segment, string_agg(rendered, '' ORDER BY turn, rendered) AS text,
  coalesce(string_agg((e - length(rendered) + 14) || '-' || (e - 1), ' ' ORDER BY turn, rendered) FILTER (WHERE mask = 1), '') AS masks FROM placed GROUP BY conv_id, perspective, segment
"""


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op3_context_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.default_tokenizer())


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP6_SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


def op7_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropout_bpe.encode_documents(table(spark, sf_dir, "documents"), dropout_bpe.default_model())


def op8_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels say toxic or not; the grades of toxic documents are equal shares of the rate of indicative stems, so severity among them is made, not labelled."""
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), **quality.SAMPLING)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_perspectives": op1_chat_perspectives,
    "dialogue_samples": dialogue_samples,
    "op2_html_main_text": op2_html_main_text,
    "op3_context_tree_score": op3_context_tree_score,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_merge_dropout": op7_merge_dropout,
    "op8_toxicity_severity": op8_toxicity_severity,
    "op9_quality_resampling": op9_quality_resampling,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
}

ORACLES: dict[str, str] = {"op1_chat_perspectives": OP1_SQL, "dialogue_samples": SAMPLES_SQL, "op6_exact_top_k": OP6_SQL}
