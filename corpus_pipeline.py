"""A training corpus from raw documents: quality, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All but the last keep the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.llm import minhash, packing, quality, toxicity
from inkwright.llm.common import perhaps_among, remove, shared_dir, table

#: Near-duplicates here are documents whose sets of five-word shingles are at least this similar, in per cent.
NEAR_PER_CENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws, as op9 does; texts without words go, rows without a doc_id are drawn like others."""
    return quality.keep_drawn(docs, table(spark, sf_dir, "labels"), **quality.SAMPLING)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of any severity above 0 is below one half; null and empty texts stay."""
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates; rows without a doc_id stay."""
    groups = minhash.near_duplicates(docs, per_cent=NEAR_PER_CENT)
    gone = groups.where(~F.col("kept")).select("doc_id").distinct()
    kept = perhaps_among(docs, gone, "doc_id", among=False).union(perhaps_among(docs, gone, "doc_id").join(gone, "doc_id", "left_anti").select(*docs.columns))
    again = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").limit(1).count()
    if again:  # rows that repeat a doc_id are copies too
        kept = kept.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"]).union(kept.where(F.col("doc_id").isNull()))
    return kept.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence; a null text packs its end id."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("quality_classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL cannot express the fitted classifiers; tests compare each stage with a version made by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, with each result in the shared folder until the next one is there.

    Empty tables give no rows. A null doc_id passes every stage; see the stages for null texts and repeated rows.
    """
    place = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
        if before:
            remove(spark, f"{place}/{before}")
        before = name
    return docs
