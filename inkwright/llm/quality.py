"""Quality classifier: importance resampling between two hashed n-gram models."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.llm.common import Scratch, mix, text_parts, tidied, utf8_rows, word_hashes

_U64 = np.uint64
_SCORES = "doc_id long, log_weight double, key double"


def ngram_buckets(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed unigrams and bigrams of all texts, and the text each belongs to."""
    words, counts = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    pairs = mix(words[:-1] * _U64(0xD6E8FEB86659FD93) + words[1:])
    inside = owner[1:] == owner[:-1]
    grams = np.concatenate((words, pairs[inside])) % _U64(buckets)
    return grams.astype(np.int64), np.concatenate((owner, owner[1:][inside]))


def gumbel(ids: np.ndarray, seed: int) -> np.ndarray:
    """Standard Gumbel noise fixed by document id and seed, so that a recomputed task draws the same."""
    uniform = (mix(mix(ids.astype(np.int64).view(_U64) + _U64(seed)) ^ _U64(0x9E3779B97F4A7C15)) >> _U64(11)).astype(np.float64)
    return -np.log(-np.log((uniform + 0.5) / 2.0**53))


#: Weighted counts are kept as whole numbers of this part of one.
_UNIT = 2.0**20
#: Importance resampling as published: plain counts of every occurrence in both models, the document's log ratio at
#: temperature 1, and as many documents drawn as the labels' share of good ones says. The one departure is that the log ratio is divided by the
#: root of the number of n-grams, the scale on which it varies by chance, so that length alone does not decide.
SAMPLING = {"sharpness": 1.0, "power": 0.5, "plain": True, "size": "share"}


@dataclass(frozen=True)
class Resampler:
    """The log ratio of the two models per bucket, and how documents are weighted: sharpness * log ratio / (n-grams ** power)."""

    ratio: np.ndarray
    sharpness: float
    seed: int
    power: float = 1.0

    def weigh(self, ids: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """log_weight (NaN without words) and Gumbel key of each document."""
        grams, owner = ngram_buckets(texts, len(self.ratio))
        n = np.bincount(owner, minlength=len(texts))
        with np.errstate(invalid="ignore", divide="ignore"):
            weight = self.sharpness * np.bincount(owner, self.ratio[grams], len(texts)) / n.astype(np.float64) ** self.power
        return weight, weight + gumbel(ids, self.seed)


def labelled_sample(labels: DataFrame, column: str, most: int) -> dict[int, int]:
    """At most `most` labels, the ones first by hash of the id; of repeated ids the smaller label."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(column).cast("int").alias("y"))
    return {r["doc_id"]: r["y"] for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()}


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = 1 << 17, sharpness: float = 200.0, most_labels: int = 20_000, seed: int = 5, power: float = 1.0, plain: bool = False) -> tuple[Resampler, dict[int, int]]:
    """Both generative models, counted over all documents in one scan.

    Raw text is every document; target text is those labelled quality 1 within a bounded sample
    of at most `most_labels` labels. An n-gram that a document has n times counts n there if `plain`, else log2(1 + n), at any n, so that a very long
    repetitive one does not outweigh the rest; whole multiples of 2**-20 add up to the same in any order. Counts of `buckets` hashed n-grams are added up in each task
    and then across tasks; the driver gets one row a bucket.
    """
    sample = labelled_sample(labels, "quality", most_labels)
    wanted = frozenset(k for k, y in sample.items() if y == 1)
    unit = 1.0 if plain else _UNIT

    def count(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, j, part in text_parts(batch.column("text")):
                grams, owner = ngram_buckets(utf8_rows(part), buckets)
                good = np.fromiter((x in wanted for x in ids[i:j]), bool, j - i)
                own, times = np.unique(owner * buckets + grams, return_counts=True)
                bucket, times = own % buckets, times if plain else np.rint(np.log2(times + 1.0) * _UNIT)
                wanted_here = good[own // buckets]
                raw += np.bincount(bucket, times, buckets).astype(np.int64)
                target += np.bincount(bucket[wanted_here], times[wanted_here], buckets).astype(np.int64)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    rows = _slim(docs).mapInArrow(tidied(count), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.ones(buckets), np.ones(buckets)
    raw[rows["bucket"]] += rows["raw"] / unit
    target[rows["bucket"]] += rows["target"] / unit
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum()) if wanted else np.zeros(buckets)
    return Resampler(ratio.astype(np.float32), sharpness, seed, power), sample


def scores(docs: DataFrame, model: Resampler) -> DataFrame:
    """doc_id, log_weight, key (null without words)."""

    def scan(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for i, j, part in text_parts(batch.column("text")):
                weight, key = model.weigh(ids[i:j], utf8_rows(part))
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j]), pa.array(weight, from_pandas=True), pa.array(key, from_pandas=True)], ["doc_id", "log_weight", "key"])

    return _slim(docs).mapInArrow(tidied(scan), _SCORES)


def best_cut(weights: np.ndarray, good: np.ndarray, favour: float = 20.0) -> float:
    """The log weight that divides labelled documents best when losing a good one costs `favour` times as much
    as keeping a bad one; halfway into the gap. Without bad examples everything stays."""
    if not len(weights) or good.all() or not good.any():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    lost = np.concatenate(([0], np.cumsum(g))) * favour / g.sum() + np.concatenate((np.cumsum((~g)[::-1])[::-1], [0])) / (~g).sum()
    k = int(np.argmin(lost))
    if k == 0:
        return -np.inf
    return float((w[k - 1] + w[k]) / 2) if k < len(w) else float(w[-1])


def kth_largest_key(scored: DataFrame, k: int, bits: int = 16) -> int:
    """The k-th largest key as a sortable integer: four histogram passes of 2**bits counts, exact at any size."""
    prefix, depth, left = 0, 0, k
    sortable = scored.select(sortable_key().alias("s"))
    while depth < 64:
        shift = 64 - depth - bits
        rows = sortable.where(F.shiftrightunsigned("s", 64 - depth) == prefix) if depth else sortable
        digit = F.shiftrightunsigned("s", shift).bitwiseAND(F.lit((1 << bits) - 1))
        for row in sorted(rows.groupBy(digit.alias("d")).count().collect(), key=lambda r: -r["d"]):
            if left <= row["count"]:
                prefix = prefix << bits | row["d"]
                break
            left -= row["count"]
        depth += bits
    return prefix - (1 << 64) if prefix >> 63 else prefix


def sortable_key():
    """A key's bits as a long whose unsigned order is the order of the doubles (here: scaled to 2**-20 and shifted)."""
    return (F.col("key") * float(1 << 20)).cast("long") + F.lit(1 << 60)


def resample(docs: DataFrame, labels: DataFrame, size: int | str | None = None, **options) -> DataFrame:
    """Importance resampling of all documents: doc_id, log_weight, key, kept.

    log_weight is the log ratio of target to raw model, added up over a document's n-grams, divided by their number to the `power`, times
    `sharpness`; SAMPLING holds the options of the query. Documents are sampled without replacement by Gumbel top-k: key = log_weight + Gumbel noise fixed by
    id and seed, and the `size` largest keys are kept (all documents whose key equals the last one's, too).
    With "share" as many are drawn as the labels' share of quality 1 makes of all documents with words; without
    `size`, as many as have a log weight above the cut that divides the labelled sample best. Very long texts count whole. Null, empty or white texts have null weight and key and are not kept; a null doc_id is scored and returned as null.
    Repeated rows are drawn alike. Without labels of quality 1 all weights are 0 and nothing with words is rejected. Extra columns are ignored; an empty table gives no rows.
    """
    model, sample = fit(docs, labels, **options)
    scored = Scratch(docs.sparkSession).put(scores(docs, model))
    edge = draw_edge(scored, sample, size)
    kept = F.coalesce(sortable_key() >= edge, F.lit(False))
    return scored.select(F.when(F.col("doc_id") != -(2**63), F.col("doc_id")).alias("doc_id"), "log_weight", "key", kept.alias("kept"))


def draw_edge(scored: DataFrame, sample: dict[int, int], size: int | str | None) -> int:
    """The smallest key that is drawn, as a sortable integer."""
    drawable = scored.where(F.col("key").isNotNull())
    if size == "share":
        good = sum(y == 1 for y in sample.values())
        size = -(-drawable.count() * good // len(sample)) if good else drawable.count()
    elif size is None:
        ids = scored.sparkSession.createDataFrame([(k, y) for k, y in sample.items()], "doc_id long, y int")
        known = drawable.join(F.broadcast(ids), "doc_id").select("log_weight", "y").toPandas()
        edge = best_cut(known["log_weight"].to_numpy(), known["y"].to_numpy() == 1)
        size = drawable.where(F.col("log_weight") >= float(edge)).count() if np.isfinite(edge) else drawable.count()
    total = drawable.count()
    if not size or not total:
        return 2**63 - 1
    return kth_largest_key(drawable, min(size, total))


def keep_drawn(docs: DataFrame, labels: DataFrame, size: int | str | None = None, **options) -> DataFrame:
    """The documents that resampling draws, with all their columns; texts are scored again, not shuffled.

    A null doc_id is drawn as one document of its own id; null, empty and white texts go; repeated rows are drawn alike;
    other columns pass whatever their names; an empty table stays empty.
    """
    model, sample = fit(docs, labels, **options)
    scratch = Scratch(docs.sparkSession)
    edge = draw_edge(scratch.put(scores(docs, model)), sample, size)
    scratch.keep()
    columns = docs.columns

    def scan(batches):
        for batch in batches:
            ids = np.asarray([-(2**63) if x is None else x for x in batch.column(columns.index("doc_id")).to_pylist()], np.int64)
            for i, j, part in text_parts(batch.column(columns.index("text"))):
                _, key = model.weigh(ids[i:j], utf8_rows(part))
                kept = ~np.isnan(key) & (np.trunc(np.nan_to_num(key) * float(1 << 20)).astype(np.int64) + (1 << 60) >= edge)
                yield batch.slice(i, j - i).filter(pa.array(kept))

    return docs.mapInArrow(tidied(scan), docs.schema)
