"""Toxicity: cumulative-link ordinal regression on sparse stem features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.llm.common import Scratch, stem_hashes, text_parts, tidied, utf8_rows
from inkwright.llm.quality import labelled_sample

#: Bytes of a word's beginning that are features besides the whole word: inflected forms share their stem.
PREFIXES = (4, 5, 6, 7, 8)
_U64 = np.uint64
_SCORES = "doc_id long, severity double, toxic_probability double, grade int"


#: Features are stems whose log odds in toxic documents exceed this.
LEAST_ODDS = 2.0


def feature_values(times: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A feature's value from its count and the number of words: a stem by chance in a long text weighs little."""
    return np.log1p(times * 100 / np.maximum(words, 20))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - weights . features), the weights shared by all thresholds."""

    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray
    sieve: np.ndarray  # which of 2**20 hash values some feature has

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature, value) for the model's features."""
        hashes, words = stem_hashes(texts, PREFIXES)
        owner = np.repeat(np.arange(len(texts)), words)
        row, column = np.nonzero(self.sieve[hashes & _U64((1 << 20) - 1)])
        found, text = hashes[row, column], owner[row]
        at = np.minimum(np.searchsorted(self.features, found), max(0, len(self.features) - 1))
        same = self.features[at] == found if len(self.features) else np.zeros(len(found), bool)
        # a word no longer than a prefix shows its hash in several columns: counted once a word
        cell, _ = np.unique(np.stack((row[same], at[same])), axis=1, return_counts=True)
        pair, times = np.unique(np.stack((owner[cell[0]], cell[1])), axis=1, return_counts=True)
        return pair[0], pair[1], feature_values(times, words[pair[0]])

    def severity(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and P(grade >= 1) of each text."""
        text, feature, value = self.counts(texts)
        z = np.bincount(text, value * self.weights[feature], len(texts)) if len(text) else np.zeros(len(texts))
        above = _sigmoid(z[:, None] - self.thresholds[None, :])
        return above.sum(1), above[:, 0]


def fit_cumulative_link(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int, weight: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the penalised likelihood, by full-batch Adam.

    Thresholds are a first value and positive gaps (softplus), so they stay in order.
    """
    n = len(grades)
    sample = np.ones(n) / n if weight is None else weight / weight.sum()
    w, free = np.zeros(n_features), np.concatenate(([1.0], np.zeros(n_grades - 2)))
    moments = [np.zeros(n_features + n_grades - 1) for _ in range(2)]
    for step in range(1, steps + 1):
        gaps = np.log1p(np.exp(free[1:]))
        theta = np.concatenate((free[:1], free[0] + np.cumsum(gaps)))
        z = np.bincount(rows, values * w[columns], n)
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        upper, lower = _sigmoid(edges[grades + 1] - z), _sigmoid(edges[grades] - z)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p * sample, lower * (1 - lower) / p * sample
        gz = du - dl
        gw = np.bincount(columns, values * gz[rows], n_features) + ridge * w
        gt = np.zeros(n_grades + 1)
        np.add.at(gt, grades + 1, -du)
        np.add.at(gt, grades, dl)
        gt = gt[1:-1]
        tails = np.cumsum(gt[::-1])[::-1]
        gfree = np.concatenate((tails[:1], tails[1:] * _sigmoid(free[1:])))
        g = np.concatenate((gw, gfree))
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.99 * moments[1] + 0.01 * g * g
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        w, free = w - move[:n_features], free - move[n_features:]
    gaps = np.log1p(np.exp(free[1:]))
    return w, np.concatenate((free[:1], free[0] + np.cumsum(gaps)))


def _stems(text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct stem hashes of a text, how many words have each, and its number of words."""
    hashes, words = stem_hashes([text], PREFIXES)
    if not len(hashes):
        return np.zeros(0, _U64), np.zeros(0, np.int64), 0
    # a word no longer than a prefix shows one hash in several columns
    ordered = np.sort(hashes, axis=1)
    first = np.ones(ordered.shape, bool)
    first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    own, times = np.unique(ordered[first], return_counts=True)
    return own, times, int(words.sum())


def _document_counts(batches):
    """stem, toxic, civil: how many of a task's documents of either kind have each stem."""
    held = []
    for batch in batches:
        for text, y in zip(utf8_rows(batch.column("text")), batch.column("y").to_pylist()):
            held.append((_stems(text)[0], y))
    if held:
        stems, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        toxic = np.repeat([y == 1 for _, y in held], [len(h) for h, _ in held])
        counts = [np.bincount(at[toxic == k], minlength=len(stems)).astype(np.int64) for k in (True, False)]
        yield pa.RecordBatch.from_arrays([pa.array(stems.view(np.int64)), pa.array(counts[0]), pa.array(counts[1])], ["stem", "toxic", "civil"])


def fit(docs: DataFrame, labels: DataFrame, most_labels: int = 6000, least_docs: int = 4, grades: int = 4) -> OrdinalModel:
    """A model fitted on a bounded, balanced sample: at most half of `most_labels` toxic and half other rows.

    Features are the stems in at least `least_docs` sampled toxic documents whose log odds exceed LEAST_ODDS with a z-score above 3, which
    is worked out where the stems are; these reach the driver, and then the sampled documents' counts of these. Both are bounded by the sample. Labels say only toxic or not, so grades are: 0 for documents that are not
    toxic, and for toxic ones 1 to `grades` - 1 by equal shares of the rate of indicative words. Without toxic labels, or without
    others, every severity is 0.
    """
    none = OrdinalModel(np.zeros(0, _U64), np.zeros(0), np.full(grades - 1, 60.0), np.zeros(1 << 20, bool))
    half = most_labels // 2
    sample = labelled_sample(labels.where(F.col("toxic") == 1), "toxic", half) | labelled_sample(labels.where(F.col("toxic") == 0), "toxic", half)
    ids = docs.sparkSession.createDataFrame(list(sample.items()), "doc_id long, y int")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scratch = Scratch(docs.sparkSession)
    chosen = scratch.put(slim.join(F.broadcast(ids), "doc_id"))
    known = {r["y"]: r["count"] for r in chosen.groupBy("y").count().collect()}
    n1, n0 = known.get(1, 0), known.get(0, 0)
    if not n1 or not n0:
        return none
    counts = chosen.mapInArrow(tidied(_document_counts), "stem long, toxic long, civil long").groupBy("stem").agg(F.sum("toxic").alias("a"), F.sum("civil").alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (n1 + 1 - a)) - F.log(b / (n0 + 1 - b))
    ranked = counts.where(F.col("a") >= least_docs).select("stem", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
    best = ranked.where((F.col("z") > 3) & (F.col("odds") > LEAST_ODDS)).select("stem").toPandas()
    features = np.sort(best["stem"].to_numpy().view(_U64))
    if not len(features):
        return none

    def cells(batches):
        for batch in batches:
            for text, y in zip(utf8_rows(batch.column("text")), batch.column("y").to_pylist()):
                stems, times, words = _stems(text)
                at = np.minimum(np.searchsorted(features, stems), len(features) - 1)
                hit = features[at] == stems
                yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), pa.array([words]), pa.array([at[hit].tolist()], pa.list_(pa.int32())), pa.array([times[hit].tolist()], pa.list_(pa.int32()))], ["y", "words", "at", "times"])

    rows = chosen.mapInArrow(tidied(cells), "y int, words long, at array<int>, times array<int>").collect()
    scratch.keep()
    rows = sorted(rows, key=lambda r: (r["y"], r["words"], r["at"], r["times"]))  # the same model whatever the order of tasks
    toxic, words = np.asarray([r["y"] == 1 for r in rows]), np.asarray([r["words"] for r in rows])
    r = np.repeat(np.arange(len(rows)), [len(row["at"]) for row in rows])
    c = np.asarray([x for row in rows for x in row["at"]], np.int64)
    v = np.asarray([x for row in rows for x in row["times"]], np.int64)
    rate = np.bincount(r, v, len(rows)) / np.maximum(1, words)
    grade = np.zeros(len(rows), int)
    order = np.argsort(np.argsort(rate[toxic], kind="stable"), kind="stable")
    grade[toxic] = 1 + order * (grades - 1) // n1
    balance = np.where(toxic, len(rows) / (2 * n1), len(rows) / (2 * n0))
    weights, thresholds = fit_cumulative_link(r, c, feature_values(v, words[r]), grade, len(features), grades, balance)
    sieve = np.zeros(1 << 20, bool)
    sieve[(features & _U64((1 << 20) - 1)).astype(np.int64)] = True
    return OrdinalModel(features, weights, thresholds, sieve)


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, severity (expected grade), toxic_probability (of any grade above 0), grade (severity rounded)."""

    def scan(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, part in text_parts(batch.column("text")):
                severity, probability = model.severity(utf8_rows(part))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(severity), pa.array(probability), pa.array(np.rint(severity).astype(np.int32))], ["doc_id", "severity", "toxic_probability", "grade"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return slim.mapInArrow(tidied(scan), _SCORES)


def severity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Expected severity of every document: doc_id, severity, toxic_probability, grade, toxic.

    toxic: toxic_probability >= 0.5. Grades above 0 are made from the rate of the very stems that predict them, see fit(): the severity of a
    toxic document orders such documents by it and has no other source. Null and empty texts have no features and get the model's
    base severity, below every toxic one. Repeated rows are scored alike, a null doc_id stays null,
    extra columns are ignored, empty tables give no rows. One scan fits, one scores; nothing is shuffled.
    """
    return score(docs, fit(docs, labels, **options)).withColumn("toxic", F.col("toxic_probability") >= 0.5)


def keep_civil(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not toxic, with all their columns.

    Null and empty texts stay; very long texts count whole; repeated rows go or stay together; other columns pass whatever their names; an empty
    table stays empty, and without labels of both kinds every document stays.
    """
    model = fit(docs, labels, **options)
    columns = docs.columns

    def scan(batches):
        for batch in batches:
            for i, j, part in text_parts(batch.column(columns.index("text"))):
                yield batch.slice(i, j - i).filter(pa.array(model.severity(utf8_rows(part))[1] < 0.5))

    return docs.mapInArrow(tidied(scan), docs.schema)
