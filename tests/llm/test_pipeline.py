"""Each stage of the pipeline against an independent version of it, on its own input."""

import collections
import math
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from helpers import SMALL

from inkwright.llm import packing, quality, toxicity
from test_contracts import brute_force, weights_by_hand


def drawn_by_hand(texts, labels):
    """Ids that Gumbel top-k draws by hand-made weights, as many as the labels' share of good ones says."""
    keys = {i: w + float(quality.gumbel(np.asarray([-(2**63) if i is None else i], np.int64), 5)[0]) for i, w in weights_by_hand(texts, labels).items() if w is not None}
    n = math.ceil(len(keys) * sum(y == 1 for y in labels.values()) / len(labels))
    return set(sorted(keys, key=lambda i: -keys[i])[:n])


def civil_by_hand(texts, model):
    """Ids whose probability of any grade above 0 is below one half, word by word from the model's numbers."""
    from inkwright.llm.common import stem_hashes

    weight = dict(zip(model.features.tolist(), model.weights.tolist()))

    def hashes(word):
        return {int(stem_hashes([word[:n]], ())[0][0, 0]) for n in (None, *toxicity.PREFIXES)}

    kept = set()
    for i, text in texts:
        # runs of anything but ASCII marks and white space, A-Z lower-cased
        words = re.findall(rb"(?:[0-9a-z]|[\x80-\xff])+", (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
        times = collections.Counter(h for w in words for h in hashes(w) if h in weight)
        z = sum(weight[h] * math.log1p(n * 100 / max(20, len(words))) for h, n in times.items())
        if 1 / (1 + math.exp(-(z - model.thresholds[0]))) < 0.5:
            kept.add(i)
    return kept


def pieces_by_hand(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            yield i, n, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    columns, qualities = docs.columns, {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if k < 3:
            assert after.columns == columns
            kept = {r["doc_id"] for r in after.select("doc_id").collect()}
        if k == 0:
            wanted = drawn_by_hand(list(before.items()), qualities)
        elif k == 1:
            wanted = civil_by_hand(list(before.items()), toxicity.fit(docs, labels))
        elif k == 2:
            wanted = {i for i, (_, c) in brute_force(list(before.items()), corpus_pipeline.NEAR_PER_CENT).items() if i == c}
        else:
            pieces = after.collect()
            assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces) == sorted(pieces_by_hand(before.items()))
            bins = collections.defaultdict(list)
            for r in pieces:
                bins[r["sequence_id"]].append((r["offset"], r["length"]))
            for places in bins.values():
                ends = [0, *(at + n for at, n in sorted(places))]
                assert [at for at, _ in sorted(places)] == ends[:-1] and ends[-1] <= 2048
            assert len(bins) <= math.ceil(sum(r["length"] for r in pieces) / 2048) + 1
            continue
        assert kept == wanted and kept, name
        docs = after
    assert corpus_pipeline.run(spark, SMALL).count() == len(pieces)


def test_repeated_rows_are_copies(spark, make_docs):
    docs = make_docs([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "z"), (3, None)])
    kept = corpus_pipeline.near_dedup_stage(spark, docs, SMALL)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "None"] and kept.columns == docs.columns


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, None), (None, "some words"), (3, "clean words of a text " * 20), (3, "clean words of a text " * 20), (4, "other words in it " * 30_000)]])
def test_whole_run_on_odd_tables(spark, make_docs, tmp_path, rows):
    """Empty tables; null, empty, repeated and very long texts; clashing column names."""
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} <= {i for i, _ in rows} and (not rows) == (not found)
