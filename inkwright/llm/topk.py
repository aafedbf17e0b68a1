"""Exact top-k search by inner product: tiled matrix products and merged top lists."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwright.llm.common import parallelism

_HITS = "query_id long, vec_id long, score long, shard int"


def usable(vector: str) -> Column:
    """True for vectors that are not null or empty and hold only finite components."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond 53 bits in Python integers, held to the range of a long."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if bound < 2**53:
        return (q @ c.T).astype(np.int64)
    to_int = np.vectorize(int, otypes=[object])
    product = to_int(q) @ to_int(c).T
    return np.clip(product, 1 - 2**63, 2**63 - 1).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best, higher scores first and smaller ids first among equals; id -1 marks no candidate."""
    order = np.lexsort((ids, -scores, ids < 0), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def search_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, q_tile: int = 512, c_tile: int = 4096):
    """The k best candidates of each query in one shard, tile by tile; a partial selection keeps ties exact."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    for i in range(0, len(q_ids), q_tile):
        own = q_ids[i : i + q_tile]
        best_ids, best = np.full((len(own), 0), -1, np.int64), np.zeros((len(own), 0), np.int64)
        for j in range(0, len(c_ids), c_tile):
            ids, scores = c_ids[j : j + c_tile], _exact_scores(q[i : i + q_tile], c[j : j + c_tile])
            known = np.where(own[:, None] == ids[None, :], -1, ids[None, :])
            if len(ids) > 2 * k + 2:
                # the k+1 best positions always hold the k best besides the query itself; equal scores at the edge are all kept
                edge = np.partition(scores, len(ids) - k - 1, axis=1)[:, len(ids) - k - 1]
                near = scores >= edge[:, None]
                width = int(near.sum(1).max())
                pick = np.argsort(~near, axis=1, kind="stable")[:, :width]
                inside = np.take_along_axis(near, pick, 1)
                known = np.where(inside, np.take_along_axis(known, pick, 1), -1)
                scores = np.take_along_axis(scores, pick, 1)
            tile_ids, tile = _best(known, scores, k)
            best_ids, best = _best(np.concatenate((best_ids, tile_ids), 1), np.concatenate((best, tile), 1), k)
        yield own, best_ids, best


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = 8192, group_rows: int = 32768, fan_in: int = 16) -> DataFrame:
    """Each query's k highest integer inner products over all other vectors: query_id, rank, vec_id, score.

    Components x become floor(scale * x), x as double. Candidates are dealt to shards of about
    `shard_rows`, queries to groups of about `group_rows`; each (shard, group) is one bounded
    task unit in which tiles are multiplied and partially selected. The per-shard lists of k rows
    a query are merged as a tree of `fan_in` lists a step, so no step gathers more than
    fan_in * k rows of a query. Ties go to the smaller id. A query's own row (by id) is no
    candidate. Vectors that are null, empty or hold null or non-finite components, and rows with
    a null id, take no part; vectors are compared only at equal length. Repeated ids are
    separate candidates; rows that repeat a query's id are one query, which gets the best of all their lists. Columns besides id and vector are ignored. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    slim = lambda df: df.where(usable(vec_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), F.size(vec_col).alias("dim"))
    candidates, asked = slim(vectors), slim(queries)
    shards = max(1, math.ceil(vectors.count() / shard_rows), min(2 * spark.sparkContext.defaultParallelism, parallelism(spark)))
    groups = max(1, math.ceil(queries.count() / group_rows))
    left = candidates.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = asked.withColumn("grp", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def search(key, have: pa.Table, want: pa.Table) -> pa.Table:
        shard, _, dim = (x.as_py() for x in key)
        out = []
        if have.num_rows and want.num_rows:
            c, q = (np.floor(matrix(t.column("v"), dim) * scale) for t in (have, want))
            for own, ids, scores in search_tile(want.column("id").to_numpy(), q, have.column("id").to_numpy(), c, k):
                row, col = np.nonzero(ids >= 0) if len(ids) else (np.zeros(0, int), np.zeros(0, int))
                out.append((own[row], ids[row, col], scores[row, col]))
        parts = [np.concatenate([x[n] for x in out]) if out else np.zeros(0, np.int64) for n in range(3)]
        return pa.table({"query_id": parts[0], "vec_id": parts[1], "score": parts[2], "shard": pa.array(np.full(len(parts[0]), shard, np.int32))})

    keys = ("shard", "grp", "dim")
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, _HITS)
    best_first = (F.desc("score"), F.asc("vec_id"))
    while shards > fan_in:
        hits = hits.withColumn("shard", (F.col("shard") / fan_in).cast("int"))
        hits = hits.withColumn("r", F.row_number().over(Window.partitionBy("query_id", "shard").orderBy(*best_first))).where(F.col("r") <= k).drop("r")
        shards = math.ceil(shards / fan_in)
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best_first)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
