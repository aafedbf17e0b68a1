"""Connected components by alternating large-star and small-star rounds, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, rounds: int = 60, scratch: Scratch | None = None) -> DataFrame:
    """Rows (node, component) for every node of the links (u, v); component: the smallest node reachable.

    Links may repeat, point either way or join a node with itself; rows with a null end are
    ignored. Nodes without a link to another node are absent. Each round shuffles the links
    twice; a hub's links are read by skew-splittable joins and its minimum is pre-aggregated, so
    no node's neighbours meet in one task's memory. The number of rounds grows with the logarithm
    of the longest chain; exceeding `rounds` raises instead of returning a partial answer. Each round's links are
    written to `scratch` and the round before dropped, so that the last one's files alone remain, which the result reads.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    links = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = scratch.put(links)
    before = _state(links)
    for _ in range(rounds):
        if not before[0]:
            break
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        own = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(own, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        done, links = links, scratch.put(small.union(own.select("u", F.col("m").alias("v"))).distinct())
        scratch.drop(done)
        after = _state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
