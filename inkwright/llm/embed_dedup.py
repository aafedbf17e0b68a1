"""Embedding near-duplicates: a pigeonhole join over the blocks of rotated vectors."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwright.llm.common import Scratch
from inkwright.llm.components import connected_components
from inkwright.llm.topk import usable

_HOMES = "rep long, label long, copies long, dim int, block int, c0 long, c1 long, c2 long, own boolean, turned binary, vec binary"
_FOUND = "u long, v long, links long"
#: Rotated unit vectors are kept as whole multiples of this, the same in every task.
_GRAIN = 2.0**-30
#: Room for rounding in squared block distances: for the grain, and for the first screening in single precision.
_SLACK, _SCREEN = 1e-7, 1e-5
#: Coordinates of a block that its cells may be cut along.
MOST_AXES = 3


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int, blocks: int) -> np.ndarray:
    return np.unique(np.linspace(0, dim, min(blocks, dim) + 1).round().astype(int))


def budgets(dim: int, blocks: int, threshold: float) -> np.ndarray:
    """Squared-distance budget of each block, in proportion to its width; together 2 - 2 * threshold."""
    return (2 - 2 * threshold) * np.diff(block_edges(dim, blocks)) / dim


def rotated_units(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, rotated, and the norms. einsum sums each row alike whatever rows lie beside it."""
    scale = np.abs(vectors).max(1, keepdims=True)
    norms = np.sqrt(np.einsum("ij,ij->i", vectors / scale, vectors / scale)) * scale[:, 0]
    return np.einsum("ij,jk->ik", vectors / norms[:, None], rotation(vectors.shape[1], seed)), norms


def turned_units(vectors: np.ndarray, seed: int) -> np.ndarray:
    """Rotated unit vectors in multiples of _GRAIN."""
    return np.rint(rotated_units(vectors, seed)[0] / _GRAIN).astype("<i4")


def linked_pairs(left: tuple, right: tuple, same: bool, block: int, blocks: int, threshold: float):
    """Index pairs linked by cosine >= threshold whose first block within its budget is `block`; with `same` each pair once.

    `left`, `right`: ids, rotated units and vectors. Of two vectors at squared distance at most 2 - 2 * threshold at least one block is within
    its share; counting a pair only in the first such block counts it once. One matrix product in single precision screens a tile, with room
    for its rounding; what it lets through is checked in double precision.
    """
    (_, ta, va), (_, tb, vb) = left, right
    dim = ta.shape[1]
    edges, budget = block_edges(dim, blocks), budgets(dim, blocks, threshold) + _SLACK
    x, y = ((t[:, edges[block] : edges[block + 1]] * _GRAIN).astype(np.float32) for t in (ta, tb))
    half_x, half_y = ((z * z).sum(1, keepdims=True) / 2 for z in (x, y))
    x, y = np.hstack((x, half_x, np.ones_like(half_x))), np.hstack((y, -np.ones_like(half_y), -half_y))
    for at in range(0, len(x), 512):
        r, c = np.nonzero(x[at : at + 512] @ y.T >= -(budget[block] + _SCREEN) / 2)
        r += at
        if same:
            r, c = r[r < c], c[r < c]
        for first in range(0, len(r), 1 << 16):
            p, q = r[first : first + (1 << 16)], c[first : first + (1 << 16)]
            for k in [*range(block), block]:
                s, e = edges[k], edges[k + 1]
                gap = (ta[p, s:e].astype(np.int64) - tb[q, s:e]) * _GRAIN
                within = np.einsum("ij,ij->i", gap, gap) <= budget[k]
                within ^= k < block
                p, q = p[within], q[within]
            a, b = va[p], vb[q]
            cosine = np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))
            yield p[cosine >= threshold], q[cosine >= threshold]


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, blocks: int = 8, chunk_rows: int = 2048, seed: int = 7, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    """Links between vectors of one label with cosine >= threshold: vec_id, n_links, component_id, kept.

    Copies (equal label and vector) become one weighted representative. Unit vectors are rotated
    by a seeded orthogonal matrix and cut into `blocks`; two vectors within squared distance
    2 - 2 * threshold agree in some block within its proportional budget. Each block is a grid of cells over its first
    coordinates, as wide as the block's radius: one coordinate, or up to MOST_AXES where a label has so many vectors that cells would
    hold more than `chunk_rows`. A vector is at home in its cell and goes to those neighbouring cells, of each two opposite ones to one,
    that are within the block's radius of it. Cells that are crowded all the same are cut into chunks of about
    `chunk_rows` joined pairwise. Each (cell, chunk, chunk) task unit screens its pairs with one
    matrix product, checks them exactly in double precision, and returns link counts and a
    spanning forest, never the pairs. The result is exact: no recall is lost. Pairs that are far apart but share a neighbourhood in a block are
    still screened: work grows with the square of a label's vectors, divided by the cells that the budget allows.

    n_links: other vectors linked directly, copies included. component_id: the smallest vec_id
    reachable, itself included. kept: vec_id = component_id. Vectors that are null, empty, zero or hold
    null or non-finite components, and those with a null label, link with nothing. Repeated ids
    count as vectors of their own. A null id is returned with null component and kept. Extra columns are ignored; an
    empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession)
    label = F.col(label_col).cast("long") if label_col else F.lit(0).cast("long")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"), label.alias("label"))
    zero = ~F.exists("vec", lambda x: x != 0)
    good: Column = usable("vec") & ~zero & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # equal labels and equal bits; the key is a digest of fixed size
    key = F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.to_json(F.struct(F.transform("vec", lambda x: x + F.lit(0.0).cast("float"))))), 256)
    keyed = rows.where(good).withColumn("key", key)
    classes = scratch.put(keyed.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec")))
    # a label's cells are halved by about six along each coordinate
    per_label = classes.groupBy("label").agg(F.count("*").alias("n"))
    axes = F.greatest(F.lit(1), F.least(F.lit(MOST_AXES), F.ceil(F.log(F.col("n") / chunk_rows) / F.log(F.lit(6.0))))).cast("int")
    sized = classes.join(per_label.select("label", axes.alias("axes")), "label").select("rep", "label", "copies", "axes", F.size("vec").alias("dim"), "vec")

    def homes(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            shape = np.stack([table.column(c).to_numpy() for c in ("dim", "axes")], axis=1)
            for dim, n_axes in np.unique(shape, axis=0).tolist():
                part = table.filter(pa.array((shape == [dim, n_axes]).all(1)))
                values = part.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                turned = turned_units(values, seed)
                edges, budget = block_edges(dim, blocks), budgets(dim, blocks, threshold) + 2 * _SLACK
                for k in range(len(budget)):
                    used = min(n_axes, edges[k + 1] - edges[k])
                    radius = np.sqrt(budget[k])
                    at = turned[:, edges[k] : edges[k] + used] * _GRAIN / radius
                    home = np.floor(at)
                    for step in itertools.product((-1, 0, 1), repeat=used):
                        if step < (0,) * used:
                            continue
                        away = np.where(np.asarray(step) > 0, home + 1 - at, at - home) * np.abs(step)
                        go = np.flatnonzero((away * away).sum(1) <= 1 + 1e-9)
                        cell = np.zeros((len(go), MOST_AXES), np.int64)
                        cell[:, :used] = home[go] + step
                        own = not any(step)
                        fixed = [part.column(c).combine_chunks().take(pa.array(go)) for c in ("rep", "label", "copies")]
                        binary = [pa.array([x.tobytes() for x in z[go]], pa.binary()) for z in (turned, values.astype("<f4"))]
                        yield pa.RecordBatch.from_arrays([*fixed, *(pa.array(np.full(len(go), x, np.int32)) for x in (dim, k)), *map(pa.array, cell.T), pa.array(np.full(len(go), own)), *binary], [x.split(" ")[0] for x in _HOMES.split(", ")])

    spread = sized.mapInArrow(homes, _HOMES)
    cell_key = ["label", "dim", "block", "c0", "c1", "c2"]
    count = lambda own: F.greatest(F.lit(1), F.ceil(F.count(F.when(F.col("own") == own, 1)) / chunk_rows)).cast("int")
    light = spread.select(*cell_key, "own").groupBy(*cell_key).agg(count(True).alias("homes"), count(False).alias("guests"))
    crowded = scratch.put(light.where("homes > 1 or guests > 1"))
    one = F.coalesce("homes", F.lit(1)), F.coalesce("guests", F.lit(1))
    dealt = spread.join(crowded, cell_key, "left").withColumns({"homes": one[0], "guests": one[1]})
    # parts of homes first, then parts of guests; pairs of two parts of guests are not made
    part = F.when(F.col("own"), F.pmod(F.xxhash64("rep"), F.col("homes"))).otherwise(F.col("homes") + F.pmod(F.xxhash64("rep"), F.col("guests"))).cast("int")
    others = F.when(F.col("own"), F.col("homes") + F.col("guests")).otherwise(F.col("homes"))
    dealt = dealt.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    tile = [*cell_key, F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y")]
    dealt = dealt.select(*tile, "part", "rep", "copies", "turned", "vec")

    def join(key, table):
        _, dim, block, *_, x, y = (k.as_py() for k in key)
        part, rep, copies = (table.column(c).to_numpy() for c in ("part", "rep", "copies"))
        turned = np.frombuffer(b"".join(table.column("turned").to_pylist()), "<i4").reshape(-1, dim)
        vec = np.frombuffer(b"".join(table.column("vec").to_pylist()), "<f4").astype(np.float64).reshape(-1, dim)
        i, j = np.flatnonzero(part == x), np.flatnonzero(part == y)
        pairs = [np.zeros((2, 0), np.int64)]
        if len(i) and len(j):
            left, right = ((rep[z], turned[z], vec[z]) for z in (i, j))
            pairs += [np.stack((i[r], j[c])) for r, c in linked_pairs(left, right, x == y, block, blocks, threshold)]
        a, b = np.concatenate(pairs, axis=1)
        links = np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))
        some = links > 0
        u, v = forest(a, b, len(rep))
        return pa.table({"u": np.concatenate((rep[some], rep[u])), "v": np.concatenate((rep[some], rep[v])), "links": np.concatenate((links[some].astype(np.int64), np.zeros(len(u), np.int64)))})

    found = scratch.put(dealt.groupBy(*cell_key, "x", "y").applyInArrow(join, _FOUND))
    counts = found.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    component = connected_components(found.where("u != v").select("u", "v"), scratch=scratch).withColumnRenamed("node", "rep")
    per_class = classes.select("key", "rep", "copies").join(counts, "rep", "left").join(component, "rep", "left")
    per_class = per_class.select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    per_class = scratch.put(per_class)
    scratch.keep(per_class)
    linked = keyed.select("vec_id", "key").join(per_class, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(good, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def forest(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star for each connected component of the links: every node but the first, and that first node."""
    low = np.arange(n)
    while True:
        before = low.copy()
        least = np.minimum(low[u], low[v])
        np.minimum.at(low, u, least)
        np.minimum.at(low, v, least)
        low = low[low]
        if (low == before).all():
            break
    moved = np.flatnonzero(low != np.arange(n))
    return moved, low[moved]
