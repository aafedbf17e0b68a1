"""MinHash near-duplicates: banded candidates, sequential Bayesian pruning, exact verification."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwright.llm.common import Scratch, mix, perhaps_among, text_parts, tidied, utf8_rows, word_hashes
from inkwright.llm.components import connected_components

SHINGLE_WORDS = 5
BANDS, ROWS = 25, 5
HASHES = BANDS * ROWS
_DOCS = "doc_id long, n_shingles long, hi long, lo long, sig binary"
_U64, _U32, _U16 = np.uint64, np.uint32, np.uint16


# ---------------------------------------------------------------- shingles and signatures


def shingle_hashes(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of all texts, and how many each text has (repeats included).

    A text of one to four words has one shingle, the whole sequence.
    """
    n = len(words)
    ends = np.cumsum(counts)
    begins = ends - counts
    full = np.zeros(n, _U64)
    if n >= SHINGLE_WORDS:
        m = n - SHINGLE_WORDS + 1
        acc = np.zeros(m, _U64)
        for k in range(SHINGLE_WORDS):
            acc = acc * _U64(0xD6E8FEB86659FD93) + words[k : k + m]
        full[:m] = mix(acc)
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(n) + SHINGLE_WORDS <= ends[owner] if n else np.zeros(0, bool)
    for few in range(1, SHINGLE_WORDS):
        at = begins[counts == few]
        acc = np.full(len(at), few, _U64)
        for k in range(few):
            acc = mix(acc * _U64(0xD6E8FEB86659FD93) + words[at + k])
        full[at], inside[at] = acc, True
    return full[inside], np.bincount(owner[inside], minlength=len(counts))


@lru_cache
def _permutations(seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 32, HASHES, dtype=_U32), rng.integers(0, 1 << 31, HASHES, dtype=_U32) * _U32(2) + _U32(1)


def signatures(shingles: np.ndarray, counts: np.ndarray, seed: int) -> np.ndarray:
    """The low 16 bits of MinHash values, a row a text with shingles; texts without shingles are left out of `counts`."""
    flip, factor = _permutations(seed)
    low, high = shingles.astype(_U32), (shingles >> _U64(32)).astype(_U32)
    starts = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
    out = np.empty((len(counts), HASHES), _U16)
    for k in range(HASHES):
        x = (low ^ flip[k]) * factor[k]
        x ^= (x >> _U32(15)) ^ high
        x *= _U32(0x2C1B3C6D)
        out[:, k] = np.minimum.reduceat(x, starts).astype(_U16)
    return out


def _distinct(shingles: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return [np.unique(x) for x in np.split(shingles, np.cumsum(counts)[:-1])]


def fingerprints(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, n_shingles (set size), a 128-bit digest of the set, and the signature (null without shingles)."""

    def scan(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, part in text_parts(batch.column("text")):
                shingles, counts = shingle_hashes(*word_hashes(utf8_rows(part)))
                size = np.zeros(j - i, np.int64)
                digest = np.zeros((2, j - i), np.int64)
                sig: list[bytes | None] = [None] * (j - i)
                some = np.flatnonzero(counts)
                if len(some):
                    values = signatures(shingles, counts[some], seed)
                    for row, (k, own) in enumerate(zip(some, _distinct(shingles, counts[some]))):
                        size[k] = len(own)
                        digest[0, k] = mix(own).sum(dtype=_U64).astype(np.int64)
                        digest[1, k] = np.bitwise_xor.reduce(mix(own ^ _U64(0xA0761D6478BD642F))).astype(np.int64)
                        sig[k] = values[row].tobytes()
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(size), pa.array(digest[0]), pa.array(digest[1]), pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "hi", "lo", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(tidied(scan), _DOCS)


def band_keys(sig: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(sig), BANDS), _U64)
    for r in range(ROWS):
        keys = mix(keys * _U64(0x9FB21C651E98DF25) + sig.reshape(-1, BANDS, ROWS)[:, :, r].astype(_U64) + _U64(1))
    return keys ^ (np.arange(BANDS, dtype=_U64) * _U64(0xC2B2AE3D27D4EB4F))[None, :]


# ---------------------------------------------------------------- sequential Bayesian pruning


@lru_cache
def least_matches(threshold: float, miss: float, step: int = 25) -> tuple[tuple[int, int], ...]:
    """(hashes compared, least matches to go on) after each batch of `step` hashes.

    With a uniform prior the similarity given m matches of n is Beta(m + 1, n - m + 1); a pair is
    pruned when the posterior probability of similarity >= threshold is below `miss`.
    """

    def tail(m: int, n: int) -> float:
        # P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m)
        return math.fsum(math.comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(m + 1))

    return tuple((n, next(m for m in range(n + 1) if tail(m, n) >= miss)) for n in range(step, HASHES + 1, step))


def survivors(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the row pairs of two signature matrices that no batch prunes, and their matches."""
    alive, matches, before = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, least in least_matches(threshold, miss):
        matches = matches + (a[alive, before:n] == b[alive, before:n]).sum(1)
        keep = matches >= least
        alive, matches, before = alive[keep], matches[keep], n
    return alive, matches


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _U16).reshape(-1, HASHES)


def _pruned_pairs(pairs: DataFrame, sigs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs (a, b) that survive the comparison of their signatures."""

    def compare(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if batch.num_rows:
                keep, _ = survivors(_matrix(table.column("sa")), _matrix(table.column("sb")), threshold, miss)
                yield from table.select(["a", "b"]).take(pa.array(keep)).to_batches()

    left = sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sa"))
    right = sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sb"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")


# ---------------------------------------------------------------- exact verification


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id and its distinct shingle hashes."""

    def scan(batches):
        for batch in batches:
            for i, j, part in text_parts(batch.column("text")):
                shingles, counts = shingle_hashes(*word_hashes(utf8_rows(part)))
                sets = _distinct(shingles, counts)
                offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                values = np.concatenate(sets).astype(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(tidied(scan), "doc_id long, shingles array<long>")


def _sets_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """The shingle sets of the documents wanted; hardly another text is shuffled to learn that."""
    return shingle_sets(perhaps_among(docs, wanted, "doc_id").join(wanted, "doc_id", "left_semi"))


def _verified(pairs: DataFrame, docs: DataFrame, per_cent: int) -> DataFrame:
    """The pairs whose full shingle sets satisfy 100 * intersection >= per_cent * union.

    Only texts that occur in a pair are turned into sets; each pair carries one set and meets the other
    in a join that can be split, so a text with many partners is stored once.
    """
    sets = _sets_of(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct(), docs)
    both = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b").join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", common.alias("both"), (F.size("sa") + F.size("sb") - common).alias("either")).where(F.col("both") * 100 >= F.col("either") * per_cent).select(F.col("a").alias("u"), F.col("b").alias("v"))


# ---------------------------------------------------------------- crowded buckets


def _with_heads(shared: DataFrame) -> DataFrame:
    """Rows of shared buckets with `a`, the head of their bucket: its member that meets the most others in all its buckets, the smallest of equal ones.

    Of variants of one text those with the fewest changes meet the most others, and are like the most others.
    """
    met = shared.withColumn("met", F.sum("members").over(Window.partitionBy("b")))
    heads = met.groupBy("band").agg(F.min(F.struct((-F.col("met")).alias("met"), "b")).alias("head"))
    return shared.join(heads.select("band", F.col("head.b").alias("a")), "band")


def _grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with `grp`, the group of document b so far."""
    return rows.join(groups.select(F.col("node").alias("b"), "component"), "b", "left").withColumn("grp", F.coalesce("component", "b")).drop("component")


def _open(rows: DataFrame) -> DataFrame:
    """The buckets with more than one group: their rows and shingles, and as `most` the same of their largest group."""
    own = rows.groupBy("band", "grp").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    most = F.max(F.struct("rows", "grp", "shingles")).alias("most")
    return own.groupBy("band").agg(most, F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles")).where(F.col("most.rows") < F.col("rows"))


def _open_tiles(rows: DataFrame, bands: DataFrame, tile_rows: int, tile_shingles: int) -> DataFrame:
    """band, x, y, b, n, grp, part: members of open buckets, dealt to pairs of parts; a bucket that fits one tile is one part.

    A pair of different groups has an end outside the bucket's largest group. So the others fall into parts 0, 1, ...,
    the largest group into the parts after these, and of all pairs of parts those of two of the latter are not made: a
    bucket that is one group but for a few members costs these few times its size. A part has about `tile_rows` rows and
    `tile_shingles` shingles.
    """

    def parts(n, shingles):
        return F.greatest(F.lit(1), F.ceil(n / tile_rows), F.ceil(shingles / tile_shingles)).cast("int")

    more = (F.col("rows") > tile_rows) | (F.col("shingles") > tile_shingles)
    po = F.when(more, parts(F.col("rows") - F.col("most.rows"), F.col("shingles") - F.col("most.shingles"))).otherwise(1)
    pm = F.when(more, parts(F.col("most.rows"), F.col("most.shingles"))).otherwise(0)
    sized = bands.select("band", F.when(more, F.col("most.grp")).alias("main"), po.alias("po"), pm.alias("pm"))
    dealt = rows.join(sized, "band").withColumn("far", F.coalesce(F.col("grp") == F.col("main"), F.lit(False)))
    place = F.when(F.col("far"), F.col("po") + F.pmod(F.xxhash64("b"), F.greatest("pm", F.lit(1)))).otherwise(F.pmod(F.xxhash64("b"), F.col("po"))).cast("int")
    others = F.when(F.col("far"), F.col("po")).otherwise(F.col("po") + F.col("pm"))
    dealt = dealt.withColumn("part", place).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    return dealt.select("band", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "b", "n", "grp", "part")


#: Slots of shingles in the table of counts that orders them, before those of size classes; how much sizes of one class differ.
_SLOT_BITS, _CLASSES, _SIZE_STEP = 20, 1 << 10, 1.05
_SLOTS = 1 << _SLOT_BITS


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles.view(_U64)) >> _U64(64 - _SLOT_BITS)).astype(np.int64)


def _size_class(n: int) -> int:
    return int(math.log(n) / math.log(_SIZE_STEP))


@lru_cache(1 << 16)
def prefixes(n: int, per_cent: int) -> tuple[tuple[int, int], ...]:
    """(size class of the other set, how many of its first shingles a set of n needs) for all sets it may be linked with.

    Sets of n and m shingles with 100 * intersection >= per_cent * union share at least o = per_cent * (n + m) / (100 +
    per_cent), so in any one order of all shingles the first n - o + 1 of one and the first m - o + 1 of the other have one in common.
    """
    out = []
    for other in range(_size_class(max(1, -(-n * per_cent // 100))), _size_class(n * 100 // per_cent) + 1):
        out.append((other, _first(n, max(1, math.floor(_SIZE_STEP**other) - 1), per_cent)))
    return tuple(out)


def _first(n: int, least: int, per_cent: int) -> int:
    """How many of its first shingles a set of n needs for all sets of at least `least`."""
    return max(0, min(n, n + 1 + -per_cent * (n + least) // (100 + per_cent)))


def _by_prefixes(crowded: DataFrame, docs: DataFrame, per_cent: int, scratch: Scratch) -> DataFrame:
    """band, b, n, grp: buckets by shared shingles in which every two linked documents of crowded buckets meet.

    Rare shingles come first, so the texts that only a common passage brings into one bucket part here, and no link is lost. The order
    is by counts in a table of 2^20 slots, whatever the size of the input: slots that shingles share only make it less
    sharp. Shingles of one group alone come before all others and bring no document to a bucket: no two groups share them.
    """
    own = scratch.put(crowded.select("b", "n", "grp").distinct())
    sets = scratch.put(_sets_of(own.select(F.col("b").alias("doc_id")), docs).withColumnRenamed("doc_id", "b").join(own, "b"))

    def count(batches):
        table = np.zeros(_SLOTS + _CLASSES, np.int64)
        least, most = np.full(len(table), np.iinfo(np.int64).max), np.full(len(table), np.iinfo(np.int64).min)
        for batch in batches:
            column = batch.column("shingles")
            slots, grp = _slots(column.flatten().to_numpy()), np.repeat(batch.column("grp").to_numpy(), column.value_lengths().to_numpy())
            table += np.bincount(slots, minlength=len(table))
            np.minimum.at(least, slots, grp)
            np.maximum.at(most, slots, grp)
            for n in batch.column("n").unique().to_pylist():  # of a class its least size, as g0
                k = _SLOTS + _size_class(n)
                table[k], least[k], most[k] = 1, min(n, least[k]), np.iinfo(np.int64).max
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, table[at], least[at], most[at])], ["slot", "rows", "g0", "g1"])

    slots = sets.select("n", "grp", "shingles").mapInArrow(count, "slot long, rows long, g0 long, g1 long").groupBy("slot")
    often = slots.agg(F.sum("rows").alias("rows"), F.min("g0").alias("g0"), F.max("g1").alias("g1")).where("g0 <> g1").select("slot", F.when(F.col("slot") < _SLOTS, F.col("rows")).otherwise(F.col("g0")).alias("rows")).toArrow()
    counts = np.repeat([1, 0], [_SLOTS, _CLASSES])  # of slots, and the least size of each class, 0 for none
    counts[often.column("slot").to_numpy()] = often.column("rows").to_numpy()
    counts = sets.sparkSession.sparkContext.broadcast(counts)

    def deal(batches):
        for batch in batches:
            column = batch.column("shingles")
            shingles, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy().astype(np.int64))
            rows, bands = [], []
            for row, (n, own) in enumerate(zip(batch.column("n").to_pylist(), np.split(shingles, ends[:-1]))):
                rows_with = counts.value[_slots(own)]
                order = np.lexsort((own, rows_with))
                own, alone = own[order], np.count_nonzero(rows_with == 1)
                mine = _size_class(n)
                for other, first in prefixes(n, per_cent):
                    least = int(counts.value[_SLOTS + other])
                    first = min(first, _first(n, least, per_cent)) if least else 0
                    if first > alone:
                        pair = _U64(min(mine, other) << 16 | max(mine, other))
                        bands.append(mix(own[alone:first].view(_U64) ^ mix(np.full(1, pair, _U64))).view(np.int64))
                        rows.append(np.full(first - alone, row))
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(bands)), *(batch.column(c).take(at) for c in ("b", "n", "grp"))], ["band", "b", "n", "grp"])

    found = scratch.put(sets.select("b", "n", "grp", "shingles").mapInArrow(deal, "band long, b long, n long, grp long"))
    scratch.drop(own, sets)
    return found


_TILE = ("band", "x", "y")


def _tile_rows(tiles: DataFrame, sigs: DataFrame) -> DataFrame:
    return tiles.join(sigs.select(F.col("doc_id").alias("b"), "sig"), "b").select(*_TILE, "b", "n", "grp", "sig", "part")


def _tile_pairs(key, table, per_cent: int, miss: float):
    """Index pairs of different groups that survive pruning, and their matches; a pair that shares several bands counts in the first, one of a bucket by shingles in each.

    The first batch of signature values is compared block by block of rows, later ones pair by pair.
    """
    band, x, y = (k.as_py() for k in key)
    grp, part, n = (table.column(c).to_numpy() for c in ("grp", "part", "n"))
    sig = _matrix(table.column("sig"))
    keys = band_keys(sig)
    here = int(np.argmax(keys[0].view(np.int64) == band))  # 0, no earlier band, for a bucket by shingles
    left = np.flatnonzero(part == x)
    right = left if x == y else np.flatnonzero(part == y)
    (step, least), out = least_matches(per_cent / 100, miss)[0], [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int16))]
    columns = [np.ascontiguousarray(sig[right, k]) for k in range(step)]
    for at in range(0, len(left), 128):
        rows = left[at : at + 128]
        matches = np.zeros((len(rows), len(right)), np.uint8)
        for k, column in enumerate(columns):
            matches += sig[rows, k][:, None] == column[None, :]
        r, c = np.nonzero(matches >= least)
        i, j = rows[r], right[c]
        go = (grp[i] != grp[j]) & (100 * np.minimum(n[i], n[j]) >= per_cent * np.maximum(n[i], n[j]))
        if x == y:
            go &= i < j
        i, j = i[go], j[go]
        for first in range(0, len(i), 1 << 16):
            p, q = i[first : first + (1 << 16)], j[first : first + (1 << 16)]
            new = ~(keys[p, :here] == keys[q, :here]).any(1)
            p, q = p[new], q[new]
            alive, agree = survivors(sig[p], sig[q], per_cent / 100, miss)
            out.append((p[alive].astype(np.int32), q[alive].astype(np.int32), agree.astype(np.int16)))
    return tuple(np.concatenate(z) for z in zip(*out))


class _Labels:
    """Groups as small numbers, united step by step."""

    def __init__(self, grp: np.ndarray):
        _, self.of = np.unique(grp, return_inverse=True)
        self.label = np.arange(int(self.of.max()) + 1 if len(self.of) else 0)

    def apart(self, i, j):
        return self.label[self.of[i]] != self.label[self.of[j]]

    def unite(self, i: int, j: int) -> None:
        a, b = self.label[self.of[i]], self.label[self.of[j]]
        self.label[self.label == b] = a


def _forests(per_cent: int, miss: float):
    def compare(key, table):
        """Of a tile's surviving pairs a spanning forest of the groups, most alike first; `dropped` if there are others."""
        i, j, matches = _tile_pairs(key, table, per_cent, miss)
        ids, groups, kept = table.column("b").to_numpy(), _Labels(table.column("grp").to_numpy()), []
        order = np.argsort(-matches, kind="stable")
        for first in range(0, len(order), 4096):
            some = order[first : first + 4096]
            for k in some[groups.apart(i[some], j[some])].tolist():
                if groups.apart(i[k], j[k]):
                    groups.unite(i[k], j[k])
                    kept.append(k)
        band, x, y = (k.as_py() for k in key)
        a, b = ids[i[kept]], ids[j[kept]]
        n = len(kept)
        return pa.table({"band": np.full(n, band), "x": np.full(n, x, np.int32), "y": np.full(n, y, np.int32), "a": np.minimum(a, b), "b": np.maximum(a, b), "dropped": np.full(n, n < len(i))})

    return compare


def _undecided(per_cent: int, miss: float):
    def compare(key, table):
        """The documents of a tile that have a surviving pair of different groups; none if the tile is one group."""
        if pc.count_distinct(table.column("grp")).as_py() < 2:
            return table.slice(0, 0)
        i, j, _ = _tile_pairs(key, table, per_cent, miss)
        return table.take(pa.array(np.unique(np.concatenate((i, j))).astype(np.int64)))

    return compare


def _confirmed(per_cent: int, miss: float):
    def compare(key, table):
        """Links of a tile that full sets confirm, as a spanning forest of the groups."""
        i, j, _ = _tile_pairs(key, table, per_cent, miss)
        ids, groups = table.column("b").to_numpy(), _Labels(table.column("grp").to_numpy())
        column, links = table.column("shingles").combine_chunks(), []
        size = column.value_lengths().to_numpy().astype(np.int64)
        start = np.cumsum(size) - size
        at = np.unique(column.flatten().to_numpy(), return_inverse=True)[1].astype(np.int32)
        mark = np.zeros(int(at.max()) + 1 if len(at) else 0, bool)
        order = np.argsort(i, kind="stable")
        left, first = np.unique(i[order], return_index=True)
        for p, right in zip(left.tolist(), np.split(j[order], first[1:])):  # all partners of one row at once
            right = right[groups.apart(p, right)]
            if not len(right):
                continue
            own = at[start[p] : start[p] + size[p]]
            mark[own] = True
            both = np.fromiter((np.count_nonzero(mark[at[start[q] : start[q] + size[q]]]) for q in right.tolist()), np.int64, len(right))
            mark[own] = False
            for q in right[100 * both >= per_cent * (size[p] + size[right] - both)].tolist():
                if groups.apart(p, q):
                    groups.unite(p, q)
                    links.append((p, q))
        u, v = (np.asarray([ids[x[n]] for x in links], np.int64) for n in range(2))
        return pa.table({"u": u, "v": v})

    return compare


# ---------------------------------------------------------------- operator


def _joined(groups: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """The groups after further links: a group's rows are stars around its smallest document, which settle at once."""
    if links.isEmpty():
        return groups
    return connected_components(groups.select(F.col("node").alias("u"), F.col("component").alias("v")).union(links), scratch=scratch)


def _one_text(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """doc_id, text with one row an id, and how many rows each repeated id has (None when no id is repeated).

    Only rows of repeated ids are gathered by id, and of these only the smallest text.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    often = scratch.put(slim.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1"))
    if often.isEmpty():
        return slim, None
    single = slim.join(often, "doc_id", "left_anti")
    least = slim.join(often, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return single.union(least), often


def near_duplicates(docs: DataFrame, per_cent: int = 85, miss: float = 1e-6, seed: int = 11, tile_rows: int = 1024, tile_shingles: int = 1 << 20) -> DataFrame:
    """Groups of documents linked by Jaccard similarity of their shingle sets: doc_id, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z), cut into words at ASCII white space and into distinct five-word
    shingles; one to four words make one shingle. Documents with the same set are one class; the
    class with the smallest doc_id stands for it. Signatures of 125 values fall into 25 bands of
    5 rows. In each bucket every class is first compared with the bucket's most central one, which links groups of copies
    in linear work. Only classes of one bucket that are still in different groups are then
    compared with each other, in tiles of bounded rows and shingles. The members of a bucket of more than tile_rows / 4 are dealt
    anew, by the shared shingles among the first of each in one order, rare ones first, which any two linked documents have. Each tile proposes a spanning forest of its surviving pairs, and tiles
    whose groups that does not unite confirm their other pairs themselves. So no list of a group's
    pairs is ever made. Every comparison prunes by posterior similarity after each 25 values (chosen miss
    probability `miss` a step) and confirms survivors on full sets: 100 * intersection >= per_cent * union.

    Recall: two classes whose similarity is s share no band with probability (1 - s^5)^25: 4e-7 at 0.85, 5e-5 at 0.80,
    3e-9 at 0.90; pruning adds at most 5 * `miss`. Such a miss loses that pair's own link, not those over other documents.

    component_id: the smallest doc_id reachable, itself included. kept: doc_id = component_id.
    Null, empty or white text has no shingles and links with nothing; very long texts count whole. Rows with a null doc_id keep null
    component and kept. Of rows that repeat a doc_id the smallest text speaks for all, and each row is returned. Extra
    columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    docs, often = _one_text(docs, scratch)
    prints = scratch.put(fingerprints(docs, seed))
    known = prints.where(F.col("sig").isNotNull() & F.col("doc_id").isNotNull())
    set_key = ["n_shingles", "hi", "lo"]
    classes = scratch.put(known.groupBy(*set_key).agg(F.min("doc_id").alias("rep")))
    sigs = scratch.put(known.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select("doc_id", F.col("n_shingles").alias("n"), "sig"))

    def bands(batches):
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_matrix(pa.Table.from_batches([batch]).column("sig")))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(c).to_numpy(), BANDS)) for c in ("doc_id", "n")] + [pa.array(keys.ravel().view(np.int64))], ["b", "n", "band"])

    banded = sigs.mapInArrow(bands, "b long, n long, band long")
    shared = scratch.put(banded.join(banded.groupBy("band").agg(F.count("*").alias("members")).where(F.col("members") > 1), "band"))
    members = scratch.put(_with_heads(shared))
    scratch.drop(shared)
    stars = members.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pruned = scratch.put(_pruned_pairs(stars, sigs, per_cent / 100, miss))
    first = scratch.put(_verified(pruned, docs, per_cent))
    scratch.drop(pruned)
    groups = connected_components(first, scratch=scratch)

    # buckets whose members are not all in one group yet: every two of different groups meet in one tile
    crowd = scratch.put(_grouped(members.where((F.col("members") > 2) & (F.col("a") != F.col("b"))).select("band", "b", "n"), groups))
    scratch.drop(members)
    open_bands = scratch.put(_open(crowd))
    crowded = (F.col("rows") > max(1, tile_rows // 4)) | (F.col("shingles") > tile_shingles)
    tiles = _open_tiles(crowd, open_bands.where(~crowded), tile_rows, tile_shingles)
    many = open_bands.where(crowded)
    if not many.isEmpty():  # more rows than a pair of parts may cost: buckets by rare shingles take their place
        finer = _by_prefixes(crowd.join(many, "band", "left_semi"), docs, per_cent, scratch)
        tiles = tiles.union(_open_tiles(finer, _open(finer), tile_rows, tile_shingles))
    tiles = scratch.put(tiles)
    scratch.drop(crowd)
    tiles = scratch.put(_tile_rows(tiles, sigs))
    found = scratch.put(tiles.groupBy(*_TILE).applyInArrow(_forests(per_cent, miss), "band long, x int, y int, a long, b long, dropped boolean"))
    second = scratch.put(_verified(found.select("a", "b").distinct(), docs, per_cent))
    groups = _joined(groups, second, scratch)

    # tiles that held back pairs and still are not in one group: their pairs are confirmed in the tile
    late = tiles.join(found.where("dropped").select(*_TILE).distinct(), [*_TILE], "left_semi")
    late = _grouped(late.drop("grp"), groups)
    late = scratch.put(late.groupBy(*_TILE).applyInArrow(_undecided(per_cent, miss), late.schema))
    third = late.join(_sets_of(late.select(F.col("b").alias("doc_id")).distinct(), docs).withColumnRenamed("doc_id", "b"), "b")
    third = scratch.put(third.groupBy(*_TILE).applyInArrow(_confirmed(per_cent, miss), "u long, v long"))
    groups = _joined(groups, third, scratch)

    by_class = classes.join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left").select(*set_key, F.coalesce("component", "rep").alias("component_id"))
    linked = known.select("doc_id", *set_key).join(by_class, set_key).select("doc_id", "n_shingles", "component_id")
    alone = prints.where(F.col("sig").isNull() | F.col("doc_id").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    result = scratch.put(linked.union(alone).withColumn("kept", F.col("doc_id") == F.col("component_id")))
    if often is not None:
        result = scratch.put(result.join(often, "doc_id", "left").withColumn("one", F.explode(F.sequence(F.lit(1), F.coalesce("rows", F.lit(1))))).drop("rows", "one"))
    scratch.keep(result)
    return result
