"""Language-model scores by context-tree weighting over binary-decomposed bytes."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.llm.common import batches_by_bytes, mix, parallelism, stored, utf8_rows, word_hashes

#: Bytes of context.
DEPTH = 6
_U64, _U32 = np.uint64, np.uint32
_END = 10
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---------------------------------------------------------------- bytes and contexts


def canonical(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that stand for each text's tokens, and where each text ends.

    Words, A-Z lower-cased, are divided by one space, and one line feed ends the text. Before each
    text stand DEPTH line feeds, the context of its first bytes.
    """
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    white = _WHITE[data]
    stops = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    keep = ~white
    keep[1:] |= white[1:] & ~white[:-1]
    keep[stops[:-1]] &= ~white[stops[:-1]]  # a space that opens a text follows the end of another
    mark = np.flatnonzero(keep & white)
    last = np.searchsorted(mark, stops) - 1
    begins = stops - np.diff(stops, prepend=0)
    has = (last >= 0) & (mark[np.maximum(last, 0)] >= begins) if len(mark) else np.zeros(len(texts), bool)
    keep[stops[~has] - 1] = True
    data = np.where(white, 32, data).astype(np.uint8)
    data[mark[last[has]]] = _END
    data[stops[~has] - 1] = _END
    sizes = np.add.reduceat(keep.astype(np.int64), begins)
    ends = np.cumsum(sizes + DEPTH)
    out = np.full(int(ends[-1]), _END, np.uint8)
    place = np.arange(int(sizes.sum())) + np.repeat(DEPTH * np.arange(1, len(texts) + 1), sizes)
    out[place] = data[keep]
    return out, ends


def grams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each scored byte the integer of it (low byte) and the DEPTH bytes before, and its text."""
    wide = data.astype(_U64)
    key = wide[DEPTH:].copy()
    for k in range(1, DEPTH + 1):
        key |= wide[DEPTH - k : len(wide) - k] << _U64(8 * k)
    sizes = np.diff(ends, prepend=0) - DEPTH
    owner = np.repeat(np.arange(len(ends)), sizes)
    begins = ends - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(begins - DEPTH - (np.cumsum(sizes) - sizes), sizes)
    return key[at], owner


def _mask(order: int) -> int:
    return (1 << 8 * (order + 1)) - 1


# ---------------------------------------------------------------- the weighted tree


_SMALL = np.array([math.lgamma(k / 2 + 0.5) if k else math.lgamma(0.5) for k in range(4096)])


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma of halves of integers from 1/2 on."""
    x = np.asarray(x, np.float64)
    small = x < 2000
    big = np.where(small, 2000.0, x)
    series = (big - 0.5) * np.log(big) - big + 0.5 * math.log(2 * math.pi) + 1 / (12 * big) - 1 / (360 * big**3)
    return np.where(small, _SMALL[np.where(small, 2 * x - 1, 0).astype(np.int64)], series)


def block_probability(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    out = _lgamma(zeros + 0.5)
    out += _lgamma(ones + 0.5)
    out -= _lgamma(zeros + ones + 1.0)
    return out - math.log(math.pi)


def _nodes(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes (context and the byte's bits so far, sorted) of sorted grams, with their counts of zeros and ones."""
    parts = []
    for bit in range(8):
        node = keys >> _U64(8) << _U64(8) | _U64(1 << bit) | (keys & _U64(255)) >> _U64(8 - bit)
        begin = np.flatnonzero(np.append(True, node[1:] != node[:-1]))  # grams are sorted, so a node's grams lie together
        one = (keys >> _U64(7 - bit) & _U64(1)) * counts.astype(_U64)
        ones = np.add.reduceat(one, begin)
        parts.append((node[begin], np.add.reduceat(counts.astype(_U64), begin) - ones, ones))
    node = np.concatenate([x[0] for x in parts])
    order = np.argsort(node)
    return node[order], np.concatenate([x[1] for x in parts])[order], np.concatenate([x[2] for x in parts])[order]


class Floats:
    """A read-only hash table from 64-bit keys to float32: open addressing with 32-bit fingerprints."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) / 0.75).bit_length())
        hashes = mix(keys + _U64(0x9E3779B97F4A7C15))
        self.prints, self.values = np.zeros(1 << self.bits, _U32), np.zeros(1 << self.bits, np.float32)
        at, todo = (hashes >> _U64(64 - self.bits)).astype(np.int64), np.arange(len(keys))
        marks = hashes.astype(_U32) | _U32(1)
        while len(todo):
            free = np.flatnonzero(self.prints[at] == 0)
            slot, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.prints[slot], self.values[slot] = marks[todo[won]], values[todo[won]]
            rest = np.ones(len(todo), bool)
            rest[won] = False
            todo, at = todo[rest], at[rest]
            at = np.where(self.prints[at] != 0, at + 1 & (1 << self.bits) - 1, at)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where there is none."""
        hashes = mix(keys + _U64(0x9E3779B97F4A7C15))
        at = (hashes >> _U64(64 - self.bits)).astype(np.int64)
        marks = hashes.astype(_U32) | _U32(1)
        seen = self.prints[at]
        out = np.where(seen == marks, self.values[at], np.float32(np.nan))
        todo = np.flatnonzero((seen != marks) & (seen != 0))
        at = at[todo]
        while len(todo):
            at = at + 1 & (1 << self.bits) - 1
            seen = self.prints[at]
            hit = seen == marks[todo]
            out[todo[hit]] = self.values[at[hit]]
            on = ~hit & (seen != 0)
            todo, at = todo[on], at[on]
        return out


@dataclass(frozen=True)
class ContextTree:
    """The trained tree: for each depth the log probability of whole bytes, and of a one at each node.

    At a node of depth d the probability of a one mixes the KT estimates of the nodes on its path from
    depth 0 to d by their posterior weights given all training counts. A bit is predicted at the
    deepest node that exists for the bytes before and the bits so far.
    """

    whole: tuple[Floats, ...]
    nodes: tuple[Floats, ...]

    def log_probability(self, key: np.ndarray) -> np.ndarray:
        """Natural log probability of each gram's byte given the bytes before."""
        out, depth = np.zeros(len(key)), np.full(len(key), -1)
        todo = np.arange(len(key))
        for d in range(DEPTH, -1, -1):
            sub = key[todo] & _U64(_mask(d))
            found = self.whole[d].get(sub)
            hit = ~np.isnan(found)
            out[todo[hit]] = found[hit]
            todo, sub = todo[~hit], sub[~hit]
            # a byte new to a context that exists goes bit by bit; where the context is new a shorter one decides
            known = ~np.isnan(self.nodes[d].get(sub >> _U64(8) << _U64(8) | _U64(1)))
            depth[todo[known]] = d
            todo = todo[~known]
            if not len(todo):
                break
        rows = np.flatnonzero(depth >= 0)
        out[rows] = self._by_bits(key[rows], depth[rows])
        out[todo] = 8 * math.log(0.5)  # nothing was trained
        return out

    def _by_bits(self, key: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """`depth`: the deepest level that may have a node; along the bits of a byte it only gets shallower."""
        total, byte = np.zeros(len(key)), key & _U64(255)
        for bit in range(8):
            prefix = _U64(1 << bit) | byte >> _U64(8 - bit)
            one = (byte >> _U64(7 - bit) & _U64(1)).astype(bool)
            p = np.full(len(key), 0.5)
            rows = np.arange(len(key))
            for d in range(DEPTH, -1, -1):
                here = depth[rows] == d
                own = rows[here]
                found = self.nodes[d].get((key[own] & _U64(_mask(d))) >> _U64(8) << _U64(8) | prefix[own])
                hit = ~np.isnan(found)
                p[own[hit]] = found[hit]
                depth[own[~hit]] = d - 1
                rows = np.concatenate((rows[~here], own[~hit]))
            total += np.log(np.where(one, p, 1 - p))
        return total


def _at_node(keys: np.ndarray, bit: int) -> np.ndarray:
    return keys >> _U64(8) << _U64(8) | _U64(1 << bit) | (keys & _U64(255)) >> _U64(8 - bit)


def weigh_tree(by_order: list[tuple[np.ndarray, np.ndarray]]) -> ContextTree:
    """The tree of gram counts, one (keys, counts) pair per depth from 0 to DEPTH, in one place."""
    levels = [_level(keys, counts) for keys, counts in by_order]
    stop, parents, _ = _up(levels, 0)
    n = len(levels[0][0])
    whole, nodes, _, _ = _down(levels, [keys for keys, _ in by_order], stop, parents, np.zeros(n), np.ones(n))
    return ContextTree(tuple(whole), tuple(nodes))


def _level(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(0, _U64), np.zeros(0, _U64), np.zeros(0, _U64)
    order = np.argsort(keys)
    return _nodes(keys[order], counts[order])


def _up(levels: list, depth: int, below: np.ndarray | None = None) -> tuple[list, list, np.ndarray]:
    """Weights from the last level to the first, which has `depth`: share of stopping, place of the parent, log P_w of the first.

    log P_w of a node is log(P_e / 2 + P_w of its children / 2); counts of contexts that a depth
    does not list form one more child. The share of P_e / 2 is the weight at which a path stops there.
    `below`: what the children of the last level's nodes add up to; without it paths end there.
    """
    stop: list[np.ndarray] = [np.zeros(0, np.float32)] * len(levels)
    parents: list[np.ndarray] = [np.zeros(0, np.int32)] * len(levels)
    weighted = np.zeros(0)
    for k in range(len(levels) - 1, -1, -1):
        node, zeros, ones = levels[k]
        own = block_probability(zeros, ones)
        if k + 1 < len(levels):
            deeper, z, o = levels[k + 1]
            up = np.searchsorted(node, deeper & _U64(_mask(depth + k))).astype(np.int32)
            parents[k + 1], n = up, len(node)
            children = block_probability(np.maximum(zeros - np.bincount(up, z, n), 0), np.maximum(ones - np.bincount(up, o, n), 0))
            children += np.bincount(up, weighted, n)
        elif below is not None:
            children = below
        else:
            weighted, stop[k] = own, np.ones(len(node), np.float32)
            continue
        weighted = np.logaddexp(own, children)
        stop[k] = np.exp(own - weighted).astype(np.float32)
        weighted -= math.log(2)
    return stop, parents, weighted


def _down(levels: list, keys_by_level: list[np.ndarray], stop: list, parents: list, mixed: np.ndarray, left: np.ndarray) -> tuple[list, list, np.ndarray, np.ndarray]:
    """Tables of bytes and of nodes for each level, and the mixture and unspent weight of the last.

    `mixed`, `left`: the mixture above each node of the first level and the weight that reaches it.
    """
    whole, nodes = [], []
    for k, (node, zeros, ones) in enumerate(levels):
        if k:
            mixed, left = mixed[parents[k]], left[parents[k]]
        kt = (ones + 0.5) / (zeros + ones + 1.0)
        p = np.clip(mixed + left * kt, 1e-7, 1 - 1e-7).astype(np.float32)  # as if the path ended here
        mixed, left = mixed + left * stop[k] * kt, left * (1 - stop[k])
        nodes.append(Floats(node, p))
        keys = keys_by_level[k]
        total = np.zeros(len(keys))
        for bit in range(8):
            q = p[np.searchsorted(node, _at_node(keys, bit))].astype(np.float64)
            total += np.log(np.where((keys >> _U64(7 - bit) & _U64(1)).astype(bool), q, 1 - q))
        whole.append(Floats(keys, total.astype(np.float32)))
    return whole, nodes, mixed, left


# ---------------------------------------------------------------- the tree as a partitioned table

#: Subtrees below this depth are weighed in tasks; the nodes of the depths up to it, at most 255 for each two bytes, by the driver.
_TOP = 2
_ROOTS = "node long, zeros long, ones long, weighted double"


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, counts, len(distinct)).astype(np.int64)


def _lower(keys: np.ndarray, counts: np.ndarray) -> tuple[list, list]:
    """Grams and nodes of the depths below _TOP."""
    found = [_merged(keys, counts)]
    for d in range(DEPTH - 1, _TOP, -1):
        found.append(_merged(found[-1][0] & _U64(_mask(d)), found[-1][1]))
    found.reverse()
    return [k for k, _ in found], [_level(k, n) for k, n in found]


@dataclass(frozen=True)
class _Top:
    """The tree down to depth _TOP: its tables, and the last depth's nodes with the mixture and weight that go on below."""

    whole: tuple[Floats, ...]
    nodes: tuple[Floats, ...]
    last: np.ndarray
    mixed: np.ndarray
    left: np.ndarray


def _weigh_top(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> _Top:
    """`node`, sorted: the nodes of depth _TOP with their counts and what their children add up to."""
    levels = [(node, zeros, ones)]
    for d in range(_TOP - 1, -1, -1):
        deeper, z, o = levels[0]
        up, at = np.unique(deeper & _U64(_mask(d)), return_inverse=True)
        levels.insert(0, (up, np.bincount(at, z, len(up)), np.bincount(at, o, len(up))))
    keys = []
    for own, zeros_, ones_ in levels:
        full = own & _U64(255) >= _U64(128)  # seven bits are known: the next makes the byte
        byte = own[full] >> _U64(8) << _U64(8) | (own[full] & _U64(127)) << _U64(1)
        keys.append(np.concatenate((byte[zeros_[full] > 0], byte[ones_[full] > 0] | _U64(1))))
    stop, parents, _ = _up(levels, 0, below)
    n = len(levels[0][0])
    whole, nodes, mixed, left = _down(levels, keys, stop, parents, np.zeros(n), np.ones(n))
    return _Top(tuple(whole), tuple(nodes), node, mixed, left)


# ---------------------------------------------------------------- what chunks ask and buckets answer


def _pack(x: np.ndarray) -> bytes:
    """Integers or floats by byte columns, compressed: sorted keys take about three bytes."""
    columns = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    return pa.compress(columns.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    columns = np.frombuffer(pa.decompress(packed, n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(columns.T).view(kind).ravel()


def _batch_keys(texts: list[bytes]):
    return word_hashes(texts)[0], grams(*canonical(texts))[0]


def _chunk_keys(texts: list[bytes], held_out: np.ndarray, buckets: int):
    """Distinct words and distinct grams of a chunk in the order of their buckets, then by key: bucket, key, times in training texts.

    Both sides of an exchange make this order themselves, so that answers need no keys.
    """
    held: tuple[list, list] = ([], [])
    for trained in (True, False):
        some = [texts[k] for k in np.flatnonzero(held_out != trained)]
        for i, j in batches_by_bytes(np.fromiter(map(len, some), np.int64, len(some)), 2 << 20):
            for kind, keys in zip(held, _batch_keys(some[i:j])):
                distinct, times = np.unique(keys, return_counts=True)
                kind.append((distinct, times * trained))
    for kind, of_bucket in zip(held, (lambda k: k, lambda k: k >> _U64(8) & _U64((1 << 8 * (_TOP + 1)) - 1))):
        keys, times = _merged(np.concatenate([k for k, _ in kind]), np.concatenate([n for _, n in kind]))
        bucket = (mix(of_bucket(keys)) % _U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        yield bucket[order], keys[order], times[order]


_ASKED = "chunk int, bucket int, n_words int, words binary, word_times binary, n_grams int, grams binary, gram_times binary"


def _questions(chunk: int, texts: list[bytes], held_out: np.ndarray, buckets: int) -> pa.Table:
    """A row for each bucket that the chunk has keys of."""
    found = list(_chunk_keys(texts, held_out, buckets))
    limits = [np.searchsorted(bucket, np.arange(buckets + 1)) for bucket, _, _ in found]
    rows = []
    for k in range(buckets):
        row = [chunk, k]
        for (_, keys, times), limit in zip(found, limits):
            i, j = limit[k], limit[k + 1]
            row += [j - i, _pack(keys[i:j]), _pack(times[i:j])]
        if row[2] or row[5]:
            rows.append(row)
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
    names = ("chunk", "bucket", "n_words", "words", "word_times", "n_grams", "grams", "gram_times")
    return pa.table({name: pa.array([r[c] for r in rows], kind) for c, (name, kind) in enumerate(zip(names, kinds))})


def _asked(table: pa.Table, kind: str):
    """The keys and times of each row in turn."""
    n, keys, times = (table.column(c) for c in (f"n_{kind}s", f"{kind}s", f"{kind}_times"))
    for k in range(len(table)):
        m = n[k].as_py()
        yield _unpack(keys[k].as_py(), m, _U64), _unpack(times[k].as_py(), m, np.int64)


def _all_asked(table: pa.Table, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a bucket, sorted, with their times added up; few rows are unpacked at once."""
    held, size, most = [(np.zeros(0, _U64), np.zeros(0, np.int64))], 0, 1 << 21
    for keys, times in _asked(table, kind):
        held.append((keys, times))
        size += len(keys)
        if size > max(most, len(held[0][0])):
            held, size = [_merged(np.concatenate([k for k, _ in held]), np.concatenate([t for _, t in held]))], 0
    return _merged(np.concatenate([k for k, _ in held]), np.concatenate([t for _, t in held]))


#: The node under which a bucket reports its words: tokens as zeros, distinct words of training texts as ones.
_WORDS = -1


def _roots(table: pa.Table) -> pa.Table:
    """A bucket's subtrees weighed upwards: what their roots add up to for each parent; and its words."""
    _, tokens = _all_asked(table, "word")
    keys, times = _all_asked(table, "gram")
    own = times > 0
    _, levels = _lower(keys[own], times[own])
    _, _, weighted = _up(levels, _TOP + 1)
    node, zeros, ones = levels[0]
    above, at = np.unique(node & _U64(_mask(_TOP)), return_inverse=True)
    zeros, ones, weighted = (np.bincount(at, x, len(above)) for x in (zeros, ones, weighted))
    report = (_WORDS, tokens.sum(), np.count_nonzero(tokens), 0.0)
    columns = (above.view(np.int64), zeros.astype(np.int64), ones.astype(np.int64), weighted.astype(np.float64))
    return pa.table({c: np.append(x, np.asarray(r, x.dtype)) for c, x, r in zip(("node", "zeros", "ones", "weighted"), columns, report)})


_ANSWERS = "chunk int, bucket int, n_words int, words binary, n_grams int, grams binary"


def _answers(table: pa.Table, top: _Top) -> pa.Table:
    """For each row of a bucket its words' counts and its grams' natural log probabilities, in the order of its keys."""
    words, tokens = _all_asked(table, "word")
    keys, times = _all_asked(table, "gram")
    own = times > 0
    by_level, levels = _lower(keys[own], times[own])
    stop, parents, _ = _up(levels, _TOP + 1)
    at = np.searchsorted(top.last, levels[0][0] & _U64(_mask(_TOP)))
    whole, nodes, _, _ = _down(levels, by_level, stop, parents, top.mixed[at], top.left[at])
    value = ContextTree((*top.whole, *whole), (*top.nodes, *nodes)).log_probability(keys).astype(np.float32)
    of_words = [_pack(tokens[np.searchsorted(words, k)]) for k, _ in _asked(table, "word")]
    of_grams = [_pack(value[np.searchsorted(keys, k)]) for k, _ in _asked(table, "gram")]
    out = table.select(["chunk", "bucket", "n_words", "n_grams"])
    return pa.table({"chunk": out["chunk"], "bucket": out["bucket"], "n_words": out["n_words"], "words": pa.array(of_words, pa.binary()), "n_grams": out["n_grams"], "grams": pa.array(of_grams, pa.binary())})


def _answered(table: pa.Table, kind: str, value: type) -> np.ndarray:
    """All answers to a chunk in the order of _chunk_keys."""
    order = np.argsort(table.column("bucket").to_numpy())
    n, packed = table.column(f"n_{kind}s").to_pylist(), table.column(f"{kind}s")
    return np.concatenate([_unpack(packed[int(k)].as_py(), n[k], value) for k in order])


# ---------------------------------------------------------------- scores

_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, code_length double"


def score_documents(docs: DataFrame, folds: int = 7, held_fold: int = 2, chunk_bytes: int = 16 << 20) -> DataFrame:
    """Scores of all documents under a model of those not held out.

    Held out are documents whose crc32(doc_id as text) mod `folds` is `held_fold`. Tokens are
    words, A-Z lower-cased, and one end a document. Returns doc_id, held_out, n_tokens, n_known (tokens that the
    training text has), train_tokens, base_score (log10 probability with add-one unigrams), score
    (log10 probability of the text's tokens, as words divided by one space and an end byte, by context-tree weighting), code_length
    (bits per byte of that).

    Null text is empty: its end alone is scored. A null doc_id counts as the text "null". Repeated rows are trained on
    and scored each; extra columns are ignored; an empty table gives no rows. Documents are dealt by hash to chunks of about
    `chunk_bytes`; each chunk sends every distinct word and gram once, packed by bucket, so counts are pre-aggregated, and gets its own
    words' counts and grams' probabilities back. A bucket has all grams with some last _TOP + 1 bytes of context: whole subtrees, which it
    weighs upwards; the driver weighs the few nodes above; then each bucket goes down its subtrees and answers.
    No context is left out, and neither the words nor the tree of the whole corpus are ever in one place.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % folds == held_fold
    slim = slim.withColumn("held_out", held)
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(parallelism(spark), math.ceil(size / chunk_bytes))
    dealt = slim.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")).repartition(n, "chunk")

    def seen(key, table):
        held_out = table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        return _questions(key[0].as_py(), utf8_rows(table.column("text")), held_out, n)

    asked = stored(dealt.groupBy("chunk").applyInArrow(seen, _ASKED))
    roots = asked.groupBy("bucket").applyInArrow(_roots, _ROOTS).groupBy("node").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "weighted"))).toArrow()
    node, zeros, ones, below = (roots.column(c).to_numpy() for c in ("node", "zeros", "ones", "weighted"))
    sums, distinct = zeros[node == _WORDS].sum(), ones[node == _WORDS].sum()
    order = np.argsort(node)[np.count_nonzero(node == _WORDS) :]
    top = spark.sparkContext.broadcast(_weigh_top(node[order].view(_U64), zeros[order], ones[order], below[order]))
    n_train = slim.where(~F.col("held_out")).count()
    n_all, n_distinct = int(sums + n_train), int(distinct + (n_train > 0))
    answers = asked.groupBy("bucket").applyInArrow(lambda table: _answers(table, top.value), _ANSWERS)

    def score(key, texts_table, answers_table):
        texts = utf8_rows(texts_table.column("text"))
        held_out = texts_table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        (_, word, _), (_, known, _) = _chunk_keys(texts, held_out, n)
        word, c = _sorted(word, _answered(answers_table, "word", np.int64))
        known, value = _sorted(known, _answered(answers_table, "gram", np.float32))
        out = {k: [] for k in ("n_tokens", "n_known", "base_score", "score", "code_length")}
        less = math.log10(n_all + n_distinct + 1)
        for i, j in batches_by_bytes(np.fromiter(map(len, texts), np.int64, len(texts)), 1 << 20):
            hashes, counts = word_hashes(texts[i:j])
            own = c[np.searchsorted(word, hashes)] if len(hashes) else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(j - i), counts)
            base = np.bincount(owner, np.log10(own + 1.0), j - i) + math.log10(n_train + 1) - (counts + 1) * less
            gram, owner2 = grams(*canonical(texts[i:j]))
            own_gram, at = np.unique(gram, return_inverse=True)
            natural = np.bincount(owner2, value[np.searchsorted(known, own_gram)][at], j - i)
            out["n_tokens"].append(counts + 1)
            out["n_known"].append(np.bincount(owner, own > 0, j - i).astype(np.int64) + (n_train > 0))
            out["base_score"].append(base)
            out["score"].append(natural / math.log(10))
            out["code_length"].append(-natural / math.log(2) / np.bincount(owner2, minlength=j - i))
        cells = {k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}
        ids = texts_table.column("doc_id")
        return pa.table({"doc_id": ids, "held_out": texts_table.column("held_out"), "n_tokens": cells["n_tokens"].astype(np.int64), "n_known": cells["n_known"].astype(np.int64), "train_tokens": np.full(len(ids), n_all, np.int64), "base_score": cells["base_score"], "score": cells["score"], "code_length": cells["code_length"]})

    left = dealt.select("chunk", "doc_id", "text", "held_out").toDF("chunk", "doc_id", "text", "held_out")
    right = answers.toDF("chunk", "bucket", "n_words", "words", "n_grams", "grams")
    return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(score, _SCORES)


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], values[order]
