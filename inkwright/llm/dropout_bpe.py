"""SentencePiece BPE encoding and decoding with seeded merge-dropout."""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.llm.common import IdTable, batches_by_bytes, code_points, in_a_row, mix, spans, taken

_U64, _MASK = np.uint64, (1 << 64) - 1
_ENCODED = "doc_id long, n_pieces long, ids array<int>, lossless boolean"
SPACE = "▁"
#: Stands for a space mark in the text itself; no text holds a lone surrogate.
MARK = "\ud800"
#: Segments up to this many characters are merged many at a time; longer or odd ones alone.
WIDE = 24


def _mix(x: int) -> int:
    """The 64-bit finaliser of common.mix for a Python integer."""
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & _MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & _MASK
    return x ^ x >> 31


class _Lookup:
    """A read-only table from whole numbers below 2**62 to numbers: a mixed key names a slot, and probing is bounded by the longest run."""

    def __init__(self, found: dict[int, int]):
        self.bits, self.longest = max(10, (4 * len(found)).bit_length()), 1
        self.keys, self.values = np.full((1 << self.bits) + 64, -1, np.int64), np.full((1 << self.bits) + 64, -1, np.int32)
        for key in sorted(found):
            at, run = (key * 0x9E3779B97F4A7C15 & _MASK) >> (64 - self.bits), 1
            while self.keys[at] >= 0:
                at, run = at + 1, run + 1
            self.keys[at], self.values[at], self.longest = key, found[key], max(self.longest, run)

    def get(self, key: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none or the key is negative."""
        at = (key.view(_U64) * _U64(0x9E3779B97F4A7C15) >> _U64(64 - self.bits)).astype(np.int64)
        out = np.full(key.shape, -1, np.int32)
        todo = np.flatnonzero(key >= 0)
        for _ in range(self.longest):
            if not len(todo):
                break
            hit = self.keys[at[todo]] == key[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (self.keys[at[todo]] >= 0)]
            at[todo] += 1
        return out


class MergeDropout:
    """Merge-type segmentation with keyed dropout.

    A text is a space and the text itself, cut into segments: spaces and the characters after
    them up to the next space, which no piece of the vocabulary reaches across. In each segment
    an agenda takes the candidate merges by score, the leftmost among equals; a candidate is skipped when
    a hash keyed by (seed, document, number of the segment, place, merged piece) falls below `rate`. So every occurrence
    of a word draws for itself. A segment's ids depend on which of its candidates are skipped; that pattern is
    worked out for all occurrences at once, and a worker keeps the ids of the (segment, pattern) pairs it has merged.
    Characters that the vocabulary lacks become their UTF-8 bytes. With rate 0 the ids are those of the
    SentencePiece library.
    """

    def __init__(self, path: str, rate: float, seed: int):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [k for k in range(n) if not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k))]
        self.ids = {sp.id_to_piece(k): k for k in plain}
        self.characters = {(" " if p == SPACE else p): k for p, k in self.ids.items() if len(p) == 1}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        by_score = sorted(plain, key=lambda k: -sp.get_score(k))
        self.rank = np.full(n, 1 << 30, np.int32)
        self.rank[by_score] = np.arange(len(by_score))
        self.surface = [b""] * n
        for piece, k in self.ids.items():
            self.surface[k] = piece.replace(SPACE, " ").encode()
        for b, k in enumerate(self.byte_ids):
            self.surface[k] = bytes([b])
        self.limit = int(rate * 2**64)
        self.seed = seed
        breaks = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        self.breaks = np.array([ord(c) for c in breaks], np.uint32)
        # an inner space mark would let merges cross segments: then texts are segments
        self.whole = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.pairs = self._pair_table()
        self.letter = np.full(0x110000, -1, np.int32)
        self.letter[[ord(c) for c in self.characters]] = list(self.characters.values())
        self.letter[ord(SPACE)] = -1  # one in the text is not a space
        self.steps, self.made = self._trie()
        self.candidates, self.table = IdTable(), IdTable()

    def _pair_table(self) -> _Lookup:
        """Merged piece of each pair of pieces."""
        found = {}
        for piece, k in self.ids.items():
            for i in range(1, len(piece)):
                a, b = self.ids.get(piece[:i]), self.ids.get(piece[i:])
                if a is not None and b is not None:
                    found[a << 20 | b] = k
        return _Lookup(found)

    def _trie(self) -> tuple[_Lookup, np.ndarray]:
        """From a beginning of pieces (0: nothing) and a letter to the longer beginning; and the piece that each is, if merges can make it."""
        found: dict[int, int] = {}
        made, nodes = [-1], {"": 0}
        makeable = set(self.pairs.values[self.pairs.values >= 0].tolist())
        for piece, k in self.ids.items():
            if k in makeable and SPACE not in piece[1:]:
                letters = piece.replace(SPACE, " ")
                for n in range(1, len(letters) + 1):
                    if letters[:n] not in nodes:
                        nodes[letters[:n]] = len(made)
                        found[nodes[letters[: n - 1]] << 21 | ord(letters[n - 1])] = len(made)
                        made.append(-1)
                made[nodes[letters]] = k
        return _Lookup(found), np.asarray(made, np.int32)

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        key[(left < 0) | (right < 0)] = -2
        return self.pairs.get(key)

    def _dropped(self, key: np.ndarray, start: np.ndarray, piece: np.ndarray) -> np.ndarray:
        x = key ^ (start.astype(_U64) * _U64(0xD6E8FEB86659FD93) + piece.astype(_U64))
        return mix(x) < _U64(min(self.limit, _MASK))

    def _agenda(self, key: int, segment: str) -> bytes:
        """One segment by a heap of candidate merges; for long segments and such with characters that the vocabulary lacks."""
        # a space mark in the text itself is a character like others, not a space
        symbols: list[str | None] = [SPACE if c == " " else MARK if c == SPACE else c for c in segment]
        ids = [self.ids.get(c, -1) if c != MARK else -1 for c in symbols]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i < 0 or j >= n or MARK in (symbols[i], symbols[j]):
                return
            k = self.ids.get(symbols[i] + symbols[j])
            if k is not None and ids[i] >= 0 and ids[j] >= 0:
                heapq.heappush(heap, (int(self.rank[k]), i, k, len(symbols[i]) + len(symbols[j])))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, k, length = heapq.heappop(heap)
            j = after[i] if symbols[i] is not None else n
            if j >= n or len(symbols[i]) + len(symbols[j]) != length:
                continue
            if _mix(key ^ (i * 0xD6E8FEB86659FD93 + k & _MASK)) < self.limit:
                continue
            symbols[i], ids[i], symbols[j] = symbols[i] + symbols[j], k, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        out: list[int] = []
        for i in range(n):
            if symbols[i] is not None:
                out += [ids[i]] if ids[i] >= 0 else [self.byte_ids[b] for b in (SPACE if symbols[i] == MARK else symbols[i]).encode()]
        return np.asarray(out, "<i4").tobytes()

    def _many(self, key: np.ndarray, letters: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All segments (letters in a row, and sizes) at once, each with its key: in each round every segment takes its best candidate that is not dropped.

        Symbols stay at their first character; links to the next and previous symbol skip what merged away.
        """
        n, width = len(size), int(size.max())
        inside = np.arange(width)[None, :] < size[:, None]
        sym = np.full((n, width), -1, np.int32)
        sym[inside] = letters
        after = np.where(np.arange(1, width + 1)[None, :] < size[:, None], np.arange(1, width + 1, dtype=np.int16)[None, :], np.int16(-1))
        before = np.broadcast_to(np.arange(-1, width - 1, dtype=np.int16), sym.shape).copy()
        none = np.int32((1 << 30) + 1)
        piece = np.full((n, width), -1, np.int32)
        order = np.full((n, width), none, np.int32)

        def offer(r: np.ndarray, c: np.ndarray) -> None:
            made = self._merged(sym[r, c], sym[r, after[r, c]])
            piece[r, c] = made
            best = np.where(made >= 0, self.rank[made], none)
            some = np.flatnonzero(made >= 0)
            if self.limit and len(some):
                dropped = some[self._dropped(key[r[some]], c[some], made[some])]
                best[dropped] = none
            order[r, c] = best

        offer(*np.nonzero(after >= 0))
        live = np.arange(n)
        while True:
            ranks = order[live]
            at = ranks.argmin(1)
            go = ranks[np.arange(len(live)), at] < none
            live, at = live[go], at[go]
            if not len(live):
                break
            gone = after[live, at]
            sym[live, at] = piece[live, at]
            following = after[live, gone]
            after[live, at] = following
            sym[live, gone] = -1
            order[live, gone] = none
            order[live, at] = none
            right = following >= 0
            before[live[right], following[right]] = at[right]
            previous = before[live, at]
            left = previous >= 0
            offer(np.concatenate((live[right], live[left])), np.concatenate((at[right], previous[left])))
        kept = sym >= 0
        return sym[kept], kept.sum(1)

    def code(self, keys: np.ndarray, points: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of segments of known characters, each under its key, in a row, and how many each has."""
        order = np.argsort(after - first, kind="stable")
        held = []
        for at in range(0, len(order), 4096):
            part = order[at : at + 4096]
            letters, size = taken(points, first[part], after[part])
            held.append(self._many(keys[part], self.letter[letters], size))
        counts = np.zeros(len(order), np.int64)
        counts[order] = np.concatenate([c for _, c in held])
        flat, ends = np.concatenate([f for f, _ in held]), np.cumsum(counts[order])
        begin = np.zeros(len(order), np.int64)
        begin[order] = ends - counts[order]
        return taken(flat, begin, begin + counts)

    def _possible(self, points: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All merges that an agenda may meet in some segments, as place << 20 | piece, in a row, and how many each segment has.

        Every place of every segment walks down the trie of pieces, all places a letter at a time.
        """
        sizes = (after - first).astype(np.int64)
        row = np.repeat(np.arange(len(first)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at, node, held = first[row] + place, np.zeros(len(row), np.int64), []
        while len(row):
            node = self.steps.get(node << 21 | points[at].astype(np.int64)).astype(np.int64)
            piece = np.where(node >= 0, self.made[node], -1)
            some = np.flatnonzero(piece >= 0)
            held.append((row[some], place[some].astype(np.int32) << 20 | piece[some]))
            at += 1
            go = np.flatnonzero((node >= 0) & (at < after[row]))
            row, place, at, node = row[go], place[go], at[go], node[go]
        rows = np.concatenate([r for r, _ in held])
        order = np.argsort(rows, kind="stable")
        return np.concatenate([m for _, m in held])[order].astype(np.int32), np.bincount(rows, minlength=len(first))

    def _patterns(self, keys: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """A hash of the possible merges that each segment's key skips."""
        possible, sizes = self.candidates.gather(entries)
        ends = np.cumsum(sizes)
        skipped = np.flatnonzero(self._dropped(np.repeat(keys, sizes), possible >> 20, possible & (1 << 20) - 1))
        total = np.append(_U64(0), np.cumsum(mix(possible[skipped].astype(_U64) + _U64(1)), dtype=_U64))
        upto = total[np.searchsorted(skipped, ends)]
        return mix(np.diff(upto, prepend=_U64(0)))

    def _segments(self, points: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """Starts of the segments: spaces with what follows them, and single breaks; `opens` are the texts' starts."""
        start = np.zeros(len(points), bool)
        start[opens] = True
        if not self.whole:
            space, brk = points == 32, np.isin(points, self.breaks)
            start |= brk
            start[1:] |= space[1:] & ~space[:-1]
            start[1:] |= ~space[1:] & brk[:-1]
        return np.flatnonzero(start)

    def encode(self, ids: list[int], texts: list[str]) -> list[bytes]:
        """Piece ids of each text as little-endian int32."""
        spaced = [" " + t if t else "" for t in texts]
        sizes = np.fromiter(map(len, spaced), np.int64, len(spaced))
        ends = np.cumsum(sizes)
        points = code_points(spaced)
        if not len(points):
            return [b""] * len(texts)
        first = self._segments(points, (ends - sizes)[sizes > 0])
        after = np.append(first[1:], len(points))
        upto = np.searchsorted(first, ends)
        counts = np.diff(upto, prepend=0)
        of_text = np.fromiter((_mix((x & _MASK) ^ _mix(self.seed + 0x2545F491)) for x in ids), _U64, len(ids))
        number = np.arange(len(first)) - np.repeat(upto - counts, counts)
        keys = mix(np.repeat(of_text, counts) + mix(number.astype(_U64)))
        odd = (after - first > WIDE) | (np.add.reduceat(self.letter[points] < 0, first, dtype=np.int64) > 0)
        easy, hard = np.flatnonzero(~odd), np.flatnonzero(odd)
        entries = np.zeros(len(first), np.int32)

        if len(easy):
            hashes, own, begin, end = spans(points, first)(first[easy], after[easy]), keys[easy], first[easy], after[easy]
            if self.limit:
                possible = self.candidates.resolve(hashes, points, begin, end, lambda rows: self._possible(points, begin[rows], end[rows]))
                hashes = mix(hashes ^ self._patterns(own, possible))
            entries[easy] = self.table.resolve(hashes, points, begin, end, lambda rows: self.code(own[rows], points, begin[rows], end[rows]))
        segments = [points[i:j].tobytes().decode("utf-32-le") for i, j in zip(first[hard].tolist(), after[hard].tolist())]
        coded = in_a_row([self._agenda(k, s) for k, s in zip(keys[hard].tolist(), segments)])
        entries[hard] = self.table.add(np.zeros(len(hard), _U64), *coded, points[:0], np.zeros(len(hard), np.int64))
        flat, pieces = self.table.gather(entries)
        edges = (np.append(0, np.cumsum(pieces))[upto] * 4).tolist()
        flat = flat.astype("<i4").tobytes()
        return [flat[i:j] for i, j in zip([0, *edges[:-1]], edges)]

    def decode(self, ids: list[int]) -> str:
        """The text of piece ids; the inverse of encode for every text, whatever was dropped."""
        surface = self.surface
        return b"".join([surface[k] for k in ids]).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=4)
def _tokenizer(path: str, rate: float, seed: int) -> MergeDropout:
    return MergeDropout(path, rate, seed)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, model_path: str, rate: float = 0.1, seed: int = 17) -> DataFrame:
    """Every document's piece ids under merge-dropout: doc_id, n_pieces, ids, lossless.

    lossless: decoding the ids gives back exactly the text. Texts are encoded whole. Null and empty texts have no
    pieces. The draw depends on seed and doc_id alone (a null doc_id counts as 0), so repeated rows are
    encoded alike and lost tasks repeat their result. Extra columns are ignored; an empty table gives no rows. Nothing is shuffled.
    """

    def scan(batches):
        tokenizer = _tokenizer(model_path, rate, seed)
        for batch in batches:
            ids, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
            numbers = [x or 0 for x in ids.to_pylist()]
            for i, j in batches_by_bytes(np.fromiter(map(len, texts), np.int64, len(texts)), 1 << 20):
                coded = tokenizer.encode(numbers[i:j], texts[i:j])
                sizes = np.fromiter(map(len, coded), np.int64, j - i) // 4
                flat = np.frombuffer(b"".join(coded), "<i4")
                offsets = np.concatenate(([0], np.cumsum(sizes)))
                lossless = [tokenizer.decode(flat[a:b].tolist()) == t for a, b, t in zip(offsets[:-1], offsets[1:], texts[i:j])]
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat)), pa.array(lossless)], ["doc_id", "n_pieces", "ids", "lossless"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, _ENCODED)


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """The texts of piece ids: doc_id, text. Null ids are a null text."""

    def scan(batches):
        tokenizer = _tokenizer(model_path, 0.0, 0)
        for batch in batches:
            texts = [None if x is None else tokenizer.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(scan, "doc_id long, text string")
