"""Best-fit packing by minimum bin slack over the histogram of piece lengths."""

from __future__ import annotations

import os
import sys
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwright.llm.common import IdTable, code_points, cut, in_a_row, spans, text_parts, tidied

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", sequence_id long, offset long"


# ---------------------------------------------------------------- tokens


SPACE, LETTER, NUMBER, OTHER, ODD = range(5)


def _classes() -> np.ndarray:
    """The class of each code point below U+0250; ODD ones are left to the tokenizer, with their whole text.

    ODD are controls, special spaces and letters whose lower case is two characters.
    """
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.full(0x251, ODD, np.uint8)
    for c in range(0x250):
        kind = unicodedata.category(chr(c))
        if chr(c) in " \t\n\r":
            out[c] = SPACE
        elif kind not in ("Cc", "Zs") and len(chr(c).lower()) == 1:
            out[c] = kinds.get(kind[0], OTHER)
    return out


class WordTokens:
    """Token ids of whole texts, word by word, with a table of the words' ids.

    The vocabulary's split into words, stated below, comes before any merge, so a text's ids are its words' ids in order. That this is the
    file's split is tried on PROBES first.
    Texts of common Latin characters are split with array operations and only unseen words
    go to the tokenizer; any other text goes to it whole.
    """

    #: Fixed values of the vocabulary file's word split: these contractions, else runs of letters, single numbers, runs of other marks.
    CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

    #: Texts that another word split would cut otherwise.
    PROBES = ("It's we'll THEY'D don''t 'tis 'S x'rex", "a1b22 3.14 ½² v2.0-rc_1", "  two\t tabs\n\nlines ", "naïve Über-größe ÆØ ǅ ʼn", "(a)[b]{c} <d> @e #f $5 %6 &g *h_i_ ~j", "…–—“x” «y» !?!,;:", "")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.kinds = _classes()
        self.lower = np.arange(0x251, dtype="<u4")
        for c in np.flatnonzero(self.kinds < ODD):
            self.lower[c] = ord(chr(c).lower())
        self.table = IdTable(most=1 << 19, bits=20, kind=np.uint16)  # lower-cased characters below U+0250 are below 2**16
        # a vocabulary with another word split gets every text whole
        self.splits = True
        self.splits = self.encode([*self.PROBES]) == self._ids([*self.PROBES])

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<i4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of single words, from one call: the last token of each word carries the word-end mark."""
        ids = np.asarray(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<i4")
        ends = np.flatnonzero(self.last[ids]) + 1 if len(ids) else ids
        if len(ends) != len(words):
            return self._ids(words)
        flat, stops = ids.tobytes(), (ends * 4).tolist()
        return [flat[i:j] for i, j in zip([0, *stops[:-1]], stops)]

    def _words(self, kinds: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words."""
        n = len(kinds)
        start = (kinds != SPACE) & (kinds == NUMBER)
        start[0] |= kinds[0] != SPACE
        start[1:] |= (kinds[1:] != SPACE) & (kinds[1:] != kinds[:-1])
        quotes = np.flatnonzero((low == ord("'")) & start)
        for text in self.CONTRACTIONS:
            at = quotes[quotes + len(text) <= n]
            for k, c in enumerate(text[1:], 1):
                at = at[low[at + k] == ord(c)]
            start[at + 1] = False
            after = at + len(text)
            after = after[after < n]
            start[after] |= kinds[after] == LETTER
        edge = np.flatnonzero(start | (kinds == SPACE))
        own = start[edge]
        return edge[own], np.append(edge[1:], n)[own]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian int32 ids of each text."""
        points = code_points([t + " " for t in texts])
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        near = np.minimum(points, 0x250)
        kinds = self.kinds[near]
        odd = np.add.reduceat(kinds == ODD, ends - sizes) > 0 if len(texts) else np.zeros(0, bool)
        odd |= np.fromiter((not self.splits or "<|" in t for t in texts), bool, len(texts))
        if odd.any():
            kinds = np.where(np.repeat(odd, sizes), SPACE, kinds)
        low = self.lower[near]
        if not len(texts):
            return []
        first, after = self._words(kinds, low)

        def code(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return in_a_row(self._word_ids([low[i:j].tobytes().decode("utf-32-le") for i, j in zip(first[rows].tolist(), after[rows].tolist())]))

        entries = self.table.resolve(spans(low, first)(first, after), low, first, after, code) if len(first) else np.zeros(0, np.int32)
        flat, counts = self.table.gather(entries)
        upto = np.append(0, np.cumsum(counts))[np.searchsorted(first, ends)] * 4
        flat = flat.astype("<i4").tobytes()
        out = [flat[i:j] for i, j in zip([0, *upto[:-1].tolist()], upto.tolist())]
        whole = np.flatnonzero(odd)
        for k, ids in zip(whole, self._ids([texts[k] for k in whole])):
            out[k] = ids
        return out


_WORKER: dict[str, WordTokens] = {}


def tokens_of(path: str) -> WordTokens:
    """One tokenizer a worker process."""
    if path not in _WORKER:
        _WORKER[path] = WordTokens(path)
    return _WORKER[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32.

    A document is its token ids and one end id; only one longer than `capacity` is cut, every
    `capacity` tokens. Null text is empty: one piece, the end id alone.
    """
    end = np.asarray([end_id], "<u4").tobytes()
    step = 4 * capacity

    def pieces(batches):
        tokens = tokens_of(tokenizer_path)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, j, part in text_parts(batch.column("text")):
                rows: list[tuple] = []
                for doc, encoded in zip(ids[i:j], tokens.encode([t or "" for t in part.to_pylist()])):
                    encoded += end
                    for n, at in enumerate(range(0, len(encoded), step)):
                        part = encoded[at : at + step]
                        rows.append((doc, n, at // 4, len(part) // 4, zlib.crc32(part)))
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return slim.mapInArrow(tidied(pieces), _PIECES)


# ---------------------------------------------------------------- plan


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest total up to `room`: length to how many.

    Subset sums are the bits of an integer; each length enters in binary portions of its count,
    longest first, until the room can be filled exactly.
    """
    mask = (1 << (room + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, portion = min(counts[length], room // length), 1
        while left:
            take = min(portion, left)
            steps.append((reach, length, take))
            reach = (reach | reach << length * take) & mask
            left -= take
            portion *= 2
        if reach >> room & 1:
            break
    total, found = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            found[length] = found.get(length, 0) + take
    return found


def minimum_slack_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins to fill: (how many alike, [(length, pieces of it in a bin), ...]).

    Each bin starts with the longest piece left and the fullest feasible combination beside it,
    which is then removed. While all its pieces are there again, the same combination is still the fullest
    for that longest piece among the lengths it was found with, so it is removed as often as the counts allow
    at once: the plan's length depends on the distinct lengths, at most `capacity`, and not on the data's size.
    """
    left = {length: n for length, n in histogram.items() if n > 0}
    plan = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        combination = fullest({x: n for x, n in rest.items() if n}, capacity - longest)
        combination[longest] = combination.get(longest, 0) + 1
        times = min(left[x] // n for x, n in combination.items())
        plan.append((times, sorted(combination.items(), reverse=True)))
        for x, n in combination.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return plan


def plan_table(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, pieces a bin, offset in the bin) in order of rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, combination in plan:
        offset = 0
        for length, n in combination:
            rows.setdefault(length, []).append((used.get(length, 0), sequence, n, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {length: np.asarray(r, np.int64) for length, r in rows.items()}


# ---------------------------------------------------------------- packing


def pack_pieces(pieces: DataFrame, capacity: int = 2048, salt_rows: int = 50_000) -> DataFrame:
    """Pieces with their place: sequence_id and offset, gapless, in sequences of at most `capacity`.

    Only the histogram of lengths (at most `capacity` rows) reaches the driver, which plans all
    bins by minimum bin slack; pieces of one length are interchangeable, so each takes the
    place of its rank among them. Ranks are counted in (length, salt) groups of about
    `salt_rows`, so a length that a third of the pieces share is spread over many tasks. The plan that
    is sent back has a few rows per length.
    """
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = plan_table(minimum_slack_plan(counts, capacity))
    salts = max(16, int(max(counts.values(), default=0) // salt_rows) + 1)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    bases = groups.select("length", "salt", before.alias("base"))
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("r", rank.cast("long")).join(bases, ["length", "salt"]).withColumn("r", F.col("r") + F.col("base"))

    def place(batches):
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("r").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            distinct, first = np.unique(lengths[order], return_index=True)
            for length, rows in zip(distinct, np.split(order, first[1:])):
                slots = table[int(length)]
                slot = slots[np.searchsorted(slots[:, 0], ranks[rows], "right") - 1]
                inside = ranks[rows] - slot[:, 0]
                sequence[rows] = slot[:, 1] + inside // slot[:, 2]
                offset[rows] = slot[:, 3] + inside % slot[:, 2] * length
            named = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*named, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "r").mapInArrow(place, _PACKED)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """All documents packed into as few sequences of at most `capacity` tokens as minimum bin slack finds.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Texts are
    tokenized whole, once, into a checkpointed table of pieces without texts. Null text is
    empty and packs its end id. Repeated documents are packed each; an empty table gives no
    rows; extra columns are ignored.
    """
    return pack_pieces(cut(token_pieces(docs, tokenizer_path, capacity, end_id)), capacity)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


if sys.byteorder != "little":  # pragma: no cover
    raise ImportError("token ids are packed as little-endian integers")
