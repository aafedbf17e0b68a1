"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which driver and executors share.

    Where it is unset, a session of one machine (local, as in tests) gets a folder of its own; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not named and not re.match(r"local(\[[^,\]]*(,[^\]]*)?\])?$", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="inkwright-"))
    return sc.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    shared_dir(spark)


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a checkpoint in the shared folder, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables of one call in the shared folder: each is written at once, which cuts lineage, and goes when it is dropped.

    Tables that a lazy result still reads stay, in one folder a call.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.place = spark, f"{shared_dir(spark)}/tables-{uuid.uuid4().hex}"
        self.held: list[tuple[DataFrame, str]] = []

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.place}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((read, path))
        return read

    def drop(self, *tables: DataFrame) -> None:
        """Remove the files of these tables."""
        for one in tables:
            for df, path in self.held:
                if df is one:
                    remove(self.spark, path)
        self.held = [x for x in self.held if not any(x[0] is one for one in tables)]

    def keep(self, *tables: DataFrame) -> None:
        """Remove the files of all other tables."""
        self.drop(*[df for df, _ in self.held if not any(df is one for one in tables)])


#: Bits of the table that tells which rows may have a wanted id: 2^19 words of 64, 12 MB, however many ids are wanted.
_ID_BITS = 25


def _id_bits(id_: str) -> tuple:
    at = F.shiftrightunsigned(F.xxhash64(F.col(id_).cast("long")), 64 - _ID_BITS)
    return F.shiftright(at, 6).alias("_word"), at.bitwiseAND(63).cast("int").alias("_bit")


def _id_words(wanted: DataFrame, id_: str) -> DataFrame:
    word, bit = _id_bits(id_)
    return F.broadcast(wanted.select(word, bit).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_mask")))


def perhaps_among(rows: DataFrame, wanted: DataFrame, id_: str, among: bool = True) -> DataFrame:
    """The rows whose id may be one of those wanted, or, with `among` false, those whose id is none of them for sure.

    Of rows with wanted ids none is missing among the first. An exact join after this shuffles few other rows, and
    the table that is broadcast has a fixed bound; when more ids are wanted, more other rows pass.
    """
    word, bit = _id_bits(id_)
    here = rows.withColumns({"_word": word, "_bit": bit})
    words = _id_words(wanted, id_).withColumnRenamed("_word", "_key")
    hit = (F.col("_word") == F.col("_key")) & F.expr("getbit(_mask, _bit) = 1")
    return here.join(words, hit, "left_semi" if among else "left_anti").select(*rows.columns)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage in less space than a checkpoint."""
    return Scratch(df.sparkSession).put(df)


def parallelism(spark: SparkSession) -> int:
    """Tasks to deal work to: at least the shuffle partitions, which clusters size to their cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def lower_ascii(col):
    """Lower-case A-Z and nothing else."""
    return F.translate(col, _UPPER, _UPPER.lower())


# ---------------------------------------------------------------- vectorised word hashing

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x = x * _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


#: Values of pieces of a hash that are looked up: places in a word below 32, bytes and code points below 1024.
_PLACES, _VALUES = 32, 1024


def _piece(place: np.ndarray, value: np.ndarray) -> np.ndarray:
    """What a value at a place of its word adds to the word's hash."""
    return mix(mix(place.astype(_U64) + _U64(0x9E3779B97F4A7C15)) + value.astype(_U64))


_PIECES = _piece(np.repeat(np.arange(_PLACES), _VALUES), np.tile(np.arange(_VALUES), _PLACES))


def spans(values: np.ndarray, starts: np.ndarray):
    """A function that hashes spans (first, after) of the values, bytes or code points, to 64 bits; each `first` is one of `starts`.

    A span's hash is a sum of mixed (place, value) pairs, so, unlike a polynomial modulo 2**64, no two words are known to collide.
    No Python code runs per span.
    """
    n = len(values)
    place = np.arange(n)
    if len(starts):
        place -= np.repeat(starts, np.diff(starts, append=n)) if starts[0] == 0 else np.concatenate((np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(starts, append=n))))
    wide = values.dtype.itemsize > 1
    pieces = _PIECES[np.minimum(place, _PLACES - 1) * _VALUES + (np.minimum(values, _VALUES - 1) if wide else values)]
    rest = np.flatnonzero((place >= _PLACES) | (values >= _VALUES) if wide else place >= _PLACES)
    pieces[rest] = _piece(place[rest], values[rest])
    prefix = np.zeros(n + 1, _U64)
    np.cumsum(pieces, dtype=_U64, out=prefix[1:])

    def span(first: np.ndarray, after: np.ndarray) -> np.ndarray:
        return mix(prefix[after] - prefix[first] + (after - first).astype(_U64))

    return span


def code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")


class IdTable:
    """Token ids by 64-bit hash: an open-addressed table over one array of ids, for one worker.

    Each entry keeps the characters it stands for, and an entry found by hash is only used for the same characters.
    It holds at most `most` entries besides those of one call; when that is exceeded it starts afresh. It begins with 2**bits slots and gets more
    when one call has more new words than fit.
    """

    def __init__(self, most: int = 1_000_000, bits: int = 21, kind: type = np.uint32):
        self.most, self.least_bits, self.kind = most, bits, kind
        self.clear()

    def clear(self) -> None:
        self._slots(self.least_bits)
        self.ids, self.characters = _Lists(np.int32), _Lists(self.kind)

    def _slots(self, bits: int) -> None:
        self.bits, self.filled = bits, 0
        self.keys = np.zeros(1 << bits, _U64)
        self.place = np.zeros(1 << bits, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 where there is none."""
        out = np.full(len(hashes), -1, np.int32)
        todo = np.arange(len(hashes))
        at = (hashes >> _U64(64 - self.bits)).astype(np.int64)
        while len(todo):
            key = self.keys[at]
            hit = key == hashes[todo]
            out[todo[hit]] = self.place[at[hit]]
            on = ~hit & (key != 0)
            todo, at = todo[on], at[on] + 1 & (1 << self.bits) - 1
        return out

    def add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray, characters: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """New entries for distinct, absent hashes: ids, how many each has, and the same of characters; a hash 0 is never found again."""
        entries = self.ids.append(ids, counts)
        self.characters.append(characters, sizes)
        known = np.flatnonzero(hashes)
        if 4 * (self.filled + len(known)) > 3 << self.bits:  # a table without free slots would be searched for ever
            used = np.flatnonzero(self.keys)
            keys, place = self.keys[used], self.place[used]
            self._slots((4 * (len(used) + len(known)) // 3).bit_length())
            self._fill(keys, place)
        self._fill(hashes[known], entries[known])
        return entries

    def _fill(self, hashes: np.ndarray, entries: np.ndarray) -> None:
        """Slots for distinct, absent hashes other than 0."""
        self.filled += len(hashes)
        todo = np.arange(len(hashes))
        at = (hashes >> _U64(64 - self.bits)).astype(np.int64)
        while len(todo):
            free = np.flatnonzero(self.keys[at] == 0)
            slot, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[slot], self.place[slot] = hashes[todo[won]], entries[todo[won]]
            rest = np.ones(len(todo), bool)
            rest[won] = False
            todo, at = todo[rest], at[rest]
            at = np.where(self.keys[at] != 0, at + 1 & (1 << self.bits) - 1, at)

    def resolve(self, hashes: np.ndarray, values: np.ndarray, first: np.ndarray, after: np.ndarray, code) -> np.ndarray:
        """Entries of all spans (first, after) of the values; `code` makes the ids of the spans, given as indices, that are new, and their numbers."""
        if self.ids.count > self.most:
            self.clear()
        hashes = np.maximum(hashes, _U64(1))
        found = self.find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh, at = np.unique(hashes[new], return_index=True)
            rows = new[at]
            self.add(fresh, *code(rows), *taken(values, first[rows], after[rows]))
            found[new] = self.find(hashes[new])
        odd = self._different(found, values, first, after)
        if len(odd):  # a hash that stands for something else
            found[odd] = self.add(np.zeros(len(odd), _U64), *code(odd), *taken(values, first[odd], after[odd]))
        return found

    def _different(self, entries: np.ndarray, values: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The spans whose characters are not those of their entry."""
        sizes = (after - first).astype(np.int64)
        unlike = self.characters.size[entries] != sizes
        if unlike.any():
            sizes = np.where(unlike, 0, sizes)
        ends = np.cumsum(sizes)
        within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        own = values[np.repeat(first, sizes) + within]
        theirs = self.characters.flat[np.repeat(self.characters.start[entries], sizes) + within]
        wrong = np.flatnonzero(own != theirs)
        unlike[np.searchsorted(ends, wrong, "right")] = True
        return np.flatnonzero(unlike)

    def gather(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all entries in a row, and how many each has."""
        return self.ids.gather(entries)


def taken(values: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of some spans in a row, and the spans' sizes."""
    sizes = (after - first).astype(np.int64)
    ends = np.cumsum(sizes)
    return values[np.repeat(first - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)], sizes


def in_a_row(coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Little-endian int32 lists in a row, and how many numbers each has."""
    return np.frombuffer(b"".join(coded), "<i4"), np.fromiter(map(len, coded), np.int64, len(coded)) // 4


class _Lists:
    """Lists of numbers in one array that grows."""

    def __init__(self, kind: type):
        self.flat, self.start, self.size = np.zeros(1 << 18, kind), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.count = self.used = 0

    def append(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places of the new lists, given in a row with their sizes."""
        n = len(sizes)
        while self.count + n > len(self.start):
            self.start, self.size = np.concatenate((self.start, np.zeros_like(self.start))), np.concatenate((self.size, np.zeros_like(self.size)))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[self.count : self.count + n] = self.used + np.cumsum(sizes) - sizes
        self.size[self.count : self.count + n] = sizes
        self.count += n
        self.used += len(flat)
        return np.arange(self.count - n, self.count, dtype=np.int32)

    def gather(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of some lists in a row, and how many each has."""
        sizes = self.size[entries].astype(np.int64)
        ends = np.cumsum(sizes)
        at = np.repeat(self.start[entries] - (ends - sizes), sizes)
        return self.flat[at + np.arange(len(at))], sizes


def _scan(texts: list[bytes], white: np.ndarray):
    """Starts and ends of the words of the joined texts, how many each text has, and a span hash.

    The hash of a span is a difference of prefix sums, so no Python code runs per word.
    """
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    gap = white[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts = edge[gap[edge - 1]]
    if len(gap) and not gap[0]:
        starts = np.concatenate(([0], starts))
    ends = edge[~gap[edge - 1]]
    limits = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return starts, ends, np.diff(np.searchsorted(starts, limits), prepend=0), spans(data, starts)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z lower-cased, and how many words each text has."""
    starts, ends, counts, span = _scan(texts, _WHITE)
    return span(starts, ends), counts


_NOT_LETTER = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def stem_hashes(texts: list[bytes], prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words (runs of letters and digits) and of their first bytes, a column each, and words per text.

    A word no longer than a prefix repeats its own hash in that column.
    """
    starts, ends, counts, span = _scan(texts, _NOT_LETTER)
    columns = [span(starts, ends), *(span(starts, np.minimum(starts + n, ends)) for n in prefixes)]
    return np.stack(columns, axis=1) if len(starts) else np.zeros((0, 1 + len(prefixes)), _U64), counts


def batches_by_bytes(lengths: np.ndarray, most: int):
    """Ranges of rows with about `most` bytes each; a longer row stands alone."""
    start, size = 0, 0
    for k, n in enumerate(lengths):
        if size and size + n > most:
            yield start, k
            start, size = k, 0
        size += int(n)
    if start < len(lengths):
        yield start, len(lengths)


#: Bytes of text that a worker works on at once: its arrays of words take some dozen times as much.
PART_BYTES = 1 << 18


def text_parts(array, most: int = PART_BYTES):
    """Ranges (first, after) of a string array with about `most` bytes each, with their slice; a longer text stands alone, null is empty."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for i, j in batches_by_bytes(lengths, most):
        yield i, j, array.slice(i, j - i)


def tidied(scan):
    """A function over batches that gives a worker's unused memory back when its task ends: idle workers stay small."""

    def run(batches):
        try:
            yield from scan(batches)
        finally:
            release()

    return run


def release() -> None:
    """Give memory that Arrow and the C library hold without use back to the system; does nothing where that is not possible."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def utf8_rows(array) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string array; null is empty."""
    import pyarrow as pa

    return [x or b"" for x in array.cast(pa.binary()).to_pylist()]
