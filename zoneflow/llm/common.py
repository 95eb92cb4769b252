"""Helpers shared by the corpus operators: held-out splits, Arrow text slices,
word dictionaries of a slice and vectorised 64-bit hashes."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 12 << 20
_LIBC = ctypes.CDLL(None)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def held_out(id_column: str, modulus: int, remainder: int) -> Column:
    """True where crc32(id as text) mod ``modulus`` is ``remainder``; a null id is never held out."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def hash_share(id_column: str, seed: int) -> Column:
    """A fixed pseudo-random number in [0, 1) for an id."""
    h = F.xxhash64(F.lit(seed), F.col(id_column))
    return F.pmod(h, F.lit(1 << 30)) / float(1 << 30)


def bounded_sample(rows: DataFrame, id_column: str, class_column: str, bound: int, weight: Column, seed: int) -> DataFrame:
    """Rows of each class such that the summed ``weight`` is expected to stay within ``bound``.

    Classes are few (labels, languages); their totals are one aggregate over
    all rows, so no group is gathered anywhere.  Rows with a null class go.
    """
    rows = rows.where(F.col(class_column).isNotNull())
    totals = {r[0]: r[1] or 0 for r in rows.groupBy(class_column).agg(F.sum(weight)).collect()}
    rates = {c: min(1.0, bound / t) for c, t in totals.items() if t > 0}
    if not rates:
        return rows.limit(0)
    keep = F.lit(False)
    for c, rate in sorted(rates.items()):
        keep = keep | ((F.col(class_column) == F.lit(c)) & (hash_share(id_column, seed) < rate))
    return rows.where(keep)


def free_memory() -> None:
    """Returns freed memory to the system: workers live on and do one stage after another."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def text_slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = SLICE_BYTES, give_back: bool = False) -> Iterator[pa.RecordBatch]:
    """Zero-copy pieces of a batch whose texts hold at most about ``max_bytes``; a longer single text is a piece of its own.

    With ``give_back``, memory that was freed before a piece goes back to the system."""
    if not batch.num_rows:
        return
    tidy = free_memory if give_back else pa.default_memory_pool().release_unused
    if give_back:
        tidy()
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > max_bytes:
            yield batch.slice(start, i - start)
            tidy()
            start, held = i, 0
        held += size
    yield batch.slice(start)
    tidy()


def keyed_rows(docs: DataFrame, id_column: str, keep: tuple[str, ...], text: str) -> DataFrame:
    """key (a struct of the id and the kept columns, so that no name can clash) and, unless it is among them, text."""
    key = F.struct(id_column, *keep).alias("key")
    return docs.select(key) if text in keep else docs.select(key, F.col(text).alias("text"))


def keyed_slices(batch: pa.RecordBatch, text: str, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(key, texts without nulls) of the pieces of a batch of ``keyed_rows``."""
    own = batch.column("text") if "text" in batch.schema.names else batch.column("key").field(text)
    for piece in text_slices(pa.RecordBatch.from_arrays([batch.column("key"), own], ["key", "text"]), max_bytes=max_bytes, give_back=True):
        yield piece.column("key"), plain_strings(piece.column("text"))


def plain_strings(column: pa.Array) -> pa.Array:
    """Texts without nulls (null: empty) as an Arrow string array."""
    return pc.fill_null(column.cast(pa.string()), "")


def ascii_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Runs without ASCII white space: row offsets, a code for each word, and the distinct words by code."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten().dictionary_encode()
    codes, words = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary
    offsets -= offsets[0]
    empty = pc.index(words, "").as_py() if len(words) else -1
    if empty >= 0:
        keep = codes != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
        codes -= codes > empty
        words = pa.concat_arrays([words.slice(0, empty), words.slice(empty + 1)])
    return offsets, codes, words


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Runs without ASCII white space: row offsets, and a 64-bit hash of each run's bytes, the same in every process.

    Words of up to 64 bytes take a scrambling step for each eight of them; those of one length up to 8 never collide."""
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint64)
    rows = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.zeros(rows[-1] - rows[0] + 8, np.uint8)  # eight more, so that each byte has a group of eight
    if raw is not None:
        data[:-8] = np.frombuffer(raw, np.uint8)[rows[0] : rows[-1]]
    rows -= rows[0]
    inside = (data[:-8] != 32) & (data[:-8] - np.uint8(9) > 4)  # below 9 it wraps
    cut = np.zeros(len(inside) + 1, bool)  # between this byte and the one before it
    cut[rows] = True
    cut[1:-1] |= inside[1:] != inside[:-1]
    starts, ends = np.flatnonzero(inside & cut[:-1]), np.flatnonzero(inside & cut[1:]) + 1
    lengths = ends - starts
    h = np.empty(len(starts), np.uint64)
    eights = np.ndarray((len(inside) + 1,), "<u8", data, strides=(1,))
    for a in range(0, len(starts), 1 << 15):  # so many that the arrays stay in a processor's cache
        h[a : a + (1 << 15)] = _short_hashes(eights, starts[a : a + (1 << 15)], lengths[a : a + (1 << 15)])
    for i in np.flatnonzero(lengths > 64).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return np.searchsorted(starts, rows), h


def _short_hashes(eights: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of words of up to 64 bytes, by groups of eight bytes (the last one's other bytes are masked)."""
    h = mix64((eights[starts] & _MASKS[np.minimum(lengths, 8)]) ^ lengths.astype(np.uint64) * _BASE)
    alive = np.flatnonzero((lengths > 8) & (lengths <= 64))
    step = 8
    while len(alive):
        left = lengths[alive] - step
        h[alive] = mix64(h[alive] ^ (eights[starts[alive] + step] & _MASKS[np.minimum(left, 8)]))
        alive = alive[left > 8]
        step += 8
    return h


def row_of(offsets: np.ndarray) -> np.ndarray:
    """For each element the row that holds it."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def string_hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string's bytes (polynomial, scrambled), the same in every process."""
    strings = strings.cast(pa.large_string())
    n = len(strings)
    if not n:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + n + 1]
    raw = strings.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    h = np.full(n, 0x51ED270B, np.uint64)
    starts = offsets[:-1] - offsets[0]
    # one step for each byte position; strings that are shorter drop out, very long ones are hashed one by one
    for i in np.flatnonzero(lengths > 64):
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : starts[i] + lengths[i]].tobytes(), digest_size=8).digest(), "little")
    alive = np.flatnonzero((lengths > 0) & (lengths <= 64))
    step = 0
    while len(alive):
        h[alive] = (h[alive] ^ data[starts[alive] + step].astype(np.uint64)) * _BASE
        h[alive] ^= h[alive] >> np.uint64(29)
        step += 1
        alive = alive[lengths[alive] > step]
    return mix64(h + lengths.astype(np.uint64))


def ngram_hashes(points: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """Hashes of the n-grams that end at each position, for n = 1 .. order; entries that reach before the array are meaningless."""
    first = mix64(points.astype(np.uint64) + np.uint64(0xA5A5))
    h = first
    yield h
    for n in range(2, order + 1):
        shifted = np.empty_like(h)
        shifted[0] = 0
        shifted[1:] = h[:-1]
        h = shifted * _BASE + first + np.uint64(n)
        yield h


def word_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, each between a start (2) and an end mark (3); for each point its word and its place in it."""
    joined = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-32-le", "surrogatepass"), np.uint32) if words else np.zeros(0, np.uint32)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    word = np.repeat(np.arange(len(words)), lengths)
    return joined, word, np.arange(len(joined)) - starts[word]
