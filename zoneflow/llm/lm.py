"""N-gram language-model scores from a log-frequency Bloom filter.

Training counts every unigram and bigram of every training text.  Each block of
about 12 MB counts its own n-grams first and sends one packed row (64-bit
n-gram hashes and counts) to each of many segments of the hash space, so a
very frequent n-gram is one entry a block.  A segment adds its counts up,
quantises them on a log scale (level 1 + floor(log_base c)) and sets, for each
level up to its own, the bits of (n-gram, level) in its slice of the filter.
The slices together are the filter.

Its size is a parameter, ``bits_per_ngram`` times the training tokens, rounded
up to a power of two: it grows with the training text without a bound, and every
n-gram that was read in training is in it (where a segment's n-grams need more
bits, its slice is doubled until they fit).  No process holds more of it than the
slice of a segment: a block's rows carry its held-out n-grams too (count 0), and
the segment answers each of them with the levels that its slice returns.

A count is read by probing level 1, 2, ... until a level is missing; scoring
smooths it with a Dirichlet prior over the unigram model:

    P(w | v) = (c(v w) + mu P(w)) / (c(v) + mu),
    P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)).

Each text is a start mark, its tokens and one end token.  The exact counts that
the base score needs come by a shuffle of each block's distinct words: a word
has one row a block, its training counts are summed over the blocks, and the
sums go back to the block's texts.

Defined results: a null or empty text is just the end token; every input row
gives one row, repeated rows count as often as they occur; a null id is a
training row; without any training row N, V and the counts are 0; other columns
are ignored.  Texts are never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.bpe import _pack, _unpack
from zoneflow.llm.common import ascii_words, mix64, plain_strings, row_of, string_hashes, text_slices
from zoneflow.session import materialize

END = "\x20"  # cannot be a word: words hold no white space
START_HASH = np.uint64(0x5357415254)
BITS_NEEDED = 4.0  # of a slice for each (n-gram, level) in it


@dataclass(frozen=True)
class FilterShape:
    """Geometry of the filter: ``2 ** log_bits`` bits in ``2 ** log_segments`` slices, ``hashes`` bits an entry."""

    log_bits: int
    log_segments: int
    hashes: int = 3
    base: float = 2.0

    @property
    def slice_bits(self) -> int:
        return 1 << (self.log_bits - self.log_segments)

    def segments(self, ngrams: np.ndarray) -> np.ndarray:
        return (ngrams >> np.uint64(64 - self.log_segments)).astype(np.int64) if self.log_segments else np.zeros(len(ngrams), np.int64)

    def places(self, ngrams: np.ndarray, level: int) -> list[np.ndarray]:
        """Bit numbers of (n-gram, level) within the n-gram's slice."""
        h = mix64(ngrams + np.uint64(level * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
        mask = np.uint64(self.slice_bits - 1)
        step = (h >> np.uint64(33)) | np.uint64(1)
        return [((h + np.uint64(i) * step) & mask).astype(np.int64) for i in range(self.hashes)]

    def levels(self, counts: np.ndarray) -> np.ndarray:
        return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(self.base) + 1e-9).astype(np.int64)

    def count_of(self, levels: np.ndarray) -> np.ndarray:
        """The count that stands for a level: the middle of its range, 1 for the first, 0 for none."""
        low = self.base ** (np.maximum(levels, 1) - 1.0)
        return np.where(levels == 0, 0.0, np.where(levels == 1, 1.0, (low + np.maximum(low * self.base - 1, low)) / 2))


def filter_shape(tokens: int, bits_per_ngram: float) -> FilterShape:
    """The filter for so many training tokens: ``bits_per_ngram`` bits or more for each of them, at any number."""
    log_bits = int(np.ceil(np.log2(max(1 << 16, bits_per_ngram * tokens))))
    return FilterShape(log_bits, max(0, min(log_bits - 9, int(np.ceil(np.log2(max(tokens, 1) / (1 << 16) + 1))) + 2)))


def probe(bits: np.ndarray, shape: FilterShape, ngrams: np.ndarray, most: int = 60) -> np.ndarray:
    """Stored counts of n-grams (0: not stored)."""
    return shape.count_of(stored_levels(bits, shape, ngrams, most=most))


def stored_levels(bits: np.ndarray, shape: FilterShape, ngrams: np.ndarray, first: int = 0, most: int = 60) -> np.ndarray:
    """Levels of n-grams (0: not stored) by probing rising levels; ``bits`` holds the slices from segment ``first`` on."""
    levels = np.zeros(len(ngrams), np.int64)
    alive = np.arange(len(ngrams))
    for level in range(1, most + 1):
        if not len(alive):
            break
        found, offset = ngrams[alive], (shape.segments(ngrams[alive]) - first) * shape.slice_bits
        ok = np.ones(len(alive), bool)
        for place in shape.places(found, level):
            at = offset + place
            ok &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        alive = alive[ok]
        levels[alive] = level
    return levels


def bigram_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix64(first * np.uint64(0x9E3779B97F4A7C15) + mix64(second))


def _token_blocks(batches: Iterator[pa.RecordBatch]):
    """Block, rows, and the tokens of a block: row offsets, codes (the end token included), distinct tokens and their hashes.

    A block's number is a digest of its place and its tokens, so two scans that
    disagree about a block do not meet.
    """
    seq, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        for piece in text_slices(batch):
            offsets, codes, words = ascii_words(pc.ascii_lower(plain_strings(piece.column("text"))))
            words = pa.concat_arrays([words.cast(pa.string()), pa.array([END])])
            codes = np.insert(codes, offsets[1:], len(words) - 1)
            hashes = string_hashes(words)
            h = hashlib.blake2b(f"{part} {seq}".encode() + hashes.tobytes(), digest_size=8)
            yield int.from_bytes(h.digest(), "little", signed=True), piece, offsets + np.arange(len(offsets)), codes, words, hashes
            seq += 1


def _block_counts(rows: DataFrame) -> DataFrame:
    """(block, number, word, n): each block's distinct tokens and their counts in its training rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, piece, offsets, codes, words, _ in _token_blocks(batches):
            train = ~piece.column("held_out").to_numpy(zero_copy_only=False)
            n = np.bincount(codes, weights=train[row_of(offsets)], minlength=len(words)).astype(np.int64)
            for a in range(0, len(words), 50_000):
                part = words.slice(a, 50_000)
                k = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * k, pa.int64()), pa.array(np.arange(a, a + k), pa.int32()), part, pa.array(n[a : a + k])],
                    ["block", "number", "word", "n"],
                )

    return rows.mapInArrow(count, "block long, number int, word string, n long")


def _block_ngrams(offsets: np.ndarray, codes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a block's n-grams (its distinct bigrams in order, its distinct tokens, the start mark) and for each token its bigram among them."""
    tokens = hashes[codes]
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[offsets[:-1]] = START_HASH
    pairs, own = np.unique(bigram_hashes(before, tokens), return_inverse=True)
    return np.concatenate([pairs, mix64(hashes), mix64(np.array([START_HASH], np.uint64))]), own


def _stored(rows: DataFrame, shape: FilterShape) -> DataFrame:
    """(block, segment, levels): what the filter over all training n-grams returns for a block's n-grams of a segment, by hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, piece, offsets, codes, words, hashes in _token_blocks(batches):
            train = ~piece.column("held_out").to_numpy(zero_copy_only=False)
            keep = train[row_of(offsets)]
            ngrams, own = _block_ngrams(offsets, codes, hashes)
            pairs = len(ngrams) - len(words) - 1
            counts = np.concatenate([np.bincount(own[keep], minlength=pairs), np.bincount(codes[keep], minlength=len(words)), [train.sum()]])
            order = np.argsort(ngrams, kind="stable")
            ngrams, counts = ngrams[order], counts[order]
            segments = shape.segments(ngrams)
            cuts = np.searchsorted(segments, np.arange((1 << shape.log_segments) + 1))
            used = np.flatnonzero(np.diff(cuts))
            for a in range(0, len(used), 1024):
                some = used[a : a + 1024]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * len(some), pa.int64()),
                        pa.array(some, pa.int32()),
                        pa.array([ngrams[cuts[s] : cuts[s + 1]].astype("<u8").tobytes() for s in some], pa.binary()),
                        pa.array([_pack_counts(counts[cuts[s] : cuts[s + 1]]) for s in some], pa.binary()),
                    ],
                    ["block", "segment", "ngrams", "counts"],
                )

    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ngrams = [np.frombuffer(x, "<u8") for x in table.column("ngrams").to_pylist()]
        ends = np.cumsum([len(x) for x in ngrams])
        counts = np.concatenate([_unpack_counts(x) for x in table.column("counts").to_pylist()])
        ngrams, at = np.unique(np.concatenate(ngrams), return_inverse=True)
        counts = np.bincount(at, weights=counts)
        trained, levels = ngrams[counts > 0], shape.levels(counts[counts > 0])
        own = shape
        while levels.sum() * BITS_NEEDED > own.slice_bits:
            own = replace(own, log_bits=own.log_bits + 1)
        bits = np.zeros(own.slice_bits, bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            for place in own.places(trained[levels >= level], level):
                bits[place] = True
        found = stored_levels(np.packbits(bits, bitorder="little"), own, ngrams, first=key[0].as_py()).astype(np.uint8)[at]
        return pa.table([table.column("block"), table.column("segment"), pa.array([x.tobytes() for x in np.split(found, ends[:-1])], pa.binary())], ["block", "segment", "levels"])

    packed = rows.mapInArrow(count, "block long, segment int, ngrams binary, counts binary")
    return packed.groupBy("segment").applyInArrow(answer, "block long, segment int, levels binary")


def _pack_counts(counts: np.ndarray) -> bytes:
    """Counts, nearly all of them small, as a byte each and the values of those from 255 on."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return np.array([len(counts)], "<u4").tobytes() + small.tobytes() + counts[small == 255].astype("<u8").tobytes()


def _unpack_counts(blob: bytes) -> np.ndarray:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    out = np.frombuffer(blob, np.uint8, n, 4).astype(np.float64)
    out[out == 255] = np.frombuffer(blob, "<u8", offset=4 + n)
    return out


def score(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    held_out=None,
    mu: float = 1000.0,
    bits_per_ngram: float = 6.0,
) -> DataFrame:
    """One row a document: n_tokens, n_known, train_tokens, base_score, score (see the module's head).

    ``held_out`` is a boolean column of the rows that do not train (default:
    none).
    """
    spark = docs.sparkSession
    flag = F.lit(False) if held_out is None else held_out
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(flag, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    word = Window.partitionBy("word")
    counted = _block_counts(rows).repartition("word").withColumn("c", F.sum("n").over(word)).withColumn("first", F.col("block") == F.min("block").over(word))
    counts = materialize(spark, counted.select("block", "number", "n", "c", "first"), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("first") & (F.col("c") > 0)).cast("long")), F.lit(0))).first()

    shape = filter_shape(total, bits_per_ngram)
    floor = np.log10(total + 0.5 * (distinct + 1))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, piece, offsets, codes, _, hashes in _token_blocks(batches):
            n = piece.num_rows
            hashes = [hashes.tobytes()] + [b""] * (n - 1)
            packed = [_pack(codes[offsets[i] : offsets[i + 1]]) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), piece.column("id"), piece.column("held_out"), pa.array(packed, pa.binary()), pa.array(hashes, pa.binary())],
                ["block", "id", "held_out", "codes", "hashes"],
            )

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        hashes = np.frombuffer(b"".join(left.column("hashes").to_pylist()), np.uint64)
        words = right.filter(pc.is_valid(right.column("number")))
        held = [_unpack(blob) for blob in left.column("codes").to_pylist()]
        offsets, codes = np.concatenate([[0], np.cumsum([len(x) for x in held])]), np.concatenate(held)
        del held
        ngrams, own = _block_ngrams(offsets, codes, hashes)
        answers = right.filter(pc.is_valid(right.column("segment"))).select(["segment", "levels"]).sort_by("segment")
        levels = np.frombuffer(b"".join(answers.column("levels").to_pylist()), np.uint8)
        if len(hashes) != words.num_rows or len(ngrams) != len(levels):
            raise RuntimeError("the input rows changed order between two reads; write them as a table first")
        c = np.zeros(len(hashes), np.int64)
        c[words.column("number").to_numpy()] = words.column("c").to_numpy()
        base = np.log10(c + 0.5) - floor
        stored = np.empty(len(ngrams))
        stored[np.argsort(ngrams, kind="stable")] = shape.count_of(levels.astype(np.int64))
        pairs = len(ngrams) - len(hashes) - 1
        kept, start = stored[pairs:-1], stored[-1]
        unigram = (kept + 0.5) / (total + 0.5 * (distinct + 1))
        context = np.empty(len(codes))
        context[1:] = kept[codes[:-1]]
        context[offsets[:-1]] = start
        # a bigram cannot be known more often than either of its words
        pair = np.minimum(stored[own], np.minimum(context, kept[codes]))
        p = np.log10((pair + mu * unigram[codes]) / (context + mu))
        n = np.diff(offsets)
        known, base_score, model = (np.add.reduceat(x, offsets[:-1]) for x in ((c[codes] > 0).astype(np.int64), base[codes], p))
        k = left.num_rows
        return pa.table(
            [left.column("id"), left.column("held_out"), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array([int(total)] * k, pa.int64()), pa.array(base_score), pa.array(model)],
            ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    blocks = rows.mapInArrow(texts, f"block long, id {id_type}, held_out boolean, codes binary, hashes binary")
    known = counts.select("block", "number", "c").unionByName(_stored(rows, shape), allowMissingColumns=True)
    out = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        scored, f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return out.withColumnRenamed("id", id_column)
