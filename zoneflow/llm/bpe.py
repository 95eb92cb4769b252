"""Byte-level BPE encoding and decoding by a global shuffle of distinct pre-tokens.

``encode`` works in three Spark steps:

1. every input partition is read in blocks of about 8 MB of text.  A block
   numbers its distinct pre-tokens by first appearance and turns each text
   into the sequence of those numbers, which is the pre-tokens with their
   positions (a compressed array);
2. a block's distinct pre-tokens go, packed by hash bucket, to the task of their
   bucket, where each distinct pre-token of the corpus is encoded exactly once
   for all blocks that ask for it.  A pre-token is asked for once a block
   however often it occurs, which is what keeps very frequent ones small;
3. the ids go back to their block, meet its texts (co-grouped by block) and
   are put together by position.

Blocks are derived twice, once for the texts and once for the pre-tokens, from
the same deterministic scan instead of being stored.  A block's number is a
digest of its place and its pre-tokens, so the job stops if the two disagree (an
input whose rows change order between two reads: write it as a table first).

Defined results: a null or empty text has no ids and decodes to no bytes; every
input row yields one output row, so repeated rows and repeated ids stay;
other input columns are ignored, whatever their names; an empty table gives
an empty result.  A text longer than a block is a block of its own.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from zoneflow.llm.common import free_memory, plain_strings, string_hashes, text_slices


def load_ranks(path: str) -> dict[bytes, int]:
    """The token-byte table of a rank file: one base64 token and its id a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class PieceEncoder:
    """Ids of single pre-tokens by byte-pair merges (a thin holder that makes the tables once a worker)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self._core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe

    def __call__(self, piece: bytes) -> list[int]:
        return self._core.encode_single_piece(piece)


def _flat_gather(codes: np.ndarray, offsets: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Concatenated lists of ``codes`` (list c is flat[offsets[c]:offsets[c+1]])."""
    lengths = offsets[codes + 1] - offsets[codes]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) - np.repeat(ends - lengths - offsets[codes], lengths)]


def block_pretokens(texts: pa.Array, pattern: regex.Pattern) -> tuple[list[str], list[np.ndarray]]:
    """The distinct pre-tokens of a block and, for each text, their numbers in order.

    A space between two characters that are not white space always starts a
    pre-token, so the text is cut there and the pattern runs once for each
    distinct cut; texts with other white space around a space take the
    pattern as a whole.
    """
    numbers: dict[str, int] = {}
    put = numbers.setdefault
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    flat = lists.flatten().dictionary_encode()
    codes, cuts = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary.to_pylist()
    plain = np.fromiter((bool(c) and not c[0].isspace() and not c[-1].isspace() for c in cuts), bool, len(cuts))
    expanded: list[list[int]] = [[put(w, len(numbers)) for w in pattern.findall(" " + c)] if ok else [] for c, ok in zip(cuts, plain, strict=True)]
    sizes = np.fromiter(map(len, expanded), np.int64, len(expanded))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    pool = np.fromiter((x for e in expanded for x in e), np.int64, int(starts[-1]))
    out = []
    bad_before = np.concatenate([[0], np.cumsum(~plain[codes])]) if len(codes) else np.zeros(1, np.int64)
    for i in range(len(texts)):
        a, b = int(offsets[i]), int(offsets[i + 1])
        if bad_before[b] > bad_before[a]:
            found = pattern.findall(texts[i].as_py())
            out.append(np.fromiter((put(w, len(numbers)) for w in found), np.int64, len(found)))
        else:
            head = pattern.findall(cuts[codes[a]])
            first = np.fromiter((put(w, len(numbers)) for w in head), np.int64, len(head))
            out.append(np.concatenate([first, _flat_gather(codes[a + 1 : b], starts, pool)]) if b - a > 1 else first)
    return list(numbers), out


def _pack(codes: np.ndarray) -> bytes:
    low, high = (codes & 0xFFFF).astype(np.uint16), (codes >> 16).astype(np.uint16)
    raw = low.astype("<u2").tobytes() + high.astype("<u2").tobytes()
    planes = np.frombuffer(raw, np.uint8).reshape(2, -1, 2).transpose(0, 2, 1).tobytes()
    return zstandard.compress(planes, 3)


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8)
    low, high = planes.reshape(2, 2, -1).transpose(0, 2, 1).reshape(2, -1).copy().view("<u2")
    return low.astype(np.int64) | (high.astype(np.int64) << 16)


def _blocks(batches: Iterator[pa.RecordBatch], pattern_text: str):
    """(block, rows, distinct pre-tokens, numbers of each text) of a task's blocks."""
    pattern, seq, part = regex.compile(pattern_text), 0, TaskContext.get().partitionId()
    for batch in batches:
        for piece in text_slices(batch, max_bytes=8 << 20, give_back=True):
            words, codes = block_pretokens(plain_strings(piece.column("text")), pattern)
            h = hashlib.blake2b(f"{part} {seq} {len(words)}".encode(), digest_size=8)
            h.update("\0".join(words).encode())
            yield int.from_bytes(h.digest(), "little", signed=True), piece, words, codes
            seq += 1


def _pack_lists(lists: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, lists), "<u4", len(lists))
    return zstandard.compress(np.array([len(lists)], "<u4").tobytes() + sizes.tobytes() + b"".join(lists), 3)


def _unpack_lists(blob: bytes) -> list[bytes]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n
    starts = np.concatenate([[4 + 4 * n], ends[:-1]])
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows of ``keep`` columns plus ``n_tokens`` and ``ids`` (little-endian 32-bit ids)."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(ranks_path))
    rows = docs.select(F.struct(*keep).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType
    # a task holds the distinct pre-tokens of one bucket at a time
    buckets = 1 << max(6, min(16, (4 * rows.rdd.getNumPartitions() - 1).bit_length()))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, piece, words, codes in _blocks(batches, pattern):
            n = piece.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), piece.column("key"), pa.array([len(words)] * n, pa.int32()), pa.array([_pack(c) for c in codes], pa.binary())], ["block", "key", "words", "codes"]
            )

    def pretokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, words, _ in _blocks(batches, pattern):
            if not words:
                continue
            bucket = (string_hashes(pa.array(words, pa.string())) >> np.uint64(40)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(cuts)).tolist()
            numbers = [order[cuts[b] : cuts[b + 1]] for b in used]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(used), pa.int64()),
                    pa.array(used, pa.int32()),
                    pa.array([_pack(x) for x in numbers], pa.binary()),
                    pa.array([_pack_lists([words[i].encode() for i in x]) for x in numbers], pa.binary()),
                ],
                ["block", "bucket", "numbers", "words"],
            )

    def ids_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last, known = PieceEncoder(ranks.value, pattern), None, {}
        for batch in batches:
            found = []
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("words"), strict=True):
                if bucket != last:
                    last, known = bucket, {}
                words = _unpack_lists(blob.as_py())
                for word in words:
                    if word not in known:
                        known[word] = np.array(encoder(word), "<u4").tobytes()
                found.append(_pack_lists([known[w] for w in words]))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("numbers"), pa.array(found, pa.binary())], ["block", "numbers", "ids"])
            del batch, found
            free_memory()
        del encoder, known
        free_memory()

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        free_memory()  # what the block before held
        asked = left.column("words").to_pylist()
        lists = [b""] * (asked[0] if asked else 0)
        answered = 0
        for numbers, blob in zip(right.column("numbers"), right.column("ids"), strict=True):
            for number, ids in zip(_unpack(numbers.as_py()).tolist(), _unpack_lists(blob.as_py()), strict=True):
                lists[number] = ids
                answered += 1
        if answered != len(lists):
            raise RuntimeError("the input rows changed order between two reads; write them as a table first")
        sizes = np.fromiter((len(x) // 4 for x in lists), np.int64, len(lists))
        starts, pool = np.concatenate([[0], np.cumsum(sizes)]), np.frombuffer(b"".join(lists), "<u4")
        n, out = [], []
        for blob in left.column("codes"):
            ids = _flat_gather(_unpack(blob.as_py()), starts, pool)
            n.append(len(ids))
            out.append(ids.tobytes())
        return pa.table([left.column("key"), pa.array(n, pa.int64()), pa.array(out, pa.binary())], ["key", "n_tokens", "ids"])

    blocks_t = StructType([StructField("block", LongType()), StructField("key", key_type), StructField("words", IntegerType()), StructField("codes", BinaryType())])
    out_t = StructType([StructField("key", key_type), StructField("n_tokens", LongType()), StructField("ids", BinaryType())])

    asked = rows.mapInArrow(pretokens, "block long, bucket int, numbers binary, words binary").repartition("bucket").sortWithinPartitions("bucket")
    answered = asked.mapInArrow(ids_of_words, "block long, numbers binary, ids binary")
    out = rows.mapInArrow(texts, blocks_t).groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(assemble, out_t)
    return out.select("key.*", "n_tokens", "ids")


def decode(encoded: DataFrame, ranks_path: str, digests: bool = False) -> DataFrame:
    """``encoded`` plus ``decoded``: the bytes of its ids, joined from the token-byte table.

    The table is that of the vocabulary (its size does not depend on the data),
    so it goes to every task.  An id that is not in the vocabulary fails the
    job.  With ``digests``, ``ids`` and ``decoded`` give way to SHA-256 digests
    of the decimal ids (one space between) and of the decoded bytes.
    """
    table = encoded.sparkSession.sparkContext.broadcast({v: k for k, v in load_ranks(ranks_path).items()})
    others = [c for c in encoded.columns if c != "ids"]
    if digests:
        schema = encoded.select(*others, F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256")).schema
    else:
        schema = encoded.select(*others, "ids", F.lit(b"").alias("decoded")).schema

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = table.value
        kind = pa.string() if digests else pa.binary()
        for batch in batches:
            for piece in text_slices(batch, "ids", max_bytes=4 << 20, give_back=True):
                first, second = [], []
                for blob in piece.column("ids"):
                    ids = np.frombuffer(blob.as_py(), "<u4").tolist()
                    raw = b"".join([by_id[i] for i in ids])
                    first.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() if digests else blob.as_py())
                    second.append(hashlib.sha256(raw).hexdigest() if digests else raw)
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in others), pa.array(first, kind), pa.array(second, kind)], schema.fieldNames())

    return encoded.mapInArrow(joined, schema)
