"""Packing of documents into training sequences: concatenate and cut.

All documents' ids, each document closed by ``end_id``, form one long row of
ids that is cut every ``length`` ids.  Where a document lies in that row is
found by prefix sums in two passes:

1. every input partition is tokenised once; a document gets its place among the
   ids of its partition and the encoded rows are written to the shared folder;
2. the partitions' totals, one number each, give the partitions' places in the
   whole row, so a document's place is a sum of two numbers.  Its pieces, one
   for each window that it touches, follow without any shuffle.

``sequences`` puts the windows' ids together.  A task emits the windows it holds
whole; a window that crosses from one task to the next leaves boundary
records, of which a task has two at most for each run of rows it reads, and
only those are shuffled.

All sequences but the last are full, so at most ``length`` - 1 ids are padding
however many documents there are.

Defined results: a null or empty text has the closing id alone; every input row
is a document of its own, so repeated rows and repeated or null ids stay; other
input columns are ignored, whatever their names; an empty table gives an empty
result.  A text of any length is cut over as many windows as it needs; its
ids have to fit one row (2 GB).  Special tokens' strings inside a text are
ordinary text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from zoneflow.llm.bpe import _flat_gather
from zoneflow.llm.common import ascii_words, keyed_rows, keyed_slices
from zoneflow.session import materialize

WORDS_A_TEXT, WORDS_A_CALL, KEPT_WORDS = 64, 1 << 15, 400_000
MARK = "\x01"
# ASCII punctuation without the apostrophe, after an ASCII letter
ENDING = r"([A-Za-z])[!-&(-/:-@\[-`{-~]+$"
BROADCAST_PARTITIONS = 1 << 20


class WordIds:
    """Ids of words, kept for the words to come as long as there are at most ``KEPT_WORDS``.

    Words are encoded many to a text, with a mark between them that is one id and that no such word holds.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        alone = tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = alone[0] if len(alone) == 1 else -1
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and how many each has."""
        a_text = WORDS_A_TEXT if self.mark >= 0 else 1
        between = f" {MARK} "
        ids = []
        for i in range(0, len(words), WORDS_A_CALL):
            some = words[i : i + WORDS_A_CALL]
            texts = [between.join(some[j : j + a_text]) + between * (a_text > 1) for j in range(0, len(some), a_text)]
            ids += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if a_text == 1:
            return np.concatenate(ids) if ids else self.flat[:0], np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids) if ids else self.flat[:0]
        marks = np.flatnonzero(flat == self.mark)
        return np.delete(flat, marks), np.diff(marks, prepend=-1) - 1

    def __call__(self, words: list[str]) -> np.ndarray:
        """The words' numbers: word n has the ids flat[starts[n]:starts[n + 1]]."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > KEPT_WORDS:
            self._forget()
            new = words
        plain = [w for w in new if MARK not in w]
        flat, sizes = self._encode(plain)
        marked = [w for w in new if MARK in w]
        lists = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32) for w in marked]
        for word in (*plain, *marked):
            self.known[word] = len(self.known)
        self.flat = np.concatenate([self.flat, flat, *lists])
        sizes = np.concatenate([np.diff(self.starts), sizes, np.array([len(x) for x in lists], np.int64)])
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


def word_units(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words as stems and endings: the distinct units, the units of all words (one after the other), and where each word's begin.

    The tokenizer lower-cases and always cuts between an ASCII letter and
    ASCII punctuation without an apostrophe, so "Word" and "word," share a unit.
    Only ASCII words are lower-cased here: others compose first.
    """
    words = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
    stems = pc.replace_substring_regex(words, ENDING, r"\1")
    ended = np.flatnonzero(pc.not_equal(pc.binary_length(stems), pc.binary_length(words)).to_numpy(zero_copy_only=False))
    endings = pc.replace_substring_regex(words.take(pa.array(ended)), "^.*[A-Za-z]", "")
    units = pa.concat_arrays([stems, endings]).dictionary_encode()
    codes = units.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(words)
    return units.dictionary, np.insert(codes[:n], ended + 1, codes[n:]), np.arange(n + 1) + np.searchsorted(ended, np.arange(n + 1))


def encode_texts(word_ids: WordIds, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids (little-endian, 32 bits), each text closed by ``end_id``, and the place where each begins (one more than texts).

    The tokenizer drops white space and never joins over it, so each distinct
    word is encoded once.
    """
    offsets, codes, words = ascii_words(texts)
    units, parts, first = word_units(words)
    parts = word_ids(units.to_pylist())[parts]
    sizes = np.concatenate([[0], np.cumsum(np.diff(word_ids.starts)[parts])])
    flat, starts = _flat_gather(parts, word_ids.starts, word_ids.flat), sizes[first]
    ends = np.concatenate([[0], np.cumsum(np.diff(starts)[codes])])[offsets]
    ids = np.insert(_flat_gather(codes, starts, flat), ends[1:], end_id).astype("<u4")
    return ids, ends + np.arange(len(ends))


def encode(docs: DataFrame, tokenizer_json: str, end_id: int, text: str = "text", keep: tuple[str, ...] = (), id_column: str = "doc_id") -> DataFrame:
    """Pass 1, written to the shared folder: part, key (id and ``keep``), start (ids of the part before the document), n_tokens and ids."""
    rows = keyed_rows(docs, id_column, keep, text)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    schema = StructType(
        [StructField("part", IntegerType()), StructField("key", rows.schema["key"].dataType), StructField("start", LongType()), StructField("n_tokens", LongType()), StructField("ids", BinaryType())]
    )

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value)
        tokenizer.encode_special_tokens = True
        word_ids = WordIds(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for key, texts in keyed_slices(batch, text, max_bytes=8 << 20):
                ids, places = encode_texts(word_ids, texts, end_id)
                n = len(texts)
                blobs = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((4 * places).astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), key, pa.array(before + places[:-1], pa.int64()), pa.array(np.diff(places), pa.int64()), blobs], schema.names)
                before += int(places[-1])

    return materialize(docs.sparkSession, rows.mapInArrow(tokenised, schema), "packing-ids")


def pack(docs: DataFrame, tokenizer_json: str, length: int = 4096, end_id: int = 2, text: str = "text", keep: tuple[str, ...] = (), id_column: str = "doc_id") -> DataFrame:
    """The pieces: id and ``keep`` columns, start, length, ids (little-endian, 32 bits), doc_tokens, sequence_id and offset.

    ``tokenizer_json`` is the text of a tokenizer file whose words never join over white space.
    """
    spark = docs.sparkSession
    encoded = encode(docs, tokenizer_json, end_id, text, keep, id_column)
    # one row for each input partition
    totals = sorted(encoded.groupBy("part").agg(F.sum("n_tokens")).collect())
    before = np.concatenate([[0], np.cumsum([t for _, t in totals], dtype=np.int64)]).tolist()
    bases = spark.createDataFrame([(p, b) for (p, _), b in zip(totals, before, strict=False)], "part int, base long")
    placed = encoded.join(F.broadcast(bases) if len(totals) <= BROADCAST_PARTITIONS else bases, "part")
    placed = placed.select("key", "ids", "n_tokens", (F.col("base") + F.col("start")).alias("first"), (F.col("base") + F.col("start") + F.col("n_tokens")).alias("end"))
    size = F.lit(length).cast("long")

    def piece(window: Column) -> Column:
        a, b = F.greatest("first", window * size), F.least("end", (window + 1) * size)
        start = a - F.col("first")
        return F.struct(
            start.alias("start"), (b - a).alias("length"), F.substring("ids", (4 * start + 1).cast("int"), (4 * (b - a)).cast("int")).alias("ids"), window.alias("sequence_id"), (a - window * size).alias("offset")
        )

    windows = F.sequence(F.call_function("div", F.col("first"), size), F.call_function("div", F.col("end") - 1, size))
    pieces = placed.select("key", F.col("n_tokens").alias("doc_tokens"), F.explode(F.transform(windows, piece)).alias("p"))
    return pieces.select("key.*", "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset")


def sequences(pieces: DataFrame, length: int = 4096, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_tokens, padding and ids of each window of ``pack``'s pieces.

    A sequence is filled up to ``length`` with ``pad_id``, unless its own length is a power of two.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begin, held, parts = None, 0, 0, []
        out: list[tuple] = []
        for batch in batches:
            for w, at, n, ids in zip(*(batch.column(c).to_pylist() for c in ("sequence_id", "offset", "length", "ids")), strict=True):
                if w != current or at != begin + held:
                    if current is not None:
                        out.append((current, begin, held, b"".join(parts)))
                    current, begin, held, parts = w, at, 0, []
                held += n
                parts.append(ids)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["sequence_id", "offset", "length", "ids"])
                out = []
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((current, pa.int64()), (begin, pa.int64()), (held, pa.int64()), (b"".join(parts), pa.binary()))], ["sequence_id", "offset", "length", "ids"])

    rows = pieces.select("sequence_id", "offset", "length", "ids")
    records = materialize(pieces.sparkSession, rows.mapInArrow(joined, "sequence_id long, offset long, length long, ids binary"), "packing-windows")
    whole = records.where(F.col("length") == length).select("sequence_id", "ids")
    crossing = records.where(F.col("length") < length).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    crossing = crossing.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda held, part: F.concat(held, part["ids"])).alias("ids"))
    n = F.length("ids") / 4
    power = F.bit_count(n.cast("long")) == 1
    out = whole.unionByName(crossing).select("sequence_id", n.cast("long").alias("n_tokens"), F.when(power, 0).otherwise(length - n).cast("long").alias("padding"), "ids")
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    return out.withColumn("ids", F.concat("ids", F.aggregate(F.array_repeat(pad, F.col("padding").cast("int")), F.lit(b""), lambda held, p: F.concat(held, p))))
