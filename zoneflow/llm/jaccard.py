"""N-gram Jaccard join by parity sketches, and the groups its links form.

A text's set is its distinct word shingles (64-bit hashes).  Texts with equal
sets are one *node*.  Two nodes link when their Jaccard similarity reaches the
threshold, J = p/q, so their symmetric difference is at most
d(x + y) = floor((x + y) (q - p) / (q + p)) for sizes x and y.

* Size bands.  Bands end at sizes that grow by the factor q/p, so a node links
  only into its own band and the two next to it; a pair is looked for in the
  band of its larger side, where d is at most that of two largest sets.
* Sketch segments.  In a band with difference bound d the shingles are dealt
  by hash to m > d segments, and a segment's parity vector (each shingle flips
  its own bit) is kept as its XOR of 64-bit shingle hashes.  Each differing
  shingle changes one segment, so linked nodes agree in at least m - d
  segments: the pigeonhole join is an equality join on (band, segment, value).
  m leaves a slack of m - d - 1; a node with no more empty segments than that
  shares a non-empty segment with every partner, so empty ones need not join.
* Common shingles (a passage that many texts hold) would make unrelated texts
  agree in segments that hold nothing else.  Leaving a fixed set of shingles
  out of the sketch keeps the bound, as it can only lower the difference; a
  node that is left with too many empty segments also enters a second sketch
  over all its shingles (and there, if it must, its empty segments), so two
  such nodes meet in it.  Which shingles are common is counted over all texts,
  in 2 ** 20 hashed counters: those far above the mean, by its Poisson spread.
* Large groups of near copies.  The smallest set of each of the (at most
  ``max_leaders``) most frequent smallest shingles goes to all workers; a text
  with that smallest shingle is compared with it exactly where it is read.
  Nodes that link to one leader are one *family*.
* Links.  A joined group of at most ``small_group`` families yields the pairs of
  its families' smallest nodes, a larger one compares them with the smallest of
  all.  Pairs pass the bounds of the sizes and of a short bit sketch (its
  Hamming distance also lower-bounds the difference) before sets are fetched
  and the similarity is computed exactly.  A group whose families are all in
  one class then is settled.  In the others, nodes outside the largest class are
  compared with a few of its nodes first, and what still is apart then is
  compared across classes.
* Classes are connected components, by alternating large-star and small-star
  rounds.

Sets, sketches and signatures are made for many texts at once, in flat arrays;
for the exact comparison one text of each node that a pair names is read again.

Sketch rows travel packed by block (about 8 MB of text) and hash bucket, and a
block sends one row a node and segment value however often a text repeats in
it.  Intermediate tables lie in the shared checkpoint folder.

Defined results: null, empty and blank texts have no shingle and link with
nothing; a text of fewer words than a shingle is one shingle; ties of ids do
not matter (rows with one id keep their own text); the class id is the
smallest id of the class, null ids only if there is no other.  Every input row
gives one row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from zoneflow.llm.common import mix64, plain_strings, row_of, text_slices, word_hashes
from zoneflow.session import materialize

SKETCH_WORDS = 16  # 64-bit words of the short bit sketch
SEED, BASE = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9E3779B97F4A7C15)
LOG_COUNTERS, LOG_CHUNK = 20, 14
LOOK_BYTES, BLOCK_BYTES = 6 << 20, 8 << 20  # of text that a task works on at a time
PART = 256  # sets of which sketches are made at a time
MAX_LOG_BUCKETS = 14
PACKED = ["bucket", "keys", "owners", "nodes", "leaders"]


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least ``p / q``."""

    p: int = 80
    q: int = 100

    def difference(self, total: int) -> int:
        """Largest symmetric difference of two linked sets whose sizes sum to ``total``."""
        return total * (self.q - self.p) // (self.q + self.p)

    def bands(self, largest: int) -> list[int]:
        """Largest set size of each band."""
        ends = [1]
        while ends[-1] < largest:
            ends.append(max(ends[-1] + 1, ends[-1] * self.q // self.p))
        return ends

    def segments(self, end: int) -> tuple[int, int]:
        """Number of segments and difference bound in the band that ends at size ``end``."""
        d = self.difference(2 * end)
        return d + 1 + -(-(d + 1) * 3 // 20) + 1, d


@dataclass(frozen=True)
class Sets:
    """Sets of shingle hashes, one after another: set ``i`` is the sorted ``values[offsets[i]:offsets[i + 1]]``."""

    values: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        return self.values[self.offsets[i] : self.offsets[i + 1]]

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def lowest(self) -> np.ndarray:
        """Each set's smallest shingle (0: empty)."""
        low, filled = np.zeros(len(self), np.int64), self.sizes > 0
        low[filled] = self.values[self.offsets[:-1][filled]].view(np.int64)
        return low

    def take(self, chosen: np.ndarray) -> Sets:
        sizes = self.sizes[chosen]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        return Sets(self.values[np.arange(offsets[-1]) + np.repeat(self.offsets[:-1][chosen] - offsets[:-1], sizes)], offsets)

    def parts(self, chosen: np.ndarray) -> Iterator[Sets]:
        """The chosen sets, some at a time, so that what is made of them stays small."""
        for a in range(0, len(chosen), PART):
            yield self.take(chosen[a : a + PART])


def shingle_sets(texts: pa.Array, width: int) -> Sets:
    """The distinct shingle hashes of each text."""
    offsets, h = word_hashes(pc.ascii_lower(texts))
    lengths, n = np.diff(offsets), max(0, len(h) - width + 1)
    values = np.zeros(len(h), np.uint64)
    for i in range(width):
        values[:n] = values[:n] * BASE + h[i : n + i]
    values = mix64(values)
    # a shingle lies at its first word, that of a shorter text at its only place
    kept = np.arange(len(h)) + width <= np.repeat(offsets[1:], lengths)
    short = np.flatnonzero((lengths > 0) & (lengths < width))
    whole = lengths[short].astype(np.uint64)
    for i in range(width - 1):
        on = lengths[short] > i
        whole[on] = mix64((whole[on] + h[offsets[short[on]] + i]) * BASE)
    values[offsets[short]], kept[offsets[short]] = whole, True
    values = values[kept]
    offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[offsets[:-1][np.diff(offsets) > 0]] = True
    return Sets(values[new], np.concatenate([[0], np.cumsum(new)])[offsets])


def nodes_of(sets: Sets) -> np.ndarray:
    """A 64-bit identity of each set (0: empty)."""
    nodes, filled = np.zeros(len(sets), np.int64), sets.sizes > 0
    if filled.any():
        nodes[filled] = np.bitwise_xor.reduceat(mix64(sets.values + SEED), sets.offsets[:-1][filled]).view(np.int64)
    return nodes


def bit_sketches(sets: Sets) -> np.ndarray:
    """Parity of each set's shingles at each of 64 * SKETCH_WORDS bits: two sets differ in at least as many shingles as sketches in bits."""
    bits = 64 * SKETCH_WORDS
    out = [np.zeros((0, SKETCH_WORDS), "<i8")]
    for some in sets.parts(np.arange(len(sets))):
        place = (mix64(some.values ^ SEED) >> np.uint64(40)).astype(np.int64) % bits
        odd = (np.bincount(row_of(some.offsets) * bits + place, minlength=len(some) * bits) & 1).astype(np.uint8)
        out.append(np.packbits(odd, bitorder="little").view("<i8").reshape(-1, SKETCH_WORDS))
    return np.concatenate(out)


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """``bit_sketches`` of one set."""
    return bit_sketches(Sets(shingles, np.array([0, len(shingles)])))[0]


def segment_values(sets: Sets, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XOR of the shingles of each of the ``m[i]`` segments of set ``i``, all in a row, and which of them hold any."""
    first = np.concatenate([[0], np.cumsum(m)])
    row = row_of(sets.offsets)
    segment = ((sets.values >> np.uint64(32)) * m.astype(np.uint64)[row] >> np.uint64(32)).astype(np.int64) + first[row]  # sorted, as the shingles are
    values, filled = np.zeros(first[-1], np.uint64), np.zeros(first[-1], bool)
    if len(segment):
        starts = np.flatnonzero(np.diff(segment, prepend=-1))
        values[segment[starts]] = np.bitwise_xor.reduceat(mix64(sets.values), starts)
        filled[segment[starts]] = True
    return values, filled


def signatures_of(sets: Sets, common: np.ndarray, threshold: Threshold, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The join keys of some sets, hashes of (sketch, band, segment, value), and the set that each belongs to."""
    n, last = sets.sizes, np.array(ends)
    counts, bounds = np.array([threshold.segments(end) for end in ends]).T
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    own = np.searchsorted(last, n)
    for band in (own, own + 1):
        here = np.flatnonzero((band < len(ends)) & ((band == own) | (n * threshold.q // threshold.p > last[np.minimum(band, len(ends)) - 1])))
        here = here[bounds[band[here]] > 0]  # elsewhere only equal sets link, and those are one node
        for kind in range(2):
            if not len(here):
                break
            some = sets.take(here)
            if not kind:  # the rare shingles
                rare = ~common[(some.values >> np.uint64(64 - LOG_COUNTERS)).astype(np.int64)]
                some = Sets(some.values[rare], np.concatenate([[0], np.cumsum(rare)])[some.offsets])
            m = counts[band[here]]
            slack = m - bounds[band[here]] - 1
            values, used = segment_values(some, m)
            row = np.repeat(np.arange(len(here)), m)
            poor = m - np.bincount(row[used], minlength=len(here)) > slack
            if kind:
                used |= poor[row]
            used = np.flatnonzero(used)
            segment = used - (np.cumsum(m) - m)[row[used]]
            place = ((kind * 4096 + band[here][row[used]]) << 32).astype(np.uint64) + segment.astype(np.uint64)
            out.append((mix64(mix64(place) + values[used]), here[row[used]]))
            here = here[poor]
    keys, owners = zip(*out, strict=True)
    return np.concatenate(keys), np.concatenate(owners)


def signatures(shingles: np.ndarray, common: np.ndarray, threshold: Threshold, ends: list[int]) -> np.ndarray:
    """The join keys of one set."""
    return signatures_of(Sets(shingles, np.array([0, len(shingles)])), common, threshold, ends)[0]


def _distinct_sets(piece: pa.RecordBatch, width: int) -> tuple[Sets, np.ndarray, np.ndarray]:
    """Sets and nodes of a slice's texts, and of each node with a shingle the first text that has it."""
    sets = shingle_sets(plain_strings(piece.column("text")), width)
    nodes = nodes_of(sets)
    filled = np.flatnonzero(sets.sizes > 0)
    return sets, nodes, np.sort(filled[np.unique(nodes[filled], return_index=True)[1]])


@dataclass(frozen=True)
class Plan:
    """What a sketching task needs: the thresholds, the size bands, the shingles left out and the leaders by smallest shingle."""

    width: int
    threshold: Threshold
    ends: list[int]
    common: np.ndarray  # of each hashed counter, whether its shingles are left out
    leaders: dict[int, tuple[int, np.ndarray]]
    log_buckets: int


def linked(x: np.ndarray, y: np.ndarray, threshold: Threshold) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared * threshold.q >= (len(x) + len(y) - shared) * threshold.p


DESCRIBED = "kind int, id {id}, mark long, node long, n long, sketch array<long>, low long, shingles binary"


def _described(rows: DataFrame, width: int, local_share: float = 0.002, local_least: int = 8) -> DataFrame:
    """kind 0: a row for each text (``mark`` tells texts apart); kind 1: counters of the shingles in a task's distinct sets, chunk ``node`` of task ``n``; kind 2: the smallest node of ``n`` distinct sets of a block that have the smallest shingle ``low``."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << LOG_COUNTERS, np.int64)
        for batch in batches:
            for piece in text_slices(batch, max_bytes=LOOK_BYTES, give_back=True):
                sets, nodes, first = _distinct_sets(piece, width)
                low = sets.lowest()
                yield _batch(0, piece.column("id"), piece.column("mark"), nodes, sets.sizes, bit_sketches(sets), low, None)
                if not len(first):
                    continue
                least = max(local_least, local_share * len(first))
                counters += np.bincount((sets.take(first).values >> np.uint64(64 - LOG_COUNTERS)).astype(np.int64), minlength=len(counters))
                by: dict[int, list[tuple[int, int]]] = {}
                for node, i in zip(nodes[first].tolist(), first.tolist(), strict=True):
                    by.setdefault(int(low[i]), []).append((node, i))
                large = [(x, min(members), len(members)) for x, members in sorted(by.items()) if len(members) >= least]
                if large:
                    lows, leaders, sizes = zip(*large, strict=True)
                    yield _batch(2, pa.nulls(len(large), piece.column("id").type), None, [x for x, _ in leaders], sizes, None, lows, [sets[i].astype("<u8").tobytes() for _, i in leaders])
        chunks = counters.reshape(-1, 1 << LOG_CHUNK)
        used = np.flatnonzero(chunks.any(1))
        if len(used):
            none = pa.nulls(len(used), id_type)
            yield _batch(1, none, None, used, np.full(len(used), TaskContext.get().partitionId()), None, None, [chunks[c].astype("<u4").tobytes() for c in used])

    id_type = to_arrow_type(rows.schema["id"].dataType)
    return rows.mapInArrow(describe, DESCRIBED.format(id=rows.schema["id"].dataType.simpleString()))


def _batch(kind: int, ids: pa.Array, marks: pa.Array | None, node, n, sketch: np.ndarray | None, low, shingles) -> pa.RecordBatch:
    k = len(ids)
    lists = pa.nulls(k, pa.list_(pa.int64())) if sketch is None else pa.ListArray.from_arrays(pa.array(np.arange(0, sketch.size + 1, SKETCH_WORDS), pa.int32()), pa.array(sketch.ravel().astype(np.int64)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(k, kind), pa.int32()),
            ids,
            pa.nulls(k, pa.int64()) if marks is None else marks,
            pa.array(np.asarray(node, np.int64)),
            pa.array(np.asarray(n, np.int64)),
            lists,
            pa.nulls(k, pa.int64()) if low is None else pa.array(low, pa.int64()),
            pa.nulls(k, pa.binary()) if shingles is None else pa.array(shingles, pa.binary()),
        ],
        ["kind", "id", "mark", "node", "n", "sketch", "low", "shingles"],
    )


def _common(described: DataFrame) -> np.ndarray:
    """Of each hashed counter, whether its count is far above the mean."""

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<u4").astype(np.int64) for x in table.column("shingles").to_pylist())
        return pa.table([table.column("node").slice(0, 1), table.column("n").slice(0, 1), pa.array([np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary())], ["node", "n", "shingles"])

    chunks = described.where("kind = 1").select("node", (F.col("n") % 256).alias("n"), "shingles")
    for keys in (["node", "n"], ["node"]):  # by way of some tasks each, then all
        chunks = chunks.groupBy(*keys).applyInArrow(added, "node long, n long, shingles binary")
    counters = np.zeros((1 << (LOG_COUNTERS - LOG_CHUNK), 1 << LOG_CHUNK), np.int64)
    for row in chunks.collect():
        counters[row.node] = np.frombuffer(row.shingles, "<u4")
    mean = counters.mean()
    return (counters > mean + 8 * np.sqrt(mean) + 8).ravel()


def log_buckets(total: int) -> int:
    """Parts of the key space for sets of ``total`` shingles: some 2 ** 15 each, but so few that a block's rows hold tens of keys however large the input is."""
    return int(min(MAX_LOG_BUCKETS, max(4, np.ceil(np.log2(total / (1 << 15) + 1)))))


def _by_bucket(keys: np.ndarray, owner: np.ndarray, nodes: np.ndarray, leaders: np.ndarray, log_buckets: int) -> Iterator[pa.RecordBatch]:
    """A block's join keys and the nodes that own them, a row for each bucket of the key space."""
    bucket = (keys >> np.uint64(64 - log_buckets)).astype(np.int64)
    order = np.lexsort((owner, bucket))
    keys, owner, bucket = (keys[order] << np.uint64(log_buckets) >> np.uint64(32)).astype("<u4"), owner[order], bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    new = np.diff(owner, prepend=-1) != 0
    new[starts] = True
    at = np.cumsum(new) - 1  # each key's place among the owners of all buckets, then of its own
    first = at[starts]
    at -= np.repeat(first, np.diff(starts, append=len(keys)))
    at = at.astype("<u2" if len(at) and at.max() < 65536 else "<u4")
    columns = [pa.array(bucket[starts], pa.int32())]
    for values, begins in ((keys, starts), (at, starts), (nodes[owner[new]], first), (leaders[owner[new]], first)):
        ends = np.append(begins, len(values)) * values.itemsize
        columns.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)]))
    batch = pa.RecordBatch.from_arrays(columns, PACKED)
    for a in range(0, len(starts), 512):
        yield batch.slice(a, 512)


def _packed_signatures(rows: DataFrame, plan: Plan) -> DataFrame:
    """(bucket, keys, owners, nodes, leaders): for each block and bucket of the key space the join keys, the
    place of each key's node in ``nodes``, and the nodes' leaders (a node's own number: none).  Rows without
    keys say which nodes have a leader."""
    shared = rows.sparkSession.sparkContext.broadcast(plan)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        shift = np.uint64(64 - plan.log_buckets)
        for batch in batches:
            for piece in text_slices(batch, max_bytes=BLOCK_BYTES, give_back=True):
                sets, nodes, first = _distinct_sets(piece, plan.width)
                if not len(first):
                    continue
                nodes = nodes[first]
                leaders = nodes.copy()
                for k, (i, low) in enumerate(zip(first.tolist(), sets.lowest()[first].tolist(), strict=True)):
                    leader = plan.leaders.get(low)
                    if leader and leader[0] != nodes[k] and linked(sets[i], leader[1], plan.threshold):
                        leaders[k] = leader[0]
                each = [(k, *signatures_of(some, plan.common, plan.threshold, plan.ends)) for k, some in enumerate(sets.parts(first))]
                del sets
                keys = np.concatenate([k for _, k, _ in each])
                owner = np.concatenate([PART * part + o for part, _, o in each])
                del each
                yield from _by_bucket(keys, owner, nodes, leaders, plan.log_buckets)
                led = np.flatnonzero(leaders != nodes)
                home = (mix64(nodes[led].view(np.uint64)) >> shift).astype(np.int64)
                lists = []
                for s in np.unique(home).tolist():
                    some = led[home == s]
                    lists.append((s, b"", b"", nodes[some].tobytes(), leaders[some].tobytes()))
                for a in range(0, len(lists), 512):
                    bucket_column, *others = zip(*lists[a : a + 512], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket_column, pa.int32()), *(pa.array(x, pa.binary()) for x in others)], PACKED)

    return rows.select("text").mapInArrow(sketch, "bucket int, keys binary, owners binary, nodes binary, leaders binary")


def _groups(packed: DataFrame, small_group: int) -> DataFrame:
    """kind 1: (a, b) linked, b's leader is a; kind 0: (a, b) may link; kind 2: a group ``a`` whose ``nodes`` (of families ``leaders``) the pairs of ``firsts``, one node of each family, may not settle."""

    def group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, nodes, leaders, out, pairs = [], [], [], [], [np.zeros((2, 0), np.int64)]
        for k, o, n, f in zip(*(table.column(c).to_pylist() for c in ("keys", "owners", "nodes", "leaders")), strict=True):
            own, family, some = np.frombuffer(n, "<i8"), np.frombuffer(f, "<i8"), np.frombuffer(k, "<u4")
            if not len(some):
                out += [(1, int(x), int(y), None, None, None) for x, y in zip(family, own, strict=True)]
                continue
            at = np.frombuffer(o, "<u2" if len(o) == 2 * len(some) else "<u4")
            keys.append(some)
            nodes.append(own[at])
            leaders.append(family[at])
        if keys:
            keys, nodes, leaders = np.concatenate(keys), np.concatenate(nodes), np.concatenate(leaders)
            order = np.lexsort((nodes, leaders, keys))
            keys, nodes, leaders = keys[order], nodes[order], leaders[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1]) | (leaders[1:] != leaders[:-1])
            keys, nodes, leaders = keys[new], nodes[new], leaders[new]
            starts = np.flatnonzero(np.diff(keys.astype(np.int64), prepend=-1))
            ends = np.append(starts[1:], len(keys))
            sizes = ends - starts
            again = np.zeros(len(keys), bool)  # a family's further nodes
            again[1:] = (keys[1:] == keys[:-1]) & (leaders[1:] == leaders[:-1])
            plain = (sizes <= small_group) & ~np.logical_or.reduceat(again, starts)
            for size in np.unique(sizes[plain & (sizes > 1)]).tolist():
                members = np.sort(nodes[starts[plain & (sizes == size)][:, None] + np.arange(size)], axis=1)
                i, j = np.triu_indices(size, 1)
                pairs.append(np.stack([members[:, i].ravel(), members[:, j].ravel()]))
            for s, e in zip(starts[~plain & (sizes > 1)].tolist(), ends[~plain & (sizes > 1)].tolist(), strict=True):
                families, firsts = np.unique(leaders[s:e], return_index=True)
                if len(families) == 1:
                    continue
                one = np.sort(nodes[s:e][firsts])
                i, j = np.triu_indices(len(one), 1) if len(one) <= small_group else (np.zeros(len(one) - 1, np.int64), np.arange(1, len(one)))
                pairs.append(np.stack([one[i], one[j]]))
                if len(one) > small_group or len(one) < e - s:
                    # groups of the same nodes get the same number
                    name = int((np.bitwise_xor.reduce(mix64(nodes[s:e].view(np.uint64))) + np.uint64(e - s)).view(np.int64))
                    out.append((2, name, 0, one.tolist(), nodes[s:e].tolist(), leaders[s:e].tolist()))
        out = list({x[:3]: x for x in out}.values())
        columns = [list(c) for c in zip(*out, strict=True)] if out else [[]] * 6
        others = pa.table([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
        a, b = np.concatenate(pairs, axis=1)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[new], b[new]
        return pa.concat_tables([others, pa.table([pa.array(np.zeros(len(a), np.int32)), pa.array(a), pa.array(b), *(pa.nulls(len(a), t) for t in schema.types[3:])], schema=schema)])

    lists = pa.list_(pa.int64())
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("firsts", lists), ("nodes", lists), ("leaders", lists)])
    return packed.groupBy("bucket").applyInArrow(group, "kind int, a long, b long, firsts array<long>, nodes array<long>, leaders array<long>")


def _near(n_a: Column, n_b: Column, sketch_a: Column, sketch_b: Column, threshold: Threshold) -> Column:
    """Whether sizes and bit sketches allow a link."""
    p, q = threshold.p, threshold.q
    distance = sum((F.bit_count(sketch_a[i].bitwiseXOR(sketch_b[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return (F.least(n_a, n_b) * q >= F.greatest(n_a, n_b) * p) & (distance * (q + p) <= (n_a + n_b) * (q - p))


def _possible(pairs: DataFrame, nodes: DataFrame, threshold: Threshold) -> DataFrame:
    """The (a, b) pairs whose sizes and bit sketches allow a link."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(_near(F.col("n_a"), F.col("n_b"), F.col("sketch_a"), F.col("sketch_b"), threshold)).select("a", "b")


def _linked(pairs: DataFrame, rows: DataFrame, nodes: DataFrame, width: int, threshold: Threshold) -> DataFrame:
    """The (a, b) pairs that link, by the exact intersection; sets are made anew from one text of each node that a pair names."""
    spark = rows.sparkSession
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialize(spark, named.join(nodes, "node").select("mark"), "jaccard-wanted")
    # Other texts are left out by a bit map of at most 4 MB, before their words are read; what it lets through by chance joins with nothing.
    log_bits = int(min(25, max(10, np.ceil(np.log2(16 * wanted.count() + 1)))))
    shift = np.uint64(64 - log_bits)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = mix64(batch.column("mark").to_numpy().view(np.uint64)) >> shift
            word, bit = (at >> np.uint64(6)).astype(np.int64), (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit)], ["word", "bit"])

    found = wanted.mapInArrow(places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (log_bits - 6), np.int64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    shared_bits = spark.sparkContext.broadcast(bits.view(np.uint64))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, max_bytes=LOOK_BYTES, give_back=True):
                at = mix64(piece.column("mark").to_numpy().view(np.uint64)) >> shift
                asked = shared_bits.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
                sets, own, first = _distinct_sets(piece.filter(pa.array(asked.astype(bool))), width)
                for a in range(0, len(first), 1000):
                    some = first[a : a + 1000]
                    yield pa.RecordBatch.from_arrays([pa.array(own[some]), pa.array([sets[i].astype("<u8").tobytes() for i in some.tolist()], pa.binary())], ["node", "shingles"])

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [linked(np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8"), threshold) for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    sets = materialize(spark, rows.select("text", "mark").mapInArrow(sets_of, "node long, shingles binary").dropDuplicates(["node"]), "jaccard-sets")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b").mapInArrow(intersect, "a long, b long")


def _open_members(groups: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """The nodes of the groups that their firsts have not settled (several classes), with their classes; None without such a group."""
    left_over = groups.where("kind = 2").dropDuplicates(["a"])
    class_of = F.coalesce("component", "node")
    firsts = left_over.select("a", F.explode("firsts").alias("node")).join(labels, "node", "left").groupBy("a").agg(F.min(class_of).alias("x"), F.max(class_of).alias("y"))
    open_groups = firsts.where("x <> y").select("a")
    members = left_over.join(open_groups, "a", "left_semi").select(F.col("a").alias("grp"), F.explode(F.arrays_zip("nodes", "leaders")).alias("m")).select("grp", F.col("m.nodes").alias("node"))
    members = members.join(labels, "node", "left").select("grp", "node", class_of.alias("component")).join(nodes.select("node", "n", "sketch"), "node")
    members = materialize(groups.sparkSession, members, "jaccard-open")
    return None if members.isEmpty() else members


def _across_classes(members: DataFrame, threshold: Threshold, centres: int | None = None) -> DataFrame:
    """Pairs of nodes of different classes in open groups; with ``centres``, only those with one of so many nodes of the group's largest class."""
    # the largest class of a group is not compared with itself: only the others look for partners
    sizes = members.groupBy("grp", "component").count()
    largest = sizes.groupBy("grp").agg(F.max_by("component", F.struct("count", "component")).alias("largest"))
    known = members.join(largest, "grp")
    seekers = known.where("component <> largest").select("grp", "largest", *(F.col(c).alias(f"u_{c}") for c in ("node", "component", "n", "sketch")))
    partners = members
    if centres:
        # the smallest nodes of a class: nodes are hashes, and groups that share members share centres
        place = F.row_number().over(Window.partitionBy("grp").orderBy("node"))
        partners = known.where("component = largest").withColumn("place", place).where(F.col("place") <= centres).drop("place", "largest")
    across = (F.col("u_component") != F.col("component")) & ((F.col("component") == F.col("largest")) | (F.col("u_node") < F.col("node")))
    near = _near(F.col("u_n"), F.col("n"), F.col("u_sketch"), F.col("sketch"), threshold)
    pairs = seekers.join(partners, "grp").where(across & near)
    return pairs.select(F.least("u_node", "node").alias("a"), F.greatest("u_node", "node").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of (a, b) edges: the component is its smallest node.

    Large-star and small-star rounds: each node hands its larger neighbours,
    then its smaller ones, to its smallest neighbour, until nothing changes.
    Each round is a table in the shared folder.
    """
    spark = edges.sparkSession
    current = materialize(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "jaccard-stars")
    print_of = lambda df: df.agg(F.count("u"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    before = print_of(current)
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(spark, large.where("u <> v").distinct(), "jaccard-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        current = materialize(spark, small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "jaccard-stars")
        after = print_of(current)
        if tuple(after) == tuple(before):
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def similar_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    width: int = 5,
    threshold: Threshold = Threshold(),
    small_group: int = 4,
    centres: int = 8,
    max_leaders: int = 1024,
    leader_bytes: int = 16 << 20,
) -> DataFrame:
    """One row a document: id, n_shingles and component_id (see the module's head).

    ``max_leaders`` (and ``leader_bytes``, their sets) bounds what workers get
    of them; it steers the work and not the result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    described = materialize(spark, _described(rows, width), "jaccard-texts")
    texts = described.where("kind = 0").select("id", "node", "n")
    best = F.min(F.struct(F.col("id").isNull().alias("unknown"), F.col("id"))).alias("best")
    filled = described.where("kind = 0 and n > 0")
    nodes = materialize(spark, filled.groupBy("node").agg(best, F.min("n").alias("n"), F.min("sketch").alias("sketch"), F.min("mark").alias("mark")), "jaccard-nodes")
    total, largest = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()

    frequent = described.where("kind = 2").groupBy("low").agg(F.sum("n").alias("n"), F.min_by(F.struct("node", "shingles"), "node").alias("first"))
    leaders, held = {}, 0
    for row in frequent.orderBy(F.desc("n"), "low").limit(max_leaders).collect():
        held += len(row.first.shingles)
        if held > leader_bytes:
            break
        leaders[row.low] = (row.first.node, np.frombuffer(row.first.shingles, "<u8"))
    plan = Plan(width, threshold, threshold.bands(max(1, largest)), _common(described), leaders, log_buckets(total))

    groups = materialize(spark, _groups(_packed_signatures(rows, plan), small_group), "jaccard-groups")
    edges = groups.where("kind = 1").select("a", "b").distinct()
    pairs = materialize(spark, _possible(groups.where("kind = 0").select("a", "b").distinct(), nodes, threshold), "jaccard-pairs")
    links = materialize(spark, edges.unionByName(_linked(pairs, rows, nodes, width, threshold)), "jaccard-links")
    labels = components(links)
    # a few nodes of a group's largest class settle most of what is left; the last step compares the rest with all
    for some in (centres, None):
        members = _open_members(groups, labels, nodes)
        if members is None:
            break
        more = materialize(spark, _across_classes(members, threshold, some).join(pairs, ["a", "b"], "left_anti"), "jaccard-pairs")
        if not more.isEmpty():
            links = materialize(spark, links.unionByName(_linked(more, rows, nodes, width, threshold)), "jaccard-links")
            pairs = pairs.unionByName(more)
            labels = components(links)

    named = nodes.select("node", "best").join(labels, "node")
    smallest = materialize(spark, named.groupBy("component").agg(F.min("best").alias("smallest")), "jaccard-classes")
    classes = labels.join(smallest, "component").select("node", "smallest")
    known = materialize(spark, nodes.select("node", "best").join(classes, "node", "left").select("node", F.coalesce("smallest", "best")["id"].alias("component_id")), "jaccard-labels")
    out = texts.join(known, "node", "left")
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
