"""op9: sets, sketches and signatures are made for many texts at once, and only named texts are read again for linking."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from zoneflow.llm import jaccard
from zoneflow.llm.common import word_hashes

ODD = ["", " ", "a b  c", "x" * 100 + " y", "\t", "abc def", "é\x85 q\x0bz\x1cw", "x" * 100, "abcdefgh abcdefghi " + "y" * 64 + " " + "y" * 65, "abc", "abcd abc\x00 abc\x00\x00", "tail"]


def ascii_split(text):
    return text.translate({c: " " for c in range(9, 14)}).split(" ")


def test_word_hashes_tell_words_apart():
    for texts in (ODD, ODD[3:7], [], ["", ""]):
        for column in (pa.array(texts, pa.string()), pa.array(["head", *texts, "end"], pa.string()).slice(1, len(texts))):
            offsets, hashes = word_hashes(column)
            words = [[w for w in ascii_split(t) if w] for t in texts]
            assert offsets.tolist() == np.cumsum([0, *map(len, words)]).tolist()
            by_word = dict(zip((w for some in words for w in some), hashes.tolist(), strict=True))
            assert [by_word[w] for some in words for w in some] == hashes.tolist()
            assert len(set(by_word.values())) == len(by_word)


def test_sets_of_many_texts_are_those_of_each_text():
    rng = np.random.default_rng(3)
    texts = [*ODD, "a b c d e", "A  b\tc D e f", "a b c d e a b c d e a b c d e"]
    texts += [" ".join(rng.choice(list("abcdefgh"), n)) for n in rng.integers(0, 400, 600)]
    sets = jaccard.shingle_sets(pa.array(texts), 5)
    words = [[w for w in ascii_split(t.lower()) if w] for t in texts]
    shingles = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    assert sets.sizes.tolist() == [len(s) for s in shingles]
    nodes = jaccard.nodes_of(sets).tolist()
    assert len(set(nodes)) == len({frozenset(s) for s in shingles})
    assert len(set(zip(nodes, map(frozenset, shingles), strict=True))) == len(set(nodes))
    sketches, ends = jaccard.bit_sketches(sets), jaccard.Threshold().bands(500)
    common = rng.random(1 << jaccard.LOG_COUNTERS) < 0.3
    got = [[] for _ in texts]
    for part, some in enumerate(sets.parts(np.arange(len(sets)))):
        for key, owner in zip(*jaccard.signatures_of(some, common, jaccard.Threshold(), ends), strict=True):
            got[part * jaccard.PART + owner].append(key)
    for i in range(len(texts)):
        alone = jaccard.shingle_sets(pa.array(texts[i : i + 1]), 5)
        assert alone.values.tolist() == sets[i].tolist()
        assert sketches[i].tolist() == jaccard.bit_sketch(sets[i]).tolist()
        assert sorted(got[i]) == sorted(jaccard.signatures(sets[i], common, jaccard.Threshold(), ends))


def test_only_texts_of_named_marks_are_read_for_linking(spark):
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base), " ".join([*base, "end"]), "another text that has a few words"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").withColumn("mark", F.xxhash64("text"))
    ids = jaccard.nodes_of(jaccard.shingle_sets(pa.array(texts), 5)).tolist()
    marks = {r.id: r.mark for r in rows.collect()}
    pairs = spark.createDataFrame([(ids[0], ids[1])], "a long, b long")
    for second, links in ((marks[1], 1), (marks[2], 0)):  # the second node's text is left unread if another is named for it
        nodes = spark.createDataFrame([(ids[0], marks[0]), (ids[1], second), (ids[2], marks[2])], "node long, mark long")
        assert jaccard._linked(pairs, rows, nodes, 5, jaccard.Threshold()).count() == links


def test_blocks_send_few_rows_however_many_buckets():
    rng = np.random.default_rng(4)
    owner, nodes = rng.integers(0, 700, 20000), rng.integers(-(1 << 62), 1 << 62, 700)
    keys, leaders = rng.integers(0, 1 << 63, 20000).astype(np.uint64) << np.uint64(1), np.where(np.arange(700) % 3, nodes, 5)
    assert jaccard.log_buckets(0) == 4 and jaccard.log_buckets(85 << 20) == 12 and jaccard.log_buckets(1 << 40) == jaccard.MAX_LOG_BUCKETS <= 14
    for log in (4, 12):
        got = []
        for batch in jaccard._by_bucket(keys, owner, nodes, leaders, log):
            for row in batch.to_pylist():
                some = np.frombuffer(row["keys"], "<u4").astype(np.uint64)
                at = np.frombuffer(row["owners"], "<u2")
                assert len(np.unique(at)) * 8 == len(row["nodes"]) == len(row["leaders"])
                whole = (some | np.uint64(row["bucket"]) << np.uint64(32)) << np.uint64(32 - log)
                got += zip(whole.tolist(), np.frombuffer(row["nodes"], "<i8")[at].tolist(), np.frombuffer(row["leaders"], "<i8")[at].tolist(), strict=True)
        kept = keys >> np.uint64(32 - log) << np.uint64(32 - log)
        assert sorted(got) == sorted(zip(kept.tolist(), nodes[owner].tolist(), leaders[owner].tolist(), strict=True))
    assert not list(jaccard._by_bucket(keys[:0], owner[:0], nodes, leaders, 4))
