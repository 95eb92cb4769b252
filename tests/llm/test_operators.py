"""The corpus operators against brute force on small tables, and their edge cases:
nulls, empty and very long texts, ties, repeated rows, empty tables and extra
columns with clashing names."""

import base64
import collections
import hashlib
import itertools
import math
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from zoneflow.llm import bpe, chat, decontam, jaccard, langid, lm, quality, topk, toxicity, urlgraph
from zoneflow.llm.queries import BPE_RANKS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, predicted int, node long, key string, block long"


def table(spark, texts, langs=None):
    """Documents with extra columns whose names the operators use inside."""
    rows = [(i, t, langs[i] if langs else None, "s", 0, 9.0, 9, 9, "k", 9) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(n))


# --- byte-level BPE ---------------------------------------------------------------------


def test_bpe_equals_the_library_on_awkward_texts(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "  a  b ", "a\n\n b\t c ", "it's we'll 12 345", "x y  z", "äöü ß 漢字 😀👍🏽", "<|endoftext|>", "a" * 5000, prose(rng, 30000), "a b", "a b", "\u0085\u001c q"]
    got = bpe.decode(bpe.encode(table(spark, texts), BPE_RANKS, public_tokenizers.PATTERN), BPE_RANKS).orderBy("doc_id").collect()
    ranks = bpe.load_ranks(BPE_RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert [r.doc_id for r in got] == list(range(len(texts)))
    for r, t in zip(got, texts, strict=True):
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(t or "")
        assert bytes(r.decoded) == (t or "").encode()
    assert base64.b64encode(next(iter(ranks))) is not None


def test_bpe_decodes_large_batches_in_slices(spark, monkeypatch):
    seen = []

    def slices(batch, column="text", max_bytes=0, give_back=False):
        seen.append((column, max_bytes, give_back))
        return (batch.slice(i, 1) for i in range(batch.num_rows))

    monkeypatch.setattr(bpe, "text_slices", slices)

    class Encoded:
        """Stands for a frame whose tasks run here."""

        columns, sparkSession = ["doc_id", "ids"], spark

        def select(self, *columns):
            return spark.createDataFrame([(1, "", "")], "doc_id long, ids_sha256 string, decoded_sha256 string")

        def mapInArrow(self, work, schema):  # noqa: N802

            batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "ids": [np.array([72, 73], "<u4").tobytes(), b""]})
            return list(work(iter([batch])))

    out = bpe.decode(Encoded(), BPE_RANKS, digests=True)
    assert [b.num_rows for b in out] == [1, 1] and seen == [("ids", 4 << 20, True)]
    assert out[1].column("decoded_sha256").to_pylist() == [hashlib.sha256(b"").hexdigest()]


def test_bpe_repeated_rows_and_empty_table(spark):
    docs = table(spark, ["one two", "one two"])
    assert bpe.encode(docs.unionByName(docs), BPE_RANKS, public_tokenizers.PATTERN).count() == 4
    assert bpe.decode(bpe.encode(docs.limit(0), BPE_RANKS, public_tokenizers.PATTERN), BPE_RANKS, digests=True).count() == 0


# --- n-gram Jaccard join ----------------------------------------------------------------


def brute_groups(texts, width=5, p=80, q=100):
    sets = []
    for t in texts:
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")).replace("\t", " ").replace("\n", " ").split(" ") if x]
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and q * shared >= p * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    passage = prose(rng, 40)
    texts = [None, "", "  \n ", "one", "One", "one two three four five", "one two three four FIVE", "a b c d e f", "a b c d e g"]
    for _ in range(25):  # families whose members differ by a growing number of words, around the threshold
        words = prose(rng, rng.choice([8, 12, 20, 60, 150, 400])).split()
        for k in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(k * max(1, len(copy) // 60)):
                copy[rng.randrange(len(copy))] = prose(rng, 1)
            texts.append(" ".join(copy))
    texts += [prose(rng, rng.randint(3, 60)) + " " + passage + " " + prose(rng, rng.randint(3, 60)) for _ in range(30)]
    base = prose(rng, 80).split()
    for _ in range(40):  # a large group of near copies
        copy = list(base)
        copy[rng.randrange(len(copy))] = prose(rng, 1)
        texts.append(" ".join(copy))
    texts += [texts[-1]] * 12 + [prose(rng, 6000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(table(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_groups(texts)


def test_groups_of_nothing_and_of_repeated_rows(spark):
    docs = table(spark, ["a b c d e f g", None])
    assert jaccard.similar_groups(docs.limit(0)).count() == 0
    assert sorted(map(tuple, jaccard.similar_groups(docs.unionByName(docs)).collect())) == [(0, 3, 0), (0, 3, 0), (1, 0, 1), (1, 0, 1)]


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(5)
    threshold = jaccard.Threshold()
    common = np.zeros(1 << jaccard.LOG_COUNTERS, bool)
    common[rng.integers(0, len(common), 300_000)] = True
    for n in [5, 6, 9, 13, 40, 100, 333]:
        for none in (common, np.zeros_like(common)):
            for _ in range(30):
                x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
                gone = rng.integers(0, n // 5 + 1)
                y = np.unique(np.concatenate([x[gone:], rng.integers(0, 1 << 63, rng.integers(0, n // 9 + 1)).astype(np.uint64)]))
                if jaccard.linked(x, y, threshold) and len(x) != len(np.intersect1d(x, y)):
                    ends = threshold.bands(1000)
                    a, b = (jaccard.signatures(s, none, threshold, ends) for s in (x, y))
                    assert len(np.intersect1d(a, b))
                    h = sum(int(v).bit_count() for v in (jaccard.bit_sketch(x) ^ jaccard.bit_sketch(y)).view(np.uint64))
                    assert h <= len(np.setxor1d(x, y))


# --- top-k ------------------------------------------------------------------------------


def test_topk_equals_brute_force_with_ties_and_unsound_vectors(spark):
    rng = np.random.default_rng(3)
    vectors = [rng.normal(size=8).astype(np.float32).tolist() for _ in range(300)]
    vectors[10:40] = [vectors[10]] * 30  # ties
    vectors[50], vectors[51], vectors[52], vectors[53] = None, [1.0, None] * 4, [float("nan")] * 8, [float("inf")] * 8
    vectors[54], vectors[100] = [0.5, 0.25], []
    rows = spark.createDataFrame([(i, v, 1.0, 2) for i, v in enumerate(vectors)] + [(7, vectors[7], 1.0, 2)], "vec_id long, embedding array<float>, score double, rank int")
    got = sorted(map(tuple, topk.search(rows, F.col("vec_id") % 50 == 0, vectors_a_block=64, queries_a_block=2).collect()))
    ints = {i: np.array([math.floor(256 * float(np.float32(c))) for c in v] + [0] * (8 - len(v))) for i, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    want = []
    for q in (i for i in ints if i % 50 == 0):
        best = sorted((-int(ints[q] @ x), i) for i, x in ints.items() if i != q)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)
    assert topk.search(rows.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_bounds_spare_products():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (20, 16))
    x = np.concatenate([c + rng.integers(-20, 20, (200, 16)) for c in centres])
    pivots = topk.choose_pivots(x.astype(float), 24)
    d = np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots], 1)
    *_, evaluated = topk.search_cell(x[:5], np.arange(5), d[:5], x, np.arange(len(x)), d, 5, step=64)
    assert evaluated < 5 * len(x) / 2


# --- decontamination --------------------------------------------------------------------


def brute_hits(text, items, window=13):
    import re

    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, names = cut(text), set(), set()
    for name, item in items:
        v = cut(item)
        size = min(window, len(v))
        for s in range(len(v) - size + 1 if size else 0):
            for i in range(len(w) - size + 1):
                if w[i : i + size] == v[s : s + size]:
                    hit |= set(range(i, i + size))
                    names.add(name)
    return len(w), len(hit), len(names), sorted(names), bool(hit) and 20 * len(hit) >= len(w)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(7)
    long_items = [prose(rng, n) for n in (13, 14, 30, 60, 20)]
    items = [(str(i), t) for i, t in enumerate([*long_items, long_items[2], "lone", "two words", "a b c d", "", None, "one One. one"])]
    texts = [None, "", "none of it", "the lone wolf", "TWO words, two words", "x a b c d y a b c d", "one one one one"]
    for t in long_items:
        w = t.split()
        texts += [prose(rng, 50) + " " + t + " " + prose(rng, 900), " ".join(w[:12]), " ".join(w[:13]), " ".join(w[1:14] + w[:13]), t.upper().replace(" ", " - "), t + " " + t]
    docs = table(spark, texts)
    bench = spark.createDataFrame([(int(i), t, 1) for i, t in items], "item_id long, text string, k int")
    for limit in (500_000, 0):  # by broadcast and by shuffle
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in decontam.contamination(docs, bench, broadcast_rows=limit).collect()}
        assert [got[i] for i in range(len(texts))] == [brute_hits(t, items) for t in texts]
    kept = decontam.without_contaminated(docs.unionByName(docs), bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(2 * [i for i, t in enumerate(texts) if not brute_hits(t, items)[-1]])
    assert decontam.contamination(docs, bench.limit(0)).where("contaminated or n_hit > 0").count() == 0
    assert decontam.contamination(docs.limit(0), bench).count() == 0


# --- URL verdicts -----------------------------------------------------------------------


def test_urls_without_a_rule_follow_the_link_graph(spark):
    rules = [urlgraph.Rule("allow", "good.com", "/"), urlgraph.Rule("block", "bad.net", "/")]
    link = lambda h: f'<a href="https://{h}/x">x</a> <img src=//{h}/y>'
    pages = [
        (1, "http://GOOD.com/a", link("friend.org")),
        (2, "http://www.bad.net/a?b", link("friend.org")),
        (3, "http://farm.org/z#t", link("www.bad.net") * 5),
        (4, "http://friend.org/", link("good.com")),
        (5, "http://far.org/", None),
        (6, None, link("www.bad.net")),
        (7, "no-scheme", None),
        (8, "http://notgood.com", ""),
        (8, "http://farm.org", ""),
    ]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, host string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlgraph.judge(df, rules).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, "good.com", "/a", "good.com/", "allow"),
            (2, "www.bad.net", "/a", "bad.net/", "block"),
            (3, "farm.org", "/z", None, "block"),
            (4, "friend.org", "/", None, "allow"),
            (5, "far.org", "/", None, "allow"),
            (6, "", "", None, "allow"),
            (7, "", "", None, "allow"),
            (8, "notgood.com", "", None, "allow"),
            (8, "farm.org", "", None, "block"),
        ],
        key=str,
    )
    assert urlgraph.judge(df.limit(0), rules).count() == 0


def test_spread_equals_dense_power_iteration(spark):
    rng = np.random.default_rng(9)
    n = 12
    m = rng.integers(0, 3, (n, n)) * (1 - np.eye(n, dtype=int))
    seeds = [(f"h{i}", float(i % 3 == 0), float(i % 4 == 1)) for i in range(n)]
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", int(m[i, j])) for i in range(n) for j in range(n) if m[i, j]], "source string, target string, links long")
    got = {r.host: (r.trust, r.distrust) for r in urlgraph.spread_trust(spark.createDataFrame(seeds, "host string, allowed double, blocked double"), edges, 6, 0.6).collect()}
    t0, d0 = np.array([s[1] for s in seeds]), np.array([s[2] for s in seeds])
    out, into = m / np.maximum(m.sum(1, keepdims=True), 1), m / np.maximum(m.sum(0, keepdims=True), 1)
    t, d = 0.4 * t0, 0.4 * d0
    for _ in range(6):
        t, d = 0.4 * t0 + 0.6 * (t @ out), 0.4 * d0 + 0.6 * (into @ d)
    for i in range(n):
        assert got[f"h{i}"] == pytest.approx((t[i], d[i]))


# --- chat formatting --------------------------------------------------------------------


def test_layouts_are_found_by_fingerprint(spark):
    lines = [
        '{"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": null}]}',
        '{"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]}',
        '{"instruction": "add", "input": "1 2", "output": "3"}',
        '{"instruction": "add", "output": "3", "system": "be brief"}',
        '{"prompt": "p", "completion": "c"}',
        '{"prompt": "p", "response": "r"}',
        '{"question": "q", "answer": "a", "context": "x"}',
        '{"question": "q", "prompt": "p"}',
    ]
    merged = spark.read.json(spark.sparkContext.parallelize(lines)).select(F.struct("*").alias("record"), F.lit("x").alias("formatted0"))
    got = chat.format_turns(chat.canonical_turns(merged, "record")).select("layout", "turns", "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("back")).collect()
    turns = {r.layout: [] for r in got}
    for r in got:
        turns[r.layout].append(None if r.turns is None else [tuple(t) for t in r.turns])
        assert [tuple(t) for t in r.back] == [tuple(t) for t in r.turns or []]
        assert len(r.loss_spans) == sum(t.role == "assistant" for t in r.turns or [])
    assert turns == {
        "messages": [[("user", "hi"), ("assistant", "")]],
        "speakers": [[("user", "hi"), ("assistant", "yo")]],
        "instruction": [[("user", "add\n\n1 2"), ("assistant", "3")], [("system", "be brief"), ("user", "add"), ("assistant", "3")]],
        "prompt and completion": [[("user", "p"), ("assistant", "c")]],
        "prompt and response": [[("user", "p"), ("assistant", "r")]],
        "question and answer": [[("system", "x"), ("user", "q"), ("assistant", "a")]],
        None: [None],
    }


def test_template_is_reversible(spark):
    rng = random.Random(2)
    bits = ["\\", "#", "<", "### ", "</turn>\n", ":\n", "\\l", "\\b", "😀", "\n", "", "assistant", "\\\\h"]
    convs = [[("".join(rng.choices(bits, k=3)) if rng.random() < 0.3 else rng.choice(["user", "assistant"]), "".join(rng.choices(bits, k=rng.randint(0, 9)))) for _ in range(rng.randint(0, 6))] for _ in range(200)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(convs)], f"i int, turns {chat.TURNS}")
    out = chat.format_turns(df)
    for r in out.select("turns", "formatted", chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect():
        assert [tuple(t) for t in r.back] == [tuple(t) for t in r.turns]
        assert r.loss == "".join(t.text for t in r.turns if t.role == "assistant")


# --- language model ---------------------------------------------------------------------


def test_lm_base_is_exact_and_the_model_prefers_what_it_read(spark):
    rng = random.Random(4)
    texts = [None, "", "A a\tb ", *(prose(rng, rng.randint(1, 300)) for _ in range(60)), "seen words " * 40, "seen words " * 40, "x" * 3000]
    out = {r.doc_id: r for r in lm.score(table(spark, texts), held_out=F.col("doc_id") % 5 == 1).collect()}
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split() + [" "]
    counts = collections.Counter(w for i, t in enumerate(texts) if i % 5 != 1 for w in low(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in enumerate(texts):
        r, w = out[i], low(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i % 5 == 1, len(w), sum(x in counts for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
        assert r.score < 0
    assert out[63].score > out[63].base_score
    assert lm.score(table(spark, texts).limit(0)).count() == 0
    nothing = lm.score(table(spark, ["a b"]), held_out=F.lit(True)).first()
    assert (nothing.train_tokens, nothing.n_known, nothing.n_tokens) == (0, 0, 3)


def test_lm_keeps_every_trained_ngram(spark):
    texts = [" ".join(f"w{i}" for i in range(10_900)), " ".join(f"w{i}" for i in range(0, 10_900, 2))]
    out = lm.score(table(spark, texts), held_out=F.col("doc_id") == 1).where("doc_id = 1").first()
    n, v = 10_901, 10_901
    assert (out.n_tokens, out.n_known, out.train_tokens) == (5_451, 5_451, n)
    # every word and the end token are known once, no bigram but the first; the filter may add to counts, never take away
    once = math.log10(1.5 / (n + 0.5 * (v + 1)))
    assert out.score / out.n_tokens == pytest.approx(once, abs=0.2) and out.score / out.n_tokens > once - 0.001
    for tokens in (1, 10**6, 10**9, 10**11):
        assert tokens * 6 <= 1 << lm.filter_shape(tokens, 6.0).log_bits < max(1 << 17, tokens * 12)


def test_filter_returns_quantised_counts():
    shape = lm.FilterShape(20, 4)
    rng = np.random.default_rng(6)
    ngrams, counts = rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2), rng.integers(1, 2000, 5000)
    bits = np.zeros(1 << 20, bool)
    levels = shape.levels(counts)
    for level in range(1, levels.max() + 1):
        for place in shape.places(ngrams[levels >= level], level):
            bits[shape.segments(ngrams[levels >= level]) * shape.slice_bits + place] = True
    packed = np.packbits(bits, bitorder="little")
    found = lm.probe(packed, shape, ngrams)
    assert (found >= shape.count_of(levels)).all() and (found == shape.count_of(levels)).mean() > 0.95
    assert (lm.probe(packed, shape, rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2) + np.uint64(1)) > 0).mean() < 0.05


# --- classifiers ------------------------------------------------------------------------


def test_kneser_ney_prefers_seen_words_and_sums_to_at_most_one():
    words, counts = ["abab", "abc", "bca", "ca"], np.array([5, 3, 2, 1])
    model = langid.Lookup.of([langid.fit_model(words, counts, 3)])
    every = ["".join(w) for n in range(1, 7) for w in itertools.product("abc", repeat=n)]
    logs, sizes = langid.word_log_probabilities(model, every)
    p = dict(zip(every, 2 ** logs[:, 0], strict=True))
    assert sum(p.values()) <= 1 and sizes.tolist() == [len(w) + 1 for w in every]
    # a trigram model may prefer a shorter word, but of equal lengths the seen one
    assert max((w for w in p if len(w) == 4), key=p.get) == "abab" and p["abc"] > p["cba"] and p["ca"] > p["cb"]


def test_language_id(spark):
    rng = random.Random(3)
    texts = [prose(rng, 60, "abcd") if i % 2 else prose(rng, 60, "wxyz") for i in range(80)] + [None, "", "123 !!", "ABCD dcba", "z" * 20000]
    langs = ["ab" if i % 2 else "wx" for i in range(80)] + ["ab", "ab", "wx", None, None]
    docs = table(spark, texts, langs)
    out = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs), keep=("lang",)).collect()}
    assert [out[i].lang_pred for i in range(80)] == langs[:80]
    assert [out[i].lang_pred for i in range(80, 85)] == ["und", "und", "und", "ab", "wx"]
    assert all(0 <= r.score <= 1 for r in out.values()) and out[80].score == 0 and out[80].rejected
    nothing = langid.predict(docs, langid.fit(docs.limit(0)))
    assert nothing.where("lang_pred <> 'und'").count() == 0


def test_quality_learns_without_negatives(spark):
    rng = random.Random(5)
    good = lambda: ". ".join(prose(rng, 9).capitalize() for _ in range(8)) + "."
    bad = lambda: " ".join([prose(rng, 1)] * 30 + [prose(rng, 1)] * 30)
    texts = [good() if i % 4 else bad() for i in range(600)] + [None, ""]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, 1) for i in range(300) if i % 4] + [(1, 1), (2, None)], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality.score(docs, quality.fit(docs, labels), keep=("text",)).collect()}
    assert len(out) == 602 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    held = range(300, 600)
    assert np.mean([out[i].predicted == int(i % 4 > 0) for i in held]) > 0.95
    assert quality.fit(docs, labels.limit(0)) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}


def test_toxicity(spark):
    rng = random.Random(6)
    texts = [prose(rng, 40) + (" you Vilewretch! " if i % 5 == 0 else " ") + prose(rng, 40) for i in range(500)] + [None, "", "vilewretches"]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(250)] + [(0, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert [out[i].predicted for i in range(250, 500)] == [int(i % 5 == 0) for i in range(250, 500)]
    assert out[500].score == out[501].score < 0.5 < out[502].score
    assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0}
    few = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")  # no n-gram stands out
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, few)).collect()} == {0.5}
    share = toxicity.log_count_ratios(np.array([0]), np.array([0]), 10, 90)
    assert share[0] == pytest.approx(0)


def test_text_statistics_of_slices_are_those_of_whole_arrays():
    texts = pa.array(["A b. c!", "", "x x x x\nx x x x", "ÀÉ êü | #"])
    whole = quality.statistics(texts)
    assert np.allclose(whole[2:], quality.statistics(texts.slice(2)))
    assert not whole[1][: len(quality.CLASSES)].any()


def test_digest_columns_are_those_of_the_outputs(spark):
    one = table(spark, ["hello world"])
    row = bpe.decode(bpe.encode(one, BPE_RANKS, public_tokenizers.PATTERN), BPE_RANKS, digests=True).first()
    assert row.decoded_sha256 == hashlib.sha256(b"hello world").hexdigest()
