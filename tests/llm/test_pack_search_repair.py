"""Packing, ranked lexical search and conversation repair against brute force on
small tables, and their edge cases: nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns with clashing names."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zoneflow.llm import lexical, packing, repair
from zoneflow.llm.queries import WORD_TOKENIZER

# names that the operators use inside
SCHEMA = "doc_id long, text string, key string, ids string, start long, part int, sequence_id long, offset long, score double, item long"


def table(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "k", "x", 7, 7, 7, 7, 7.0, 7) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def tokenizer_json():
    with open(WORD_TOKENIZER, encoding="utf-8") as file:
        return file.read()


# --- packing ----------------------------------------------------------------------------


def library_ids(text):
    tokenizer = Tokenizer.from_file(WORD_TOKENIZER)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("length", [1, 7, 64, 100])
def test_packing_cuts_one_row_of_ids(spark, length):
    rng = random.Random(length)
    texts = [None, "", " \t\n", "Word, word; (WORD) word- J\u030c. j\u030c, don't!' A-b.", "It's  5 o'clock, we'll", "é é ÀÉ x", "<|endoftext|> a<|startoftext|>", "x" * 3000, "\x01 a\x01b \x01\x01", "a b " * 500, *(" ".join(rng.choice(["ab", "cde", "12", "?!"]) for _ in range(rng.randint(0, 60))) for _ in range(60))]
    docs = table(spark, texts).repartition(5)
    pieces = packing.pack(docs, tokenizer_json(), length=length)
    rows = pieces.collect()
    assert pieces.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert 4 * r.length == len(r.ids) and 0 < r.length <= length
        by_doc[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, bytes(r.ids)))
    for i, text in enumerate(texts):
        expected = np.array(library_ids(text), "<u4").tobytes()
        parts = sorted(by_doc[i])
        assert b"".join(x for _, x, _ in parts) == expected
        assert {n for _, _, n in parts} == {len(expected) // 4}
        assert [a for a, _, _ in parts] == np.cumsum([0, *(len(x) // 4 for _, x, _ in parts)])[:-1].tolist()
    wholes = {}
    for w, parts in by_sequence.items():
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0, *(len(x) // 4 for _, x in parts)])[:-1].tolist()
        wholes[w] = b"".join(x for _, x in parts)
    assert sorted(wholes) == list(range(len(wholes)))
    # all are full but the last
    assert all(len(x) == 4 * length for w, x in wholes.items() if w + 1 < len(wholes))
    for r in packing.sequences(pieces, length, pad_id=9).collect():
        n = len(wholes[r.sequence_id]) // 4
        assert r.n_tokens == n and r.padding == (0 if n & (n - 1) == 0 else length - n)
        assert bytes(r.ids) == wholes[r.sequence_id] + np.full(r.padding, 9, "<u4").tobytes()


def test_packing_repeated_null_ids_and_empty_table(spark):
    docs = table(spark, ["one two", "one two", None, "three"], [1, 1, None, None])
    rows = packing.pack(docs, tokenizer_json(), keep=("key", "offset")).drop("offset").collect()
    assert collections.Counter(r.doc_id for r in rows) == {1: 2, None: 2}
    assert packing.pack(docs.limit(0), tokenizer_json()).count() == 0
    assert packing.sequences(packing.pack(docs.limit(0), tokenizer_json())).count() == 0


# --- ranked lexical search --------------------------------------------------------------


def brute_search(texts, items, k=10, ids=None):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs = [words(t) for t in texts]
    n, total = sum(bool(d) for d in docs), sum(map(len, docs))
    df = collections.Counter(w for d in docs for w in set(d))
    out = []
    for item, text in items:
        scored = []
        for i, d in enumerate(docs):
            tf, score = collections.Counter(d), 0
            m = 25 + (75 * len(d) * n) // total if total else 0
            for w in words(text):
                if tf[w]:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m))
            if score:
                name = ids[i] if ids else i
                scored.append((-score, name is not None, name or 0, name))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=lambda r: (r[0], r[1]))


def found(rows):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=lambda r: (r[0], r[1]))


def vocabulary_text(rng, n):
    return " ".join(f"w{min(int(rng.paretovariate(0.6)), 400)}" + rng.choice(["", ",", ".", "-", " É"]) for _ in range(n))


@pytest.mark.parametrize("leaf_bytes", [200, 5000, 1 << 20])
def test_search_equals_brute_force(spark, monkeypatch, leaf_bytes):
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", leaf_bytes)
    rng = random.Random(leaf_bytes)
    texts = [None, "", "?! ", "W1 w1 É É", *(vocabulary_text(rng, rng.randint(1, 80)) for _ in range(300))]
    texts += [texts[9]] * 30  # ties
    items = [(0, texts[9]), (1, "W1 w1 w1 nowhere"), (2, None), (3, "nowhere"), (4, ""), *((i, vocabulary_text(rng, 12)) for i in range(5, 25))]
    docs = table(spark, texts).repartition(4)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, item long, terms int")
    assert found(lexical.search(lexical.build_index(docs), asked).collect()) == brute_search(texts, items)
    # several blocks of items
    assert found(lexical.search(lexical.build_index(docs), asked, block_terms=40).collect()) == brute_search(texts, items)


def test_search_scores_few_documents_when_bounds_tell_them_apart():
    rng = np.random.default_rng(3)
    n = 4000
    starts, rows = np.array([0, n, n + 40]), np.concatenate([np.arange(n), np.sort(rng.choice(n, 40, replace=False))])
    segment = lexical.Segment(list(range(n)), np.full(n, 50), np.array([0, 1]), starts, rows, np.ones(n + 40, np.int64), np.array([3, 9000]), n, 50 * n)
    best = lexical.Best(5)
    scored = lexical.search_segment(segment, np.array([0, 1]), np.array([1, 1]), best, leaf=16)
    assert scored < n // 10
    assert [key[1] for _, key in best.rows] == rows[n : n + 5].tolist()


def test_range_maxima():
    rng = np.random.default_rng(5)
    counts = rng.integers(1, 50, 200)
    segment = lexical.Segment(list(range(200)), np.full(200, 50), np.array([0]), np.array([0, 200]), np.arange(200), counts, np.array([1000]), 200, 10000)
    lo = rng.integers(0, 200, 500)
    hi = np.minimum(200, lo + rng.integers(0, 200, 500))
    at, top = segment.best(lo, hi)
    for a, b, i, t in zip(lo, hi, at, top, strict=True):
        assert t == (segment.impacts[a:b].max() if b > a else 0)
        assert b == a or a <= i < b


def test_search_null_and_repeated_ids_and_empty_tables(spark):
    texts, ids = ["a b", "a b", "a b", "c"], [None, 2, 2, 1]
    docs, asked = table(spark, texts, ids), spark.createDataFrame([(5, "a"), (5, "a"), (None, "c a")], "item_id long, text string")
    rows = lexical.search(lexical.build_index(docs), asked).collect()
    assert sorted((r.item_id is None, r["rank"], str(r.doc_id)) for r in rows) == sorted([(False, i, d) for i, d in ((1, "None"), (2, "2"), (3, "2"))] * 2 + [(True, 1, "1"), (True, 2, "None"), (True, 3, "2"), (True, 4, "2")])
    assert lexical.search(lexical.build_index(docs.limit(0)), asked).count() == 0
    assert lexical.search(lexical.build_index(docs), asked.limit(0)).count() == 0
    assert lexical.search(lexical.build_index(docs.withColumn("text", F.lit(None).cast("string"))), asked).count() == 0


# --- conversation repair ----------------------------------------------------------------


def cheapest(codes, most_inserts=2):
    """All edits of a few rows, by enumeration."""
    best = None
    for edits in itertools.product("KDua", repeat=len(codes)):
        if any(c == "d" and e != "D" or c == "o" and e == "K" or c == "O" and e == "K" for c, e in zip(codes, edits, strict=True)):
            continue
        base = sum({"K": 0, "D": 2}.get(e, 1) + (5 if e != "D" and c.isupper() else 0) for c, e in zip(codes, edits, strict=True))
        for inserts in itertools.product(["", "u", "a", "ua", "au"][: 3 if most_inserts == 1 else 5], repeat=len(codes) + 1):
            roles = inserts[0] + "".join({"K": c.lower(), "D": ""}.get(e, e) + i for c, e, i in zip(codes, edits, inserts[1:], strict=True))
            if re.fullmatch("(s?(ua)+)?", roles):
                audit = "I" * len(inserts[0]) + "".join(("R" if e in "ua" else e) + "I" * len(i) for e, i in zip(edits, inserts[1:], strict=True))
                found = (base + 5 * sum(map(len, inserts)), audit)
                best = found if best is None or found < best else best
    return best


def test_cells_equal_enumeration():
    rng = random.Random(2)
    for n in (0, 1, 2, 3):
        for _ in range(40 if n else 1):
            codes = "".join(rng.choice("sSuUaAoOd") for _ in range(n))
            _, cost, audit = repair.accepted(repair.span_cell(codes) if codes else repair.CLOSURE)
            assert (cost, audit) == cheapest(codes), codes


def test_every_split_gives_the_same_cell():
    rng = random.Random(4)
    for _ in range(30):
        codes = "".join(rng.choice("sSuUaAoOd") for _ in range(12))
        whole = repair.span_cell(codes)
        assert all(repair.join(repair.span_cell(codes[:i]), repair.span_cell(codes[i:])) == whole for i in range(1, 12))
        cuts = sorted(rng.sample(range(1, 12), 4))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, 12], strict=True)]
        cost, edits = repair.spans_of_repair([repair.span_cell(p) for p in parts])
        assert (cost, "".join(a for _, a in edits)) == repair.accepted(whole)[1:]
        assert [sum(x != "I" for x in a) for _, a in edits] == [len(p) for p in parts]


def brute_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation by a left-to-right search."""
    rows = [r for r in rows for _ in range(r[3])]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = {r[0] for r in rows if r[0] is not None}
    counts, codes, seen = collections.Counter(), [], set()
    for _, role, text, _ in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        codes.append("d" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {0: (0, "", ())}

    def insert(best):
        for _ in range(3):
            for p, (c, a, said) in list(best.items()):
                q = after[p]
                row = (c + 5, a + "I", (*said, ("user:", "assistant:")[q - 2]))
                if q not in best or row[:2] < best[q][:2]:
                    best[q] = row
        return best

    best = insert(best)
    for (_, role, text, _), code in zip(rows, codes, strict=True):
        new = {}

        def put(q, row, new=new):
            if q not in new or row[:2] < new[q][:2]:
                new[q] = row

        extra = 5 if code.isupper() else 0
        for p, (c, a, said) in best.items():
            put(p, (c + 2, a + "D", said))
            if code != "d":
                q = after[p]
                put(q, (c + 1 + extra, a + "R", (*said, f"{('user', 'assistant')[q - 2]}:{text}")))
                if code.lower() == "ua"[q - 2]:
                    put(q, (c + extra, a + "K", (*said, f"{role}:{text}")))
                if code.lower() == "s" and p == 0:
                    put(1, (c + extra, a + "K", (*said, f"{role}:{text}")))
        best = insert(new)
    cost, audit, said = min(best[q] for q in (0, 3) if q in best)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()


ROWS = "conv long, turn long, role string, text string, copies long, rows string, cell string, part int"


def check_repair(spark, rows, partitions=None):
    frame = spark.createDataFrame([(*r, "x", "x", 3) for r in rows], ROWS)
    got = {r.conv: tuple(r)[1:] for r in repair.repair(frame).collect()}
    groups = collections.defaultdict(list)
    for conv, *row in rows:
        groups[conv].append(tuple(row))
    assert got == {conv: brute_repair(g) for conv, g in groups.items()}


def test_repair_equals_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(1, 9)):
            at = rng.choice([turn, turn, turn, None, 2])
            text = rng.choice(["a.", "b!", "c", "", " \n", "d? ", "long text, cut", f"{turn}."])
            rows.append((conv, at, rng.choice(["user", "assistant", "system", "", " ", "tool", "Uncle"]), text, rng.choice([1, 1, 1, 2, 0])))
    rows += [(None, 1, "user", "x.", 1), (None, 2, "assistant", "y.", 1), (777, 1, "user", "x.", 0)]
    rows = list({r[:4]: r for r in rows}.values())
    check_repair(spark, rows)
    monkeypatch.setattr(repair, "SPAN_ROWS", 3)  # conversations over several spans
    check_repair(spark, rows)


def test_repair_of_one_long_conversation_and_many_copies(spark):
    rng = random.Random(8)
    rows = [(5, turn, rng.choice(["user", "assistant"]), rng.choice(["same.", f"text {turn}.", f"cut {turn}"]), 1) for turn in range(3000)]
    rows += [(6, 1, "user", "hello.", 2000), (6, 2, "assistant", "well.", 1)]
    check_repair(spark, rows)


def test_repaired_turns_are_well_formed(spark):
    rows = [(1, 0, "assistant", "a.", 1), (1, 1, "user", "b.", 1), (1, 2, "user", "c", 1), (2, 0, "system", "s.", 1), (3, 4, "user", "x!", 2)]
    frame = spark.createDataFrame([(*r, "x", "x", 3) for r in rows], ROWS)
    turns = collections.defaultdict(list)
    for r in repair.repaired_turns(repair.repaired_spans(frame)).orderBy("conv", "part", "no", "place").collect():
        turns[r.conv].append(r.role[0])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(t)) for t in turns.values())
    assert repair.repair(frame.limit(0)).count() == 0


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "Hi. There!") for c in range(12) for t in range(12)] + [(None, None, None, None), (3, None, "system", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = collections.Counter(tuple(r) for r in repair.damaged(frame).collect())
    expected = collections.Counter()
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        expected[conv, turn, {0: "", 4: "user"}.get(h, role), {0: "", 1: "", 2: re.sub("[.!?]", "", text)}.get(h, text), {0: 0, 3: 2}.get(h, 1)] += 1
    assert got == expected
