"""What the operators promise about table size, repeated rows and unknown ids."""

import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from zoneflow.llm import jaccard, langid, quality, queries, toxicity, urlgraph  # noqa: E402
from zoneflow.llm.common import bounded_sample  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(n))


# --- decisions do not move with the bound of a sample -------------------------------------


def test_toxicity_keeps_its_bias_when_classes_are_thinned(spark):
    rng = random.Random(1)
    mild, strong = ["bother", "nuisance"], ["vilewretch", "scumbagger"]
    texts, toxic = [], []
    for i in range(1500):
        bad = i % 10 == 0
        words = prose(rng, 40).split() + ([rng.choice(strong)] if bad else []) + ([rng.choice(mild)] if bad and i % 20 or rng.random() < 0.05 else [])
        rng.shuffle(words)
        texts.append(" ".join(words))
        toxic.append(int(bad))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic[:1000])], "doc_id long, toxic int")
    shares = {}
    for bound in (10_000, 100):  # the second makes the classes even
        model = toxicity.fit(docs, labels, max_rows=bound)
        held = {r.doc_id: r for r in toxicity.score(docs, model).where("doc_id >= 1000").collect()}
        assert model.bias < -1 and all(held[i].predicted for i in range(1000, 1500) if toxic[i])
        shares[bound] = np.mean([r.score for r in held.values()])
    # of the held-out documents a tenth is toxic, and so the model holds on average
    assert shares[10_000] == pytest.approx(0.1, abs=0.02) and shares[100] == pytest.approx(0.1, abs=0.05), shares


def test_language_models_are_calibrated_on_other_texts(spark, monkeypatch):
    seen = []

    def noted(rows, *args, **kwargs):
        out = bounded_sample(rows, *args, **kwargs)
        seen.append({r.id for r in out.collect()})
        return out

    monkeypatch.setattr(langid, "bounded_sample", noted)
    rng = random.Random(2)
    rows = [(i, prose(rng, 20, "abcd" if i % 2 else "wxyz"), "ab" if i % 2 else "wx") for i in range(300)] + [(400 + i, prose(rng, 20, "mnop"), "rare") for i in range(3)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    train, calibration = seen
    assert not train & calibration and len(calibration) > 10
    assert train | calibration == {r[0] for r in rows}
    assert {400, 401, 402} <= train and "rare" in model.languages  # too few to set any apart


# --- links over any distance ----------------------------------------------------------------


def test_distrust_reaches_the_far_end_of_a_chain(spark):
    n = 24
    rules = [urlgraph.Rule("block", "h0.net", "/")]
    pages = [(i, f"http://h{i}.net/", f'<a href="http://h{i - 1}.net/">x</a>' if i else None) for i in range(n)]
    state = urlgraph.spread_trust(
        spark.createDataFrame([(f"h{i}.net", 0.0, float(i == 0)) for i in range(n)], "host string, allowed double, blocked double"),
        spark.createDataFrame([(f"h{i}.net", f"h{i - 1}.net", 1) for i in range(1, n)], "source string, target string, links long"),
        None,
        0.6,
        tolerance=0.01,
    )
    got = {r.host: r.distrust for r in state.collect()}
    for i in range(n):
        assert got[f"h{i}.net"] == pytest.approx(0.4 * 0.6**i, rel=0.03)
    assert urlgraph.judge(spark.createDataFrame(pages[:4], "page_id long, url string, html string"), rules).where("verdict = 'block'").count() == 4


# --- the pipeline's stages --------------------------------------------------------------------


def test_one_row_of_each_group_of_copies_stays(spark):
    rng = random.Random(3)
    t, u, v, w = (prose(rng, 60) for _ in range(4))
    near = " ".join([*u.split()[:-1], "changed"])
    rows = [(1, t), (1, t), (2, u), (3, u), (3, v), (None, t), (None, t), (None, w), (None, w), (5, near), (6, ""), (6, ""), (7, None), (7, None)]
    docs = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in rows], DOCUMENTS)
    out = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert out == Counter({(1, t): 1, (2, u): 1, (3, v): 1, (None, w): 1, (6, ""): 2, (7, None): 2})
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), "").count() == 0


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of small tables with repeated, clashing and unknown ids."""
    rng = random.Random(4)
    good = lambda: ". ".join(prose(rng, 9).capitalize() for _ in range(8)) + "."
    bad = lambda: " ".join([prose(rng, 1)] * 30)
    rows = [(i, good() if i % 4 else bad()) for i in range(400)]
    rows += [(i, t + " you vilewretch") for i, t in [(1000 + i, good()) for i in range(60)]]
    rows += [(None, good()), (None, None), (7, good()), (7, rows[7][1]), (8, "x" * 100_000)]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 4 > 0), 0) for i in range(200)] + [(1000 + i, 1, 1) for i in range(30)] + [(3, None, None), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, rows[5][1]), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_with_odd_rows(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    key = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    before = key(docs)
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, tables).write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        after = key(docs)
        assert docs.columns == columns and not after - before, name
        if name == "toxicity":
            assert not any((t or "").endswith("vilewretch") for _, t in after)
            assert (None, None) in after and np.mean([(i, t) in after for i, t in before if not (t or "").endswith("vilewretch")]) > 0.98
        if name == "decontamination":
            assert not any(i == 5 for i, _ in after)
        before = after
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, tables).count() == sum(before.values())


def test_stages_of_an_empty_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables).where(F.lit(True)).count() == 0, name


# --- every operator on odd tables -----------------------------------------------------------

ODD = "doc_id long, text string, lang string, key string, score double, predicted int, node long, block long, item long"


def odd(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "k", 9.0, 9, 9, 9, 9) for i, t in zip(ids, texts, strict=True)], ODD)


def test_language_id_ties_repeats_and_empty_tables(spark):
    train = spark.createDataFrame([(i, "abc cab bca", lang) for i, lang in enumerate(["yy", "xx"] * 9)], "doc_id long, text string, lang string")
    model = langid.fit(train)  # too few texts to set any apart: equal models
    docs = odd(spark, ["abc cab", "abc cab", None, "a" * 200_000, ""], [1, 1, 2, None, None])
    out = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, model).collect()]
    assert Counter(p for _, p, _ in out) == {"xx": 3, "und": 2}  # the smaller name
    assert out[0] == out[1] and langid.predict(docs.limit(0), model).count() == 0


def test_classifiers_on_long_repeated_and_no_rows(spark):
    rng = random.Random(7)
    texts = [prose(rng, 30) + (" vilewretch" if i % 5 == 0 else "") for i in range(100)]
    docs = odd(spark, texts)
    toxic = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(100)], "doc_id long, toxic int"))
    good = quality.fit(docs, spark.createDataFrame([(i, 1) for i in range(0, 60, 2)], "doc_id long, quality int"))
    asked = odd(spark, ["x" * 3_000_000, "vilewretch " * 100_000, "same text", "same text", None, ""], [1, 2, 3, 3, None, None])
    for module, model in ((toxicity, toxic), (quality, good)):
        rows = module.score(asked, model).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
        assert len({r.score for r in rows if r.doc_id == 3}) == 1 and len({r.score for r in rows if r.doc_id is None}) == 1
        assert module.score(asked.limit(0), model).count() == 0
    assert {r.doc_id: r.predicted for r in toxicity.score(asked, toxic).collect()}[2] == 1


def test_urls_with_a_very_long_body(spark):
    link = '<a href="https://bad.net/">x</a>'
    pages = spark.createDataFrame([(1, "http://far.org/", "y" * 2_000_000 + link * 20_000), (1, "http://far.org/", None)], "page_id long, url string, html string")
    out = urlgraph.judge(pages.withColumn("verdict", F.lit("x")).withColumn("trust", F.lit(1)), [urlgraph.Rule("block", "bad.net", "/")]).collect()
    assert [(r.page_id, r.host, r.verdict) for r in out] == [(1, "far.org", "allow")] * 2  # bad.net has no page that a rule blocks
    both = pages.unionByName(spark.createDataFrame([(2, "http://bad.net/x", None)], pages.schema))
    assert {r.verdict for r in urlgraph.judge(both, [urlgraph.Rule("block", "bad.net", "/")]).collect()} == {"block"}


def test_chat_of_odd_conversations(spark, tmp_path):
    rows = [(1, None, "user", "b"), (1, 0, "assistant", "x"), (1, 0, "assistant", "x"), (1, 0, "assistant", "a"), (2, 3, None, None), (None, 1, "user", "h\\i<#"), (3, 1, "assistant", "z" * 300_000)]
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame(rows, schema)
    frame.withColumns({"formatted": F.lit("x"), "turns": F.lit(1), "record": F.lit(2)}).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op8_chat_format(spark, str(tmp_path)).collect()}
    groups = {}
    for conv, turn, role, text in rows + [(-7, i, r, "\\### Assistant: </turn> ok") for i, r in enumerate(("user", "assistant"))]:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(groups)
    for conv, turns in groups.items():
        turns.sort()
        said, loss = "".join(f"{r}\n{t}\n" for _, _, r, t in turns), "".join(t for _, _, r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    frame.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert [r.conv_id for r in queries.op8_chat_format(spark, f"{tmp_path}/none").collect()] == [-7]


def test_groups_of_unknown_ids(spark):
    rng = random.Random(8)
    t, u = prose(rng, 60), prose(rng, 60)
    near = " ".join([*t.split()[:-1], "other"])
    docs = odd(spark, [t, near, u, u, None, "", "one two"], [None, 5, None, None, None, 6, None])
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs).collect()]
    assert Counter(rows) == Counter([(None, 56, 5), (5, 56, 5), (None, 56, None), (None, 56, None), (None, 0, None), (6, 0, 6), (None, 1, None)])
