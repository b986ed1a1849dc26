import math
import random

import numpy as np

from revlens.llm import langid as G
from revlens.llm import quality as Q

SF = "/root/testdata/sf0.1"


def test_features_by_hand():
    text, at, x = Q.features(["a a a b", "", None or "  ", "%%%!", "a a a b"])
    assert sorted(set(text.tolist())) == [0, 3, 4]
    assert np.array_equal(at[text == 0], at[text == 4])
    for t in (0, 3):
        assert abs((x[text == t] ** 2).sum() - 1) < 1e-9
    # tokens a (3), b (1), a pair that repeats (2), the pair a b (1)
    want = sorted(math.log1p(c) for c in (3, 1, 2, 1))
    norm = math.sqrt(sum(v * v for v in want))
    assert np.allclose(sorted(x[text == 0]), [v / norm for v in want])
    assert (text == 3).sum() == 3  # one run of %, one !, their pair


def test_leader_update_by_hand():
    leader = Q.Leader(2)
    at, x = np.array([0, 2]), np.array([2.0, 1.0])
    leader.learn(at, x, 1)
    assert np.allclose(leader.z, [-1.0, 0, -0.5]) and np.allclose(leader.n, [1.0, 0, 0.25])
    w0 = (1.0 - Q.L1) / ((Q.BETA + 1.0) / Q.ALPHA + Q.L2)
    assert np.isclose(leader.weights(np.array([0, 2]))[0], w0)


def test_op9_held_out_accuracy(spark):
    got = Q.op9_quality(spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.count() == n and got.filter("score < 0 or score > 1 or (predicted = 1) <> (score >= 0.3)").count() == 0
    met = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    good = [r.predicted for r in met if r.quality == 1]
    bad = [r.predicted for r in met if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.15


def test_op9_edge_rows(spark, docs_of):
    docs = docs_of([(1, None, None, "s", 1), (2, "", "en", None, None), (None, "a b", "en", "s", 1), (2, "", "en", None, None)])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    weights = Q.fit_quality(docs, labels, ~Q.held_out())
    assert [r.score for r in Q.score_quality(docs, weights).collect()] == [0.5] * 4
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (None, 0, 0), (4, 1, 1)], labels.schema)
    assert Q.score_quality(docs, Q.fit_quality(docs, labels, ~Q.held_out())).count() == 4
    assert Q.drop_low_quality(docs, labels).columns == docs.columns
    assert Q.score_quality(docs_of([]), weights).count() == 0


def test_hash_array_finds_every_key():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        held = G.HashArray(keys, np.arange(len(keys), dtype=float)[:, None])
        at = held.find(keys)
        assert np.array_equal(held.values[at, 0], np.arange(len(keys)))
        assert (held.find(rng.integers(1 << 62, 1 << 63, 500).astype(np.uint64)) == -1).all()


def test_grams_by_hand():
    text, key = G.grams(["Ab, c!", "", "12", "é"], 3)
    letters = [tuple((int(k) >> 16 * j) & 0xFFFF for j in (2, 1, 0)) for k in key]
    a, b, c, e = map(ord, "abcé")
    assert text.tolist() == [0, 0, 0, 0, 0, 3, 3]
    assert letters == [(0, 0, a), (0, a, b), (a, b, 0), (b, 0, c), (0, c, 0), (0, 0, e), (0, e, 0)]


def test_probabilities_sum_to_one():
    """Over all signs seen in training, after any context, for each language."""
    rng = random.Random(3)
    counts = {}
    for lang, letters in (("x", "abc "), ("y", "bcd ")):
        _, key = G.grams(["".join(rng.choices(letters, k=300))], 3)
        counts[lang] = np.unique(key, return_counts=True)
    m = G.Models(counts, 3)
    signs = [0, *map(ord, "abcd")]
    for context in ((0, 0), (0, ord("a")), (ord("b"), ord("c")), (ord("d"), ord("a")), (ord("z"), ord("b"))):
        keys = np.array([context[0] << 32 | context[1] << 16 | s for s in signs], np.uint64)
        assert np.all(np.exp(m.log_probs(keys)).sum(0) <= 1.0001)
        assert np.all(np.exp(m.log_probs(keys)).sum(0) > 0.8)


def test_op1_held_out_accuracy_and_edges(spark, docs_of):
    got = G.op1_langid(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == docs.count() and got.filter("score < 0 or score > 1 or lang_pred is null").count() == 0
    met = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in met) / len(met) > 0.98
    rows = [(1, None, "en", "s", 1), (2, "123 !", "en", None, None), (3, "The thing", None, "s", 1), (None, "", None, "s", 1)]
    models = G.fit_languages(docs.filter(~G.held_out()).limit(300))
    out = sorted(((r.doc_id or 0, r.lang_pred, r.score) for r in G.identify(docs_of(rows), models).collect()))
    assert out[:3] == [(0, "und", 0.0), (1, "und", 0.0), (2, "und", 0.0)] and out[3][1] in models.langs
    none = G.fit_languages(docs_of(rows[3:]).select("doc_id", "lang", "text"))
    assert none.langs == [] and {r.lang_pred for r in G.identify(docs_of(rows), none).collect()} == {"und"}
    assert G.identify(docs_of([]), models).count() == 0
