"""Right results and bounds that hold: one id on very many rows, skewed lengths, long words, rare letters."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import decontaminate as C
from revlens.llm import langid as G
from revlens.llm import near_dedup as N
from revlens.llm import quality as Q
from revlens.llm import token_shards as T
from revlens.llm import warc_bundles as B
from revlens.llm.common import shared_uri


def thue_morse(n, a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_long_words_that_collide_in_any_polynomial(spark, docs_of):
    w, v = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    rows = [(1, f"{w} x y z"), (2, f"{v} x y z"), (3, f"{w} x y z"), (4, f"{thue_morse(64, 'a', 'b')} x y z"),
            (5, f"{thue_morse(64, 'b', 'a')} x y z")]
    got = {r.doc_id: r.component_id for r in N.near_groups(docs_of([(*r, None, "s", 1) for r in rows])).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_word_hashes_are_those_of_the_bytes():
    rng = random.Random(3)
    many = ["".join(rng.choices("ab\x00é", k=rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 31, 256, 257, 900]))).encode() for _ in range(2000)]
    raw = b" ".join(many)
    end = np.cumsum([len(w) + 1 for w in many]) - 1
    begin = end - np.array([len(w) for w in many])
    got = N.word_hashes(raw, begin, end).tolist()
    by = dict(zip(many, got, strict=True))
    assert [by[w] for w in many] == got and len(set(by.values())) == len(by)


def test_letters_of_all_planes_are_letters():
    for c in (0x41, 0x4E00, 0xF900, 0x20000, 0x2FA1D, 0x30000, 0x323AF):
        assert chr(c).isalpha() and G._symbols()[c] != 0
    assert G._symbols()[0x31] == 0 and G._symbols()[0x10FFFF] == 0


def test_a_text_of_rare_letters_has_a_language(spark, docs_of):
    rows = [(i, "the cat and the dog " * 3, "en", "s", 1) for i in range(8)] + [(99, chr(0x30000) * 5, None, "s", 1), (98, "12 !", None, "s", 1)]
    docs = docs_of(rows)
    models = G.fit_languages(docs.select("doc_id", "lang", "text"))
    got = {r.doc_id: r.lang_pred for r in G.identify(docs.select("doc_id", "text"), models).collect()}
    assert got[99] == "en" and got[98] == "und"


def test_calibration_takes_a_row_an_id_and_some_of_every_language(spark, docs_of):
    rows = [(7, f"le chat {i}", "fr", "s", 1) for i in range(3000)] + [(i, f"the dog {i}", "en", "s", 1) for i in range(100, 2100)]
    got = {r.lang: r["count"] for r in G._sample(docs_of(rows).select("doc_id", "lang", "text"), 50).groupBy("lang").count().collect()}
    assert got == {"fr": 1, "en": 50}


def test_classifier_learns_from_a_bounded_number_of_rows(spark, docs_of, monkeypatch):
    docs = docs_of([(5, f"text {i}", "en", "s", 1) for i in range(3000)] + [(i, f"other {i}", "en", "s", 1) for i in range(10, 60)])
    labels = spark.createDataFrame([(i, i % 2) for i in [5, 5, *range(10, 60)]], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(Q, "train", lambda rows: seen.append(rows.count()))
    Q.fit_quality(docs, labels, F.lit(True))
    Q.fit_quality(docs, labels, F.lit(True), fit_rows=10)
    assert seen == [51, 10]


def test_scores_equal_the_plain_update(spark, docs_of):
    """The whole classifier against one that visits rows and features one by one."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(["good", "bad", "x1", "42", "!!", "Ünï"], k=rng.randint(0, 12))), "en", "s", 1) for i in range(60)]
    labels = spark.createDataFrame([(i, int("good" in t)) for i, t, *_ in rows], "doc_id bigint, quality int")
    weights = Q.fit_quality(docs_of(rows), labels, F.lit(True))
    order = [r.doc_id for r in docs_of(rows).select("doc_id", F.xxhash64("doc_id").alias("p")).orderBy("p", "doc_id").collect()]
    vec = {}
    for i, t, *_ in rows:
        _, at, x = Q.features([t])
        vec[i] = [*zip(at.tolist(), x.astype(np.float32).tolist(), strict=True), (1 << Q.BITS, 1.0)]
    z, n = {}, {}

    def weight(k):
        if k != 1 << Q.BITS and abs(z.get(k, 0.0)) <= Q.L1:
            return 0.0
        l1, l2 = (0.0, 0.0) if k == 1 << Q.BITS else (Q.L1, Q.L2)
        return (np.sign(z.get(k, 0.0)) * l1 - z.get(k, 0.0)) / ((Q.BETA + n.get(k, 0.0) ** 0.5) / Q.ALPHA + l2)

    for _ in range(Q.EPOCHS):
        for i in order:
            w = {k: weight(k) for k, _ in vec[i]}
            g0 = 1 / (1 + np.exp(-sum(w[k] * x for k, x in vec[i]))) - int("good" in rows[i][1])
            for k, x in vec[i]:
                g, old = g0 * x, n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - ((old + g * g) ** 0.5 - old ** 0.5) / Q.ALPHA * w[k]
                n[k] = old + g * g
    for k in n:
        assert weights[k] == pytest.approx(weight(k), abs=2e-4)


@pytest.mark.parametrize("rows", [[(1, "word " * 200)] * 600, [(None, f"null {i} " * 100) for i in range(600)],
                                  [(i, "x" if i < 500 else "long " * 2000) for i in range(600)]])
def test_shards_are_cut_by_bytes(spark, docs_of, rows):
    docs = docs_of([(*r, None, "s", 1) for r in rows])
    total = sum(len(t) for _, t in rows)
    folder = shared_uri(spark, "bounds")
    one = (1 << 20) + max(len(t) for _, t in rows)
    made = T.shard_table(docs, folder, shard_bytes=total // 20)
    docs_in = [r.docs for r in made.collect()]
    assert len(docs_in) >= 10 and sum(docs_in) == 600 and one
    got = T.read_shards(spark, folder, made)
    starts = sorted((r.start, r.n_tokens) for r in got.collect())
    assert len(starts) == 600 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))


def test_shard_files_hold_their_rank_directory(spark, docs_of):
    values = np.random.default_rng(1).integers(0, 40, 3000).astype(np.uint16)
    shard = T.Shard(np.arange(1), np.zeros(1, bool), np.array([3000]), T.WaveletMatrix.build(values, 7))
    back = T.Shard.from_bytes(shard.to_bytes())
    assert back.tokens._ranks is not None and all(map(np.array_equal, back.tokens._ranks, shard.tokens.ranks))
    assert back.tokens.count(3) == (values == 3).sum() and back.tokens.access(1234) == values[1234]


def test_archives_are_read_back_by_several_tasks(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"u{i}", f"{i} " * 400) for i in range(400)], "page_id bigint, url string, html string")
    folder = shared_uri(spark, "bounds-warc")
    bundles = B.write_bundles(pages, folder, bundle_bytes=20_000)
    monkeypatch.setattr(B, "READ_BYTES", 4_000)
    read = B.read_bundles(bundles, folder)
    tasks = read.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks >= 4 and read.count() == 400


@pytest.mark.parametrize("block_bytes", [C.BLOCK_BYTES, 300])
def test_blocks_of_the_benchmark_pass_in_one_step(spark, docs_of, block_bytes):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([3, 10, 12, 25])))) for k in range(40)] + [(None, "only null item"), (7, None)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    texts = [" ".join(rng.choices(words, k=20)) + " " + rng.choice(items[:40])[1] for _ in range(60)] + ["Only NULL item", "", None]
    docs = docs_of([(i, t, None, "s", 1) for i, t in enumerate(texts)] + [(0, texts[0], None, "s", 1)]).withColumn("hit_words", F.lit("clash"))
    found = C.find_contamination(docs, bench, block_bytes=block_bytes)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2  # the scan and the offsets, whatever the blocks
    want = {}
    for i, t in enumerate(texts):
        w, hit, own = C.words(t or ""), set(), []
        for k, text in items:
            some = [win for win in C.windows(text or "", C.WINDOW) for a in range(len(w)) if tuple(w[a:a + len(win)]) == win]
            for win in set(some):
                hit |= {a + j for a in range(len(w)) if tuple(w[a:a + len(win)]) == win for j in range(len(win))}
            if some:
                own.append("null" if k is None else str(k))
        want[i] = (len(w), len(hit), sorted(own))
    for r in found.collect():
        assert (r.n_words, sum(h.end - h.start for h in r.hit_words), list(r.hit_items)) == want[r.doc_id]
    assert C.find_contamination(docs.limit(0), bench).count() == 0
