"""Feature and ensemble laws on the small fixtures of FIXTURES.md section 4."""

import math

from pyspark.sql import functions as F

from revlens.functions.ngrams import char_wb_ngrams, treebank_word_split, word_ngrams
from revlens.operators import ensemble as G
from revlens.operators import features as FT


def test_word_ngrams_guards(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, []), (3, ["x"]), (4, ["a", "a"])],
                               "id int, words array<string>")
    got = {r.id: r.g for r in df.select("id", word_ngrams(F.col("words"), 1, 3).alias("g")).collect()}
    assert got[1] == ["a", "b", "c", "a b", "b c", "a b c"]
    assert got[2] == []
    assert got[3] == ["x"]
    assert got[4] == ["a", "a", "a a"]


def _char_wb_python(words, lo, hi):
    out = []
    for w in words:
        w = " " + w + " "
        for n in range(lo, hi + 1):
            offset = 0
            out.append(w[offset:offset + n])
            while offset + n < len(w):
                offset += 1
                out.append(w[offset:offset + n])
            if offset == 0:
                break
    return out


def test_char_wb_matches_rule(spark):
    words = ["a", "ab", "abc", "abcd", "abcdefgh"]
    df = spark.createDataFrame([(1, words)], "id int, words array<string>")
    got = df.select(char_wb_ngrams(F.col("words"), 3, 6).alias("g")).first().g
    assert sorted(got) == sorted(_char_wb_python(words, 3, 6))


def test_treebank_split(spark):
    df = spark.createDataFrame([(["gonna", "cannot", "go"],)], "w array<string>")
    assert df.select(treebank_word_split(F.col("w")).alias("t")).first().t == ["gon", "na", "can", "not", "go"]


def test_tfidf_rows_have_unit_norm_and_empty_doc_survives(spark):
    docs = spark.createDataFrame([(1, ["good", "movie", "good"]), (2, ["bad", "movie"]), (3, [])],
                                 "id long, words array<string>")
    vocab, feat = FT.fit_tfidf(docs, 3, 1, 2, None)
    norms = feat.groupBy("id").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("n")).collect()
    assert all(abs(r.n - 1.0) < 1e-12 for r in norms)
    v = {r.term: r for r in vocab.collect()}
    assert abs(v["movie"].idf - (math.log(4 / 3) + 1)) < 1e-12      # smooth idf counts the empty doc
    assert sorted(v) == sorted(["good", "movie", "bad", "good movie", "bad movie", "movie good"])
    assert [r.idx for r in sorted(v.values(), key=lambda r: r.term)] == list(range(6))


def test_vocabulary_top_k_ties_by_term(spark):
    tf = spark.createDataFrame([(1, "b", 1), (1, "a", 1), (2, "c", 2)], "id long, term string, tf long")
    v = FT.vocabulary(tf, 2, 2).orderBy("idx").collect()
    assert [r.term for r in v] == ["a", "c"]   # c has cf 2; a wins the tie with b


def _pred(spark):
    rows = [(1, "m1", 0.9), (1, "m2", 0.6), (1, "m3", 0.7),
            (2, "m1", 0.1), (2, "m2", 0.0), (2, "m3", 0.4),
            (3, "m1", 0.5), (3, "m2", 0.5), (3, "m3", 1.0)]
    return spark.createDataFrame(rows, "id long, model string, p double"), rows


def test_ensemble_laws(spark):
    df, rows = _pred(spark)
    e = {r.id: r for r in G.combiners(df).collect()}
    for i, r in e.items():
        ps = [p for j, _, p in rows if j == i]
        assert min(ps) - 1e-12 <= r.ens_geometric <= r.ens_mean + 1e-12 <= r.ens_power + 2e-12 <= max(ps) + 3e-12
        assert r.ens_tjflexic in (min(ps), max(ps))
        assert abs(r.ens_median - sorted(ps)[1]) < 1e-12
    assert e[2].ens_geometric == 0.0                 # a zero makes the product zero
    assert e[3].ens_tjflexic == 1.0                  # mean 0.666 > 0.5 -> max


def test_weights_by_name_and_missing_model(spark):
    df, rows = _pred(spark)
    w = G.weights_table(spark, {"m1": 2.0, "m3": 1.0, "absent": 5.0})
    e = {r.id: r.ens_weighted for r in G.combiners(df, w).collect()}
    assert abs(e[1] - (2 * 0.9 + 0.7) / 3) < 1e-12


def test_rank_average_invariant_to_monotone_maps(spark):
    df, _ = _pred(spark)
    a = {r.id: r.ens_rank for r in G.rank_average(df).collect()}
    b = {r.id: r.ens_rank for r in G.rank_average(df.withColumn("p", F.col("p") ** 3)).collect()}
    assert a == b


def test_vocabulary_top_k_equals_a_plain_sort(spark):
    rows = [(i % 17, f"t{(i * 7) % 53}", 1 + (i % 3)) for i in range(400)]
    tf = (spark.createDataFrame(rows, "id long, term string, tf long")
          .groupBy("id", "term").agg(F.sum("tf").alias("tf")))
    cf = {}
    for _, t, n in rows:
        cf[t] = cf.get(t, 0) + n
    top = sorted(sorted(cf, key=lambda t: (-cf[t], t))[:20])
    got = sorted((r.idx, r.term, r.cf) for r in FT.vocabulary(tf, 17, 20).collect())
    assert got == [(i, t, cf[t]) for i, t in enumerate(top)]


def test_vocabulary_index_is_wide_without_a_bound(spark):
    tf = spark.createDataFrame([(1, "b", 1), (1, "a", 1)], "id long, term string, tf long")
    assert dict(FT.vocabulary(tf, 2).dtypes)["idx"] == "bigint"


def test_word_table_lookups_are_the_same_salted_or_broadcast(spark, monkeypatch):
    from revlens.operators import embed as EM
    rows = [(i, ["the"] * (i % 4) + [f"w{i % 7}", "zz"]) for i in range(60)] + [(99, [])]
    tokens = spark.createDataFrame(rows, "id long, words array<string>")
    vectors = spark.createDataFrame([("the", [1.0, 0.0])] + [(f"w{k}", [float(k), 2.0]) for k in range(7)],
                                    "word string, vector array<double>")
    both = []
    for limit in (1 << 30, 0):
        monkeypatch.setattr(EM, "BROADCAST_BYTES", limit)
        both.append(sorted((r.id, r.n_known, tuple(round(x, 9) for x in r.vector))
                           for r in EM.mean_word_vector(tokens, vectors, 2).collect()))
    assert both[0] == both[1]
    assert both[0][3] == (3, 4, ((3 * 1.0 + 3.0) / 4, 0.5)) and both[0][-1] == (99, 0, (0.0, 0.0))


def test_nearest_centroid_ties_and_plan(spark):
    from revlens.operators import embed as EM
    vectors = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [1.0, 0.9])], "word string, vector array<double>")
    sizes = []
    for k in (2, 40):
        centers = spark.createDataFrame([(i, [float(i), 0.0 if i % 2 == 0 else 1.0]) for i in range(k)] + [(k, [0.0, 0.0])],
                                        "centroid int, center array<double>")
        out = EM.nearest_centroid(vectors, centers)
        assert {r.word: r.centroid for r in out.collect()} == {"a": 0, "b": 1}
        sizes.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
    assert sizes[1] < 2 * sizes[0]
