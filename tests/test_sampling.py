"""Sub-sampling of frequent words."""

import math

from revlens.operators import corpus as C
from revlens.operators import embed as EM
from revlens.operators.sampling import keep_probabilities, thin


def sentences(spark):
    rows = [(i, ["the", f"w{i % 700}", "the", "of", f"v{i % 900}"]) for i in range(4000)]
    return spark.createDataFrame([*rows, (None, ["the"]), (9001, []), (9002, None)], "id long, words array<string>")


def test_probabilities_follow_the_formula(spark):
    s = sentences(spark)
    keep = keep_probabilities(C.word_frequency(s), 1e-2)
    total = 4000 * 5 + 1
    assert set(keep) == {"the", "of"}  # the bound: no other word has a share above 2.618 times the sample
    for word, n in (("the", 8001), ("of", 4000)):
        f = n / total
        assert abs(keep[word] - (math.sqrt(1e-2 / f) + 1e-2 / f)) < 1e-12
    assert keep_probabilities(C.word_frequency(s), 1e-2, at_least=4000) == {"the": 4000 / 8001, "of": 1.0}
    assert keep_probabilities(C.word_frequency(s.limit(0))) == {}


def test_rare_words_stay_and_draws_repeat(spark):
    s = sentences(spark)
    keep = keep_probabilities(C.word_frequency(s), 1e-2)
    out = thin(s, keep, ["id"])
    n = {r.word: r.n for r in C.word_frequency(out).collect()}
    before = {r.word: r.n for r in C.word_frequency(s).collect()}
    assert {w: c for w, c in n.items() if w not in keep} == {w: c for w, c in before.items() if w not in keep}
    for w, p in keep.items():  # five standard deviations
        assert abs(n[w] - before[w] * p) < 5 * math.sqrt(before[w] * p * (1 - p))
    again = {r.id: r.words for r in thin(s.repartition(7), keep, ["id"]).collect()}
    assert again == {r.id: r.words for r in out.collect()}
    assert again[9001] == [] and again[9002] is None and set(again) == {*range(4000), None, 9001, 9002}
    assert thin(s, {}, ["id"]) is s


def test_planted_pairs_rank_first_in_a_thinned_corpus(spark):
    """Words of one theme stand together, frequent filler stands between them; fillers alone are thinned."""
    themes = [["cat", "dog", "hen", "cow"], ["red", "blue", "pink", "grey"], ["oak", "elm", "ash", "fir"]]
    rows = []
    for i in range(1500):
        t = themes[i % 3]
        rows.append((i, ["the", t[i % 4], "the", t[(i // 3) % 4], "the", t[(i // 7) % 4], "the", t[(i // 11) % 4]]))
    s = spark.createDataFrame(rows, "id long, words array<string>")
    model = EM.train_word2vec(s, vector_size=16, min_count=5, window=4, max_iter=8, num_partitions=1, sample=2e-2, keys=("id",))
    v = EM.model_vectors(model)
    assert v.count() == 13  # thinning takes no word out of the vocabulary
    for word, own in (("cat", themes[0]), ("red", themes[1]), ("oak", themes[2])):
        assert {r.word for r in EM.most_similar(v, word, 3).collect()} == set(own) - {word}
