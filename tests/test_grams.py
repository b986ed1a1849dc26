"""N-grams counted in Arrow batches are those of a plain count."""
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from revlens.operators import features as FT
from revlens.operators import grams as GR


def _rows(n=50):
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(30)] + ["X", "ÄB", None]
    rows = [(i if i % 13 else None, i % 2, [rnd.choice(words) for _ in range(rnd.randrange(0, 25))]) for i in range(n)]
    return [*rows, *rows[:9], (3, 1, None), (n + 1, 0, [])]


def _grams(w, lo, hi):
    w = [x.lower() for x in w or [] if x is not None and len(x) > 1]
    return [" ".join(w[k:k + n]) for n in range(lo, hi + 1) for k in range(len(w) - n + 1)]


def _plan(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString()  # one that has not run


def _docs(spark, rows):
    return spark.createDataFrame(rows, "id long, label int, words array<string>").repartition(3, "id")


def test_words_are_looked_up_without_a_row_for_each_gram(spark):
    rows = _rows()
    want = Counter((i, y, g) for i, y, w in rows for g in _grams(w, 1, 3))
    terms = sorted({g for _, _, g in want})[::3] + ["w1 none", "none"]
    vocab = spark.createDataFrame([(t, k) for k, t in enumerate(terms)], "term string, idx int")
    got = FT.known_counts(_docs(spark, rows), vocab, 1, 3, len(terms), keep_cols=("label",))
    assert {(r.id, r.label, terms[r.idx]): r.tf for r in got.collect()} == {k: n for k, n in want.items() if k[2] in set(terms)}
    assert got.count() == len({k for k in want if k[2] in set(terms)})
    assert _plan(got).rindex("MapInArrow") > _plan(got).rindex("Generate")  # explodes what is known only
    one = got.groupBy("id").count()
    assert _plan(one).count("Exchange") == _plan(got).count("Exchange")  # partitioned on the id still
    two = FT.known_counts(_docs(spark, rows), vocab, 2, 2, len(terms))
    assert {terms[r.idx] for r in two.collect()} == {t for t in terms if len(t.split()) == 2 and "none" not in t}


@pytest.mark.parametrize("floor", [1, 3, 6])
def test_counts_of_marked_grams_are_whole(spark, floor):
    rows = _rows()
    cf = Counter(g for _, _, w in rows for g in _grams(w, 1, 3))
    ids = Counter(g for _, g in {(i, g) for i, _, w in rows for g in _grams(w, 1, 3)})
    docs = _docs(spark, rows)
    for lo in (1, 2):
        buckets = GR.bucket_counts(GR.word_lists(docs), lo, 3, 1 << 14)
        assert buckets.agg(F.sum("n")).first()[0] == sum(n for g, n in cf.items() if len(g.split()) >= lo)
        marks = GR.bucket_marks(buckets.filter(F.col("n") >= floor), 1 << 14)
        got = {r.term: (r.df, r.cf) for r in GR.gram_counts(GR.word_lists(docs, ("id",)), lo, 3, True, marks).collect()}
        assert all(got[g] == (ids[g], cf[g]) for g in got) and {g for g, n in cf.items() if n >= floor and len(g.split()) >= lo} <= set(got)
        plain = {r.term: r.cf for r in GR.gram_counts(GR.word_lists(docs), lo, 3, False).collect()}
        assert plain == {g: n for g, n in cf.items() if len(g.split()) >= lo}
    once = GR.bucket_counts(GR.word_lists(docs), 1, 3, 1 << 14, True).agg(F.sum("n")).first()[0]
    assert sum(ids.values()) <= once <= sum(cf.values())


def test_a_batch_is_cut_between_reviews(monkeypatch):
    monkeypatch.setattr(GR, "TOKENS", 7)
    lists = [[["aa", "bb", "aa"]], [["bb"], ["cc", "aa"]], [], [["aa"] * 9], [None, ["bb"]], None, [["cc"]]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(lists, pa.list_(pa.list_(pa.string())))], ["id", "w"])
    known, parts = GR.Known(["aa", "aa aa", "bb aa", "cc"], np.arange(4), 1, 2), list(GR._slices(batch))
    assert len(parts) > 1 and [i for own, _ in parts for i in own.column("id").to_pylist()] == list(range(7))
    got = sorted((own.column("id")[r].as_py(), i, n) for own, x in parts for r, i, n in zip(*(v.tolist() for v in known.met(x)), strict=True))
    assert got == [(0, 0, 2), (0, 2, 1), (1, 0, 1), (1, 3, 1), (3, 0, 9), (3, 1, 8), (6, 3, 1)]


def test_a_word_with_a_space_is_an_error():
    with pytest.raises(ValueError, match="space"):
        GR._Words(pa.array([[["a b"]]], pa.list_(pa.list_(pa.string())))).parted()


def test_characters_of_words_are_counted_as_often_as_the_words(spark, monkeypatch):
    """The same vocabulary and counts as of one row for each character n-gram of each word."""
    rows = [(i, y, [x for x in w or [] if x is not None] + ["a", "aaaaaa", "I"] * ((i or 0) % 3)) for i, y, w in _rows()]
    docs = _docs(spark, rows)
    tf = FT.term_frequencies(docs, "id", "words", 3, 6, "char_wb", ("label",), partitioned=True)
    for wanted, low, high in ((40, 2, 1.0), (40, 1, 1.0), (25, 3, 0.4), (5000, 2, 0.9)):
        want = {(r.term, r.idx, r.df, r.cf) for r in FT.vocabulary(tf, len(rows), wanted, low, high).collect()}
        vocab, counts = FT.fit_counts(docs, len(rows), 3, 6, wanted, low, high, "char_wb", ("label",))
        assert {(r.term, r.idx, r.df, r.cf) for r in vocab.collect()} == want
        number = {t: k for t, k, _, _ in want}
        some = sorted((r.id or 0, r.label, number[r.term], r.tf) for r in tf.collect() if r.term in number)
        assert sorted((r.id or 0, r.label, r.idx, r.tf) for r in counts.join(vocab, "idx").collect()) == some
    plan = _plan(FT.known_counts(docs, vocab, 3, 6, 5000, "char_wb"))
    assert plan.rindex("MapInArrow") > plan.rindex("Generate")
    for w in ("", "a", "ab", "abcdefgh"):
        got = spark.range(1).select(GR.char_wb_ngrams(F.array(F.lit(w)), 3, 6)).first()[0]
        assert got == GR.char_grams(w, 3, 6)
