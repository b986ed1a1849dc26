"""Terms counted in buckets first give the vocabularies of all terms."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.operators import features as FT


def _docs(spark, n=60, twice=False):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    rows = [(i, i % 2, rnd.choices(words, [1 / (k + 1) for k in range(40)], k=rnd.randrange(1, 30))) for i in range(n)]
    rows += rows[:7] if twice else []
    return rows, spark.createDataFrame(rows, "id long, label int, words array<string>").repartition(4, "id")


def _plain(rows, lo, hi):
    """Occurrences and reviews of every term."""
    cf, ids = Counter(), {}
    for i, _, w in rows:
        for n in range(lo, hi + 1):
            for k in range(len(w) - n + 1):
                term = " ".join(w[k:k + n])
                cf[term] += 1
                ids.setdefault(term, set()).add(i)
    return cf, {t: len(x) for t, x in ids.items()}


@pytest.mark.parametrize("buckets", [1 << 16, 64, 1])
@pytest.mark.parametrize("wanted", [5, 60, 100_000])
def test_first_terms_are_those_of_all_terms(spark, monkeypatch, buckets, wanted):
    monkeypatch.setattr(FT, "DIRECT_REVIEWS", 0)
    monkeypatch.setattr(FT, "BUCKETS", buckets)
    rows, docs = _docs(spark, twice=True)
    cf, df = _plain(rows, 1, 3)
    got = FT.document_vocabulary(docs, len(rows), 1, 3, wanted, 2, 0.5)
    window = [t for t in df if 2 <= df[t] <= 0.5 * len(rows)]
    want = sorted(window, key=lambda t: (-df[t], t))[:wanted]
    assert {(r.term, r.df, r.cf) for r in got.collect()} == {(t, df[t], cf[t]) for t in want}
    vocab, _ = FT.fit_counts(docs, len(rows), 1, 3, wanted, 1, 1.0)
    assert {(r.term, r.cf) for r in vocab.collect()} == {(t, cf[t]) for t in sorted(cf, key=lambda t: (-cf[t], t))[:wanted]}


def test_rare_terms_are_not_kept(spark, monkeypatch):
    monkeypatch.setattr(FT, "DIRECT_REVIEWS", 0)
    rows, docs = _docs(spark)
    cf, _ = _plain(rows, 1, 3)
    got = FT.Counted(docs, len(rows), 1, 3).first(20)
    assert got.count() < len(cf) / 4 and {r.cf for r in got.collect()} <= set(cf.values())


def test_ranges_of_a_lattice(spark, monkeypatch):
    rows, docs = _docs(spark)
    configs = {"a": (1, 1, 10), "b": (1, 3, 25), "c": (1, 2, 500)}
    plain = {k: sorted((r.id, r.idx, round(r.value, 9)) for r in v[0].collect()) for k, v in FT.gram_lattice(docs, None, len(rows), configs).items()}
    monkeypatch.setattr(FT, "DIRECT_REVIEWS", 0)
    got = {k: sorted((r.id, r.idx, round(r.value, 9)) for r in v[0].collect()) for k, v in FT.gram_lattice(docs, None, len(rows), configs).items()}
    assert got == plain


def test_counts_of_a_lattice_are_those_of_each_alone(spark, monkeypatch):
    """Counts by occurrences and by reviews come with the lattice, also where an id has two labels."""
    rows, _ = _docs(spark)
    rows += [(i, 1 - y, w + w[:1]) for i, y, w in rows[:5]] + rows[20:23]
    docs = spark.createDataFrame(rows, "id long, label int, words array<string>").repartition(4, "id")
    test, n, configs = docs.filter("id % 3 = 0").drop("label"), len(rows), {"a": (1, 3, 25), "b": (1, 2, 12)}

    def plain(df):
        return sorted(map(tuple, df.select("id", "idx", F.round("value", 9)).collect()))

    alone = {k: [plain(x) for x in v[:2]] for k, v in FT.gram_lattice(docs, test, n, configs).items()}
    for least in (2_000, 0):
        monkeypatch.setattr(FT, "DIRECT_REVIEWS", least)
        got = FT.gram_lattice(docs, test, n, configs, {"df": (1, 2, 30, "df"), "cf": (1, 2, 30, "cf")})
        assert {k: [plain(x) for x in got[k][:2]] for k in configs} == alone
        vocab, counts = FT.fit_counts(docs, n, 1, 2, 30, keep_cols=("label",))
        for name, v, tf in (("cf", vocab, counts), ("df", FT.document_vocabulary(docs, n, 1, 2, 30), None)):
            tf = tf or FT.known_counts(docs, v, 1, 2, 30, keep_cols=("label",))
            key = ("id", "label", "idx", "tf")
            assert sorted(map(tuple, got[name][0].collect())) == sorted(map(tuple, v.select("term", "idx").collect()))
            assert sorted(map(tuple, got[name][1].select(*key).collect())) == sorted(map(tuple, tf.select(*key).collect()))
            known = FT.known_counts(test, v, 1, 2, 30).select("id", "idx", "tf")
            assert sorted(map(tuple, got[name][2].select("id", "idx", "tf").collect())) == sorted(map(tuple, known.collect()))


def test_ensemble_of_groups_cuts_and_counts_a_cleaner_once(spark, monkeypatch, tmp_path):
    """The ensemble's NB members read the lattice's counts: one counting for each of the three cleaners."""
    from revlens.plans import q_learn as Q
    made, init = [], FT.Counted.__init__
    monkeypatch.setattr(FT.Counted, "__init__", lambda self, *a, **k: (made.append(a), init(self, *a, **k))[1])

    class Enough(Exception):
        pass

    def stop(*_):
        raise Enough
    monkeypatch.setattr(Q.N, "packed", stop)
    words = ["fine", "plot", "dull", "cast", "great", "story"]
    rows = [(i, " ".join(words[(i * k) % 6] for k in range(1, 9))) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    with pytest.raises(Enough):
        Q._group_members(spark, str(tmp_path))
    assert len(made) == 3
