"""Trained sentence boundaries on hand-made texts."""

import math

from pyspark.sql import functions as F

from revlens.operators import boundaries as B

NAMES = ["Smith", "Jones", "Brown", "Clark", "Lewis"]
VERBS = ["left", "came", "slept", "wrote", "called"]


def corpus():
    rows = []
    for i in range(200):
        name, verb = NAMES[i % 5], VERBS[(i // 5) % 5]
        rows.append(f"Yesterday Dr. {name} {verb} early. The house was quiet. They {verb} the town and the house again.")
        rows.append(f"We {verb} at the town. Nobody {verb} with Dr. {name}! The town {verb} us, e.g. the house.")
        rows.append(f"It was early and quiet again when they {verb}.")  # ends of sentences stand elsewhere too
    return rows


def sentences(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    out = {}
    for r in B.trained_sentences(df, "id").orderBy("review_id", "sent_no").collect():
        out.setdefault(int(r.review_id), []).append((r.sent_no, " ".join(r.words)))
    return out


def test_abbreviations_are_found_and_joined(spark):
    texts = corpus()
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.typ: r for r in B.abbreviations(B.context_counts(df)).collect()}
    assert "dr" in found and "e.g" in found
    assert not {"early", "quiet", "again", "town", "house"} & set(found)
    assert found["dr"].with_period == found["dr"].n == 400
    got = sentences(spark, texts)
    assert [s for _, s in got[0]] == ["yesterday dr smith left early", "the house was quiet",
                                      "they left the town and the house again"]
    assert [s for _, s in got[1]] == ["we left at the town", "nobody left with dr smith", "the town left us e g the house"]
    assert [n for n, _ in got[1]] == [0, 1, 2]


def test_a_capital_after_an_abbreviation_needs_evidence(spark):
    """'The' is small elsewhere and never capital inside a sentence, so it begins one even after an abbreviation."""
    texts = corpus() + ["Nobody called the Dr. The town slept."]
    assert [s for _, s in sentences(spark, texts)[len(texts) - 1]] == ["nobody called the dr", "the town slept"]


def test_odd_rows(spark):
    texts = [None, "", "...", "no end", "One. Two.\nthree", "One. Two.\nthree", "a" * 50000 + ". B"]
    got = sentences(spark, texts)
    assert set(got) == {3, 4, 5, 6}
    assert got[4] == got[5] == [(0, "one"), (1, "two"), (2, "three")]
    empty = spark.createDataFrame([], "id long, text string")
    assert B.trained_sentences(empty, "id").count() == 0
    assert B.abbreviations(B.context_counts(empty)).count() == 0
    same_id = spark.createDataFrame([(1, "Aa bb. Cc dd."), (1, "Ee ff."), (None, "Gg hh.")], "id long, text string")
    assert sorted((r.review_id or "", r.sent_no, " ".join(r.words)) for r in B.trained_sentences(same_id, "id").collect()) == [
        ("", 0, "gg hh"), ("1", 0, "aa bb"), ("1", 0, "ee ff"), ("1", 1, "cc dd")]


def test_log_likelihood_against_the_binomial_form(spark):
    def binomial(a, b, ab, n):
        def ll(k, m, p):
            return (k * math.log(p) if k else 0) + ((m - k) * math.log(1 - p) if m > k else 0)
        p, p1, p2 = b / n, ab / a, (b - ab) / (n - a)
        return -2 * (ll(ab, a, p) + ll(b - ab, n - a, p) - ll(ab, a, p1) - ll(b - ab, n - a, p2))
    cases = [(10, 20, 5, 1000), (3, 3, 3, 50), (40, 7, 0, 90), (5, 100, 5, 400)]
    df = spark.createDataFrame(cases, "a long, b long, ab long, n long")
    for r in df.withColumn("x", B.log_likelihood(*(F.col(c) for c in ("a", "b", "ab", "n")))).collect():
        assert abs(r.x - binomial(r.a, r.b, r.ab, r.n)) < 1e-8
