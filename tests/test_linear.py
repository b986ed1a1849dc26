import random

import numpy as np
import pytest

from revlens.operators import linear as N


def data(spark, seed=1, n=200, width=12):
    rng = random.Random(seed)
    rows = [{f: rng.uniform(-1, 2) for f in range(width) if rng.random() < 0.4} for _ in range(n)]
    labels = [int(r.get(0, 0) - r.get(1, 0) + 0.5 * r.get(2, 0) + rng.gauss(0, 0.6) > 0.2) for r in rows]
    folds = [i % 3 for i in range(n)]
    feat = spark.createDataFrame([(i, f, v) for i, r in enumerate(rows) for f, v in r.items()], "id bigint, idx int, value double").repartition(4)
    docs = spark.createDataFrame([(i, y, f) for i, (y, f) in enumerate(zip(labels, folds))], "id bigint, label int, fold int").repartition(3)
    x = np.zeros((n, width + 1))
    for i, r in enumerate(rows):
        x[i, [*r]] = [*r.values()]
    x[:, -1] = 1.0
    return feat, docs, x, np.array(labels, float), np.array(folds)


def gradient(spec, x, y, folds, w):
    use = np.where(y > 0.5, spec.pos, spec.neg) * (folds != spec.fold if spec.fold >= 0 else 1.0)
    s, sign = x @ w, 2 * y - 1
    slope = -sign / (1 + np.exp(sign * s)) if spec.loss == "logistic" else -2 * sign * np.maximum(1 - sign * s, 0)
    own = w.copy()
    if spec.loss == "logistic":
        own[-1] = 0
    return own + spec.C * x.T @ (use * slope)


def test_many_models_of_folds_and_c_are_each_at_their_optimum(spark):
    feat, docs, x, y, folds = data(spark)
    blocks = N.packed([(feat, docs)], block_rows=31)
    specs = [N.Spec(f"c{c}_f{f}", c, 0, f) for c in (0.1, 1.0, 10.0) for f in (-1, 0, 1, 2)] + [N.Spec("balanced", 1.0, pos=0.7, neg=1.9)]
    models = N.fit_many(blocks, specs, [12], tol=1e-7)
    for m in models:
        w = np.append(m.w, m.b)
        zero = np.abs(gradient(m.spec, x, y, folds, np.zeros(13))).max()
        assert np.abs(gradient(m.spec, x, y, folds, w)).max() <= 1e-6 * zero and m.slope <= 1e-6


def test_same_as_a_single_fit_of_the_library(spark):
    from revlens.operators.learn import logistic_regression, vectors_for
    feat, docs, x, y, _ = data(spark, 2)
    one = logistic_regression(5.0, len(y), 200, tol=1e-12).fit(vectors_for(feat, 12, docs))
    got, = N.fit_many(N.packed([(feat, docs)]), [N.Spec("one", 5.0)], [12], tol=1e-8)
    assert got.w == pytest.approx(one.coefficients.toArray(), abs=1e-4) and got.b == pytest.approx(one.intercept, abs=1e-4)


def test_squared_hinge_by_newton_closes_the_dual_gap(spark):
    feat, docs, x, y, folds = data(spark, 3)
    specs = [N.Spec(f"svc{f}", 0.5, 0, f, loss="squared_hinge") for f in (-1, 0, 1)]
    for m in N.fit_many(N.packed([(feat, docs)], block_rows=40), specs, [12], tol=1e-8):
        w = np.append(m.w, m.b)
        assert np.abs(gradient(m.spec, x, y, folds, w)).max() < 1e-5
        assert 0 <= m.gap + 1e-12 and m.gap < 1e-6


def test_tables_of_other_features_share_the_passes(spark):
    feat, docs, x, y, _ = data(spark, 4)
    less = feat.filter("idx < 5")
    both = N.fit_many(N.packed([(feat, docs), (less, docs)]), [N.Spec("all", 1.0), N.Spec("few", 1.0, 1)], [12, 5], tol=1e-7)
    alone, = N.fit_many(N.packed([(less, docs)]), [N.Spec("few", 1.0)], [5], tol=1e-7)
    assert len(both[0].w) == 12 and both[1].w == pytest.approx(alone.w, abs=1e-5)


def test_scores_of_rows_held_out_and_rows_without_features(spark):
    feat, docs, x, y, folds = data(spark, 5, 90)
    blocks = N.packed([(feat.filter("id <> 7"), docs)])
    models = N.fit_many(blocks, [N.Spec("a", 1.0, fold=f) for f in range(3)], [12])
    got = N.score_many(blocks, models, held_out=True).collect()
    assert sorted(r.id for r in got) == list(range(90)) and all(r.fold == folds[r.id] and r.label == y[r.id] for r in got)
    seven = next(r for r in got if r.id == 7)
    assert seven.score == pytest.approx(models[folds[7]].b)


def test_a_pass_reads_only_the_tables_that_are_asked(spark):
    feat, docs, *_ = data(spark, 6, 60)
    blocks = N.packed([(feat, docs), (feat, docs)])
    broken = blocks.withColumn("value", N.F.when(blocks.feats == 1, N.F.raise_error(N.F.lit("read"))).otherwise(blocks.value))
    one, = N.fit_many(broken, [N.Spec("one", 1.0)], [12, 12], steps=3)
    assert len(one.w) == 12
