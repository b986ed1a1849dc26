import inspect

from revlens.operators import embed as EM
from revlens.plans import q_embed, q_learn

SF = "/root/testdata/sf0.001"


def test_registered_queries_take_two_thousand_centroids():
    for q in (q_embed.kmeans_centroids_q, q_learn.fused_boosted_trees_q):
        assert inspect.signature(q).parameters["k"].default == 2000


def test_as_many_centroids_as_vectors_if_fewer(spark, monkeypatch):
    fitted, plain = [], EM.kmeans_centroids

    def kept(vectors, k, **more):
        fitted.append((vectors.count(), plain(vectors, k, **more)))
        return fitted[-1][1]

    monkeypatch.setattr(EM, "kmeans_centroids", kept)
    rows = q_embed.kmeans_centroids_q(spark, SF).collect()
    (n, model), = fitted
    assert len(rows) == n and model.getK() == min(2000, n) > 10
    assert all(r.nearest and r.cheaper_than_one for r in rows)
    assert plain(q_embed.word_vectors(spark, SF), 7, n_init=1).getK() == 7
