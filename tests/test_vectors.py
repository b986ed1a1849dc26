"""Long features -> MLlib sparse vectors through the parquet struct (no Python UDF)."""

from revlens.operators.vectors import assemble_sparse


def test_sparse_vectors_sorted_and_empty_rows_kept(spark):
    feat = spark.createDataFrame([(1, 3, 0.5), (1, 0, 1.0), (2, 4, 2.0)], "id long, idx int, value double")
    docs = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "id long, label int")
    v = {r.id: r for r in assemble_sparse(feat, 5, docs, "id", ("label",)).collect()}
    assert v[1].features.size == 5
    assert list(v[1].features.indices) == [0, 3] and list(v[1].features.values) == [1.0, 0.5]
    assert v[3].features.numNonzeros() == 0 and v[3].label == 0
