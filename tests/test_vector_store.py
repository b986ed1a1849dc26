from revlens.session import scratch_path
from revlens.sources import vector_store as V


def rows_of(spark, n):
    return spark.createDataFrame([(f"w{i}", [float(i), -1.0]) for i in range(n)], "word string, vector array<double>")


def test_lookup_reads_the_buckets_of_its_words_only(spark):
    path = V.store_vectors(rows_of(spark, 4000), scratch_path(spark, "vectors"), bucket_words=100)
    got = V.lookup_vectors(spark, path, ["w7", "w3999", "missing", "w7"])
    assert {r.word: r.vector for r in got.collect()} == {"w7": [7.0, -1.0], "w3999": [3999.0, -1.0]}
    every, read = len(V.load_vectors(spark, path).inputFiles()), got._jdf.queryExecution().executedPlan().toString()
    assert every >= 32 and "PartitionFilters" in read and "bucket" in read.split("PartitionFilters")[1]
    files = got.selectExpr("input_file_name() as f").distinct().count()
    assert files <= 2


def test_whole_store_comes_back(spark):
    path = V.store_vectors(rows_of(spark, 50), scratch_path(spark, "vectors"))
    assert sorted(tuple(r) for r in V.load_vectors(spark, path).collect()) == sorted((f"w{i}", [float(i), -1.0]) for i in range(50))


def test_no_words_and_an_empty_store(spark):
    path = V.store_vectors(rows_of(spark, 5), scratch_path(spark, "vectors"))
    assert V.lookup_vectors(spark, path, []).count() == 0
    assert V.lookup_vectors(spark, path, ["zz"]).count() == 0
