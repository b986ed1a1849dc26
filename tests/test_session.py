"""Shared-folder rule and release of intermediate tables."""

import os

import pytest

import __spark_entry__ as E
from revlens import session as S

SF = "/root/testdata/sf0.001"


def test_no_private_scratch_off_a_local_master():
    assert S._local_scratch("local[4]")
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            S._local_scratch(master)


@pytest.mark.parametrize("key", ["tfidf", "cross_validate", "mean_word_vector", "calibrated_linear_svc"])
def test_queries_leave_no_cached_table(spark, key):
    E.queries()[key](spark, SF).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_release_deletes_scratch(spark):
    kept = S.written(spark.range(3), "test")
    path = S.scratch_paths(spark)[-1].removeprefix("file:")
    assert kept.count() == 3 and os.path.isdir(path)
    S.release(spark)
    assert not os.path.exists(path) and S.scratch_paths(spark) == []
