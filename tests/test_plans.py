"""Plan-shape guards on headline queries: pruned scans, no pair-producing joins."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
KEYS = ["tfidf", "char_tfidf", "nb_log_ratio", "mean_word_vector", "word_to_centroid", "stratified_kfold",
        "roc_auc", "ens_rank_average", "clean_minstop_url", "word_frequency"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_and_pruned_scans(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # the review table is only ever read for its id and text
    for line in plan.splitlines():
        if "documents.parquet" in line and "FileScan" in line:
            assert "lang" not in line and "n_chars" not in line and "source" not in line.split("[")[1].split("]")[0]


def test_flagship_vocabulary_is_broadcast(spark):
    plan = _plan(E.queries()["tfidf"](spark, SF))
    assert "BroadcastHashJoin" in plan
