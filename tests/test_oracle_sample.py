"""A sample of the Spark-vs-DuckDB gate at sf0.001 (the full sweep is tools/check_oracles.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracles import TABLES, digest

SF = "/root/testdata/sf0.001"
KEYS = ["clean_minstop_url", "clean_letters_pages", "tfidf", "char_wb_ngrams", "top_words",
        "stratified_kfold", "roc_auc", "ens_tjflexic", "mean_word_vector", "read_review_tsv"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_spark_equals_duckdb(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns) == digest(drows, dcols)
