"""Driver contract smoke checks and the streaming scorer against the batch scorer."""

import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from revlens.functions import profiles as P
from revlens.operators import features as FT
from revlens.sources import tables
from revlens.streaming.scoring import score_batch, start_scoring_stream

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "term", "weight"]
    assert df.count() > 0


def _model(spark):
    lab = tables.labeled(spark, SF).select(F.col("doc_id").alias("id"), "label",
                                           P.profile_tokens("len2", "text").alias("words"))
    tf = FT.term_frequencies(lab, "id", "words", 1, 2, keep_cols=("label",))
    vocab = FT.vocabulary(tf, lab.count(), 5000, binary=True)
    coef = FT.nb_log_ratio(FT.nb_class_sums(tf, vocab, 5000)).select("idx", F.col("r").alias("w"))
    return vocab, coef


def test_stream_equals_batch(spark):
    vocab, coef = _model(spark)
    tmp = tempfile.mkdtemp(prefix="revlens-stream-")
    src = os.path.join(tmp, "in")
    docs = tables.table(spark, SF, "documents")
    docs.repartition(3).write.parquet(src)
    q = start_scoring_stream(spark, src, os.path.join(tmp, "out"), os.path.join(tmp, "ckpt"), vocab, coef, 0.3,
                             "len2", 1, 2, 5000, available_now=True, max_files_per_trigger=1)
    q.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(tmp, "out")).select("doc_id", F.round("p", 9).alias("p"))
    batch = score_batch(docs, vocab, coef, 0.3, "len2", 1, 2, True, 5000).select("doc_id", F.round("p", 9).alias("p"))
    assert streamed.count() == docs.count()
    assert sorted(streamed.collect()) == sorted(batch.collect())
