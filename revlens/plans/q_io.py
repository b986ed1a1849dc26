"""Catalog: scans, sinks and stores (A1-A8) as write -> read round trips of data that Spark
derives from the driver tables. Files go under the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from revlens.functions import profiles as P
from revlens.functions import wordlists as W
from revlens.operators import corpus as C
from revlens.operators import features as FT
from revlens.plans import duck as D
from revlens.plans.q_corpus import _sent_out, _sent_sql, _LABELED_SQL
from revlens.plans.registry import query
from revlens.session import scratch_path
from revlens.sources import reviews_io as IO
from revlens.sources import tables


@query("read_review_tsv", r"""
SELECT CAST(d.doc_id AS VARCHAR) AS id, CAST(l.quality AS INTEGER) AS sentiment,
       regexp_replace(d.text, '[\t\r\n]', ' ', 'g') AS review
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def read_review_tsv_q(spark, sf):
    """A1: labeled reviews written as a quoting-off TSV, scanned back with an explicit schema."""
    lab = tables.labeled(spark, sf).select(F.col("doc_id").cast("string").alias("id"),
                                           F.col("label").alias("sentiment"), F.col("text").alias("review"))
    path = scratch_path(spark, "labeledTrainData")
    IO.write_review_tsv(lab, path)
    return IO.read_review_tsv(spark, path, IO.LABELED_SCHEMA)


def _lex_share(df):
    c = FT.lexicon_counts(P.profile_tokens("len2", "text"), W.LEXICON_POSITIVE, W.LEXICON_NEGATIVE,
                          W.LEXICON_NEGATION)
    return df.select("doc_id", ((c[0] + 1.0) / (c[0] + c[1] + 2.0)).alias("p"))


def _lex_share_sql(src):
    w = D.profile_tokens("len2", "text")

    def hits(lst):
        return f"len(list_intersect(list_distinct(w), [{', '.join(D.q(x) for x in lst)}]))"
    return (f"SELECT doc_id, ({hits(W.LEXICON_POSITIVE)} + 1.0) / ({hits(W.LEXICON_POSITIVE)} + "
            f"{hits(W.LEXICON_NEGATIVE)} + 2.0) AS p FROM (SELECT doc_id, {w} AS w FROM {src}) t")


_TEST_SRC = "(SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"


@query("write_submission", f"""
SELECT CAST(doc_id AS VARCHAR) AS id, round(p, 6) AS sentiment FROM ({_lex_share_sql(_TEST_SRC)}) s""")
def write_submission_q(spark, sf):
    """A3: lexicon-share probabilities of the test reviews written as a submission file
    (header "id","sentiment", quoted ids) and read back."""
    path = scratch_path(spark, "submission")
    IO.write_submission(_lex_share(tables.test_reviews(spark, sf)), path, "doc_id", "p")
    return IO.read_submission(spark, path).select("id", F.round("sentiment", 6).alias("sentiment"))


@query("write_label_submission", f"""
SELECT CAST(doc_id AS VARCHAR) AS id, CAST(p > 0.5 AS INTEGER) AS sentiment FROM ({_lex_share_sql(_TEST_SRC)}) s""")
def write_label_submission_q(spark, sf):
    """A4: hard labels under a run-stamped folder, read back."""
    df = _lex_share(tables.test_reviews(spark, sf)).select("doc_id", (F.col("p") > 0.5).cast("int").alias("sentiment"))
    path = IO.write_label_submission(df, scratch_path(spark, "labels"), uuid.uuid4().hex[:8], "doc_id")
    return spark.read.schema("id string, sentiment int").option("header", True).csv(path)


@query("write_probability_file", f"""
SELECT CAST(doc_id AS VARCHAR) AS id, round(p, 6) AS sentiment_proba FROM ({_lex_share_sql(_TEST_SRC)}) s""")
def write_probability_file_q(spark, sf):
    """A5: probabilities beside the hard labels, read back."""
    df = _lex_share(tables.test_reviews(spark, sf)).withColumnRenamed("p", "sentiment_proba")
    path = IO.write_probability_file(df, scratch_path(spark, "labels"), uuid.uuid4().hex[:8], "doc_id")
    back = spark.read.schema("id string, sentiment_proba double").option("header", True).csv(path)
    return back.select("id", F.round("sentiment_proba", 6).alias("sentiment_proba"))


@query("read_prediction_set", f"""
WITH s AS ({_lex_share_sql(_TEST_SRC)})
SELECT CAST(doc_id AS VARCHAR) AS id, 'lex' AS model, round(p, 6) AS p, CAST(0.6 AS DOUBLE) AS weight FROM s
UNION ALL
SELECT CAST(doc_id AS VARCHAR) AS id, 'lex_sq' AS model, round(p * p, 6) AS p, CAST(0.3 AS DOUBLE) AS weight FROM s""")
def read_prediction_set_q(spark, sf):
    """A2: three named submission files are expected, one is missing; the two present are read
    in one scan and tagged with model name and weight by name."""
    share = _lex_share(tables.test_reviews(spark, sf))
    base = scratch_path(spark, "submissions")
    IO.write_submission(share, f"{base}/lex", "doc_id", "p")
    IO.write_submission(share.withColumn("p", F.col("p") * F.col("p")), f"{base}/lex_sq", "doc_id", "p")
    files = [("lex", f"{base}/lex", 0.6), ("missing", f"{base}/missing", 0.1), ("lex_sq", f"{base}/lex_sq", 0.3)]
    s = IO.read_prediction_set(spark, files)
    return s.select("id", "model", F.round("p", 6).alias("p"), F.round("weight", 6).alias("weight"))


@query("sentence_corpus_store", _sent_sql(_LABELED_SQL, "clean_first"))
def sentence_corpus_store_q(spark, sf):
    """The sentence corpus persisted as parquet (ARRAY<STRING>) and reloaded."""
    rows = C.sentence_rows(tables.labeled(spark, sf), "doc_id", mode="clean_first")
    back = IO.store_sentences(rows, scratch_path(spark, "sentences"))
    return _sent_out(back)


@query("model_store", """
SELECT doc_id, TRUE AS p_in_range, TRUE AS same_after_reload FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def model_store_q(spark, sf):
    """Fit a logistic regression on the lexicon columns, save it, load it, score the test set."""
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
    from pyspark.ml.feature import VectorAssembler
    cols = ["pos", "neg", "negation", "eff_pos", "eff_neg"]

    def lex(df):
        return df.select("doc_id", *FT.lexicon_counts(P.profile_tokens("len2", "text"), W.LEXICON_POSITIVE,
                                                      W.LEXICON_NEGATIVE, W.LEXICON_NEGATION),
                         *([F.col("label").cast("double").alias("label")] if "label" in df.columns else []))
    va = VectorAssembler(inputCols=cols, outputCol="features")
    model = LogisticRegression(maxIter=50).fit(va.transform(lex(tables.labeled(spark, sf))))
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = LogisticRegressionModel.load(path)
    from pyspark.ml.functions import vector_to_array
    rows = va.transform(lex(tables.test_reviews(spark, sf))).select("doc_id", "features")
    p = vector_to_array("probability")[1]
    before = model.transform(rows).select("doc_id", "features", p.alias("before"))
    return loaded.transform(before).select("doc_id", p.between(0.0, 1.0).alias("p_in_range"),
                                           (F.abs(p - F.col("before")) < 1e-12).alias("same_after_reload"))


@query("frame_profile", """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM documents) AS n_rows, CAST(5 AS BIGINT) AS n_cols,
       'doc_id,text,lang,source,n_chars' AS columns, doc_id, text
FROM documents ORDER BY doc_id LIMIT 3""")
def frame_profile_q(spark, sf):
    """Shape, column names and the first three rows (by id) of the review table."""
    d = tables.table(spark, sf, "documents")
    n, cols = d.count(), d.columns
    return (d.orderBy("doc_id").limit(3)
            .select(F.lit(n).cast("long").alias("n_rows"), F.lit(len(cols)).cast("long").alias("n_cols"),
                    F.lit(",".join(cols)).alias("columns"), "doc_id", "text"))
