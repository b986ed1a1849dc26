"""Catalog: Structured Streaming scorer over the review table (file source -> foreachBatch)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from revlens.operators import features as FT
from revlens.plans import duck as D
from revlens.plans.q_features import fit
from revlens.plans.registry import query
from revlens.session import scratch_path
from revlens.sources import tables
from revlens.streaming.scoring import start_scoring_stream

_SQL = "WITH " + D.fit_ctes("len2", 1, 4, 80000, 1, binary=True) + ",\n" \
    + D.fit_ctes("len2", 1, 4, None, docs_sql="SELECT doc_id AS id, text, CAST(NULL AS INTEGER) AS label FROM documents",
                 prefix="u_") + """,
cs AS (SELECT v.term, sum(CASE WHEN t.label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN t.label = 0 THEN 1 ELSE 0 END) AS neg
       FROM tf t JOIN vocab v ON t.term = v.term GROUP BY v.term),
r AS (SELECT term, ln(((pos + 1.0) / sum(pos + 1.0) OVER ()) / ((neg + 1.0) / sum(neg + 1.0) OVER ())) AS r FROM cs),
b AS (SELECT ln(CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) / sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)) AS b FROM docs),
s AS (SELECT t.id, sum(r.r) AS s FROM u_tf t JOIN r ON t.term = r.term GROUP BY t.id),
z AS (SELECT d.id, (SELECT b FROM b) + coalesce(s.s, 0.0) AS z FROM u_docs d LEFT JOIN s ON d.id = s.id)
SELECT id AS doc_id, round(z, 6) AS logodds, round(1.0 / (1.0 + exp(-greatest(least(z, 700.0), -700.0))), 6) AS p FROM z"""


@query("stream_scores", _SQL)
def stream_scores_q(spark, sf):
    """Every review file under the table folder is read as a stream (available-now trigger)
    and scored per micro-batch with the NB log-ratio linear model fitted on the labeled
    reviews (0/1 1-4-grams, 80,000 terms, bias ln(n_pos/n_neg)); each batch is written to its
    own folder (idempotent on replay) and the result is read back."""
    _, tf, _, vocab = fit(spark, sf, "len2", 1, 4, 80000, 1, binary=True)
    coef = FT.nb_log_ratio(FT.nb_class_sums(tf, vocab, 80000)).select("idx", F.col("r").alias("w"))
    cnt = {r[0]: r[1] for r in tables.labeled(spark, sf).groupBy("label").count().collect()}
    bias = math.log(cnt[1] / cnt[0]) if cnt.get(1) and cnt.get(0) else 0.0
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = start_scoring_stream(spark, f"{sf.rstrip('/')}/documents*.parquet", out, ckpt, vocab, coef, bias,
                             "len2", 1, 4, 80000, available_now=True)
    q.awaitTermination()
    res = spark.read.parquet(out)
    return res.select("doc_id", F.round("logodds", 6).alias("logodds"), F.round("p", 6).alias("p"))
