"""Score reviews as they arrive.

Cleaning and linear scoring are stateless per review, so the stream needs no aggregation
state: every micro-batch is handed to the same batch operators (``foreachBatch``) and
written to a folder keyed by the batch id, which makes a replayed batch overwrite its own
output instead of duplicating it (exactly-once at the sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions import profiles as P
from revlens.operators import features as FT
from revlens.operators.scorers import linear_scorer
from revlens.session import written

REVIEW_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                              T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                              T.StructField("n_chars", T.LongType())])


def score_batch(reviews: DataFrame, vocab: DataFrame, coef: DataFrame, bias: float, profile: str,
                lo: int, hi: int, binary: bool = True, vocab_rows: int | None = None) -> DataFrame:
    """(doc_id, logodds, p) for a batch of reviews with a fitted vocabulary and coefficients."""
    docs = FT.by_review(reviews, "doc_id").select(F.col("doc_id").alias("id"), P.profile_tokens(profile, "text").alias("words"))
    tf = FT.known_counts(docs, vocab, lo, hi, vocab_rows)
    feat = tf.select("id", "idx", (F.lit(1) if binary else F.col("tf")).cast("double").alias("value"))
    out = linear_scorer(feat, coef, docs, bias, "id", vocab_rows)
    return out.withColumnRenamed("id", "doc_id")


def start_scoring_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                         vocab: DataFrame, coef: DataFrame, bias: float, profile: str = "len2",
                         lo: int = 1, hi: int = 4, vocab_rows: int | None = None,
                         available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream: parquet files of reviews in ``source_dir`` -> scores under
    ``sink_dir/batch_id=<n>``. The model tables are small and fixed (broadcast by bound)."""
    reader = spark.readStream.schema(REVIEW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.parquet(source_dir)
    vocab = written(vocab.select("term", "idx"), "stream-vocabulary")  # read by every micro-batch
    coef = written(coef.select("idx", "w"), "stream-weights")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        scored = score_batch(batch, vocab, coef, bias, profile, lo, hi, True, vocab_rows)
        scored.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
