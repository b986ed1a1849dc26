"""Store of word vectors alone (A7): files by hash of the word, so that looking words up reads few of them.

A word's bucket is the leading bits of its hash; buckets are partition folders, whose number follows the number
of words, and a file is sorted by hash, so that a lookup prunes folders by the bucket and row groups by their
least and largest hash. Nothing but Parquet's own statistics is needed as an index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a bucket, about, and leading bits at most (folders of a store).
BUCKET_WORDS, MOST_BITS = 50_000, 12


def _bucket(hash_: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hash_, 64 - bits).cast("int") if bits else F.lit(0)


def store_vectors(vectors: DataFrame, path: str, bucket_words: int = BUCKET_WORDS) -> str:
    """Write (word, vector) under ``path``; the path."""
    n, bits = vectors.count(), 0
    while bits < MOST_BITS and n > bucket_words << bits:
        bits += 1
    rows = vectors.select("word", "vector", F.xxhash64("word").alias("hash"))
    rows = rows.withColumns({"bits": F.lit(bits), "bucket": _bucket(F.col("hash"), bits)})
    (rows.repartition(1 << bits, "bucket").sortWithinPartitions("bucket", "hash").write.mode("overwrite")
     .partitionBy("bits", "bucket").parquet(path))
    return path


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(word, vector) of the whole store."""
    return spark.read.parquet(path).select("word", "vector")


def lookup_vectors(spark: SparkSession, path: str, words: Sequence[str]) -> DataFrame:
    """(word, vector) of those of ``words`` that the store has; only their buckets are read."""
    store = spark.read.parquet(path)
    some = store.select("bits").first()
    wanted = sorted(set(words))
    if some is None or not wanted:
        return store.select("word", "vector").filter(F.lit(False))
    asked = spark.createDataFrame([(w,) for w in wanted], "word string").select(F.xxhash64("word").alias("hash"))
    asked = asked.select("hash", _bucket(F.col("hash"), some["bits"]).alias("bucket")).collect()
    return store.filter(F.col("bucket").isin(sorted({r["bucket"] for r in asked})) & F.col("hash").isin([r["hash"] for r in asked])
                        & F.col("word").isin(wanted)).select("word", "vector")
