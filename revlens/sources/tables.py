"""Driver tables and the review roles derived from them.

review    = documents(doc_id, text)
labeled   = documents joined with labels (label = labels.quality)
test      = documents without a label (left-anti join) — the set that gets scored
unlabeled = conversation turns, the extra corpus for embeddings (review_id = conv_id_turn)
markup    = pages(page_id, html)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# Key that a text table is spread on where the session asks for it.
_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "benchmark": "item_id",
         "embeddings": "vec_id"}

#: Session setting: number of partitions that text scans are dealt to before per-row work. Unset (the
#: default), a scan keeps its splits; tests and bench set it, because their files have one split.
SPREAD_CONF = "spark.revlens.scanPartitions"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Scan one driver table, dealt by its key to as many partitions as the session names, if it does."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get(SPREAD_CONF, None)
    if not spread or not parts or name not in _KEYS:
        return df
    return df.repartition(int(parts), _KEYS[name])


def documents(spark, sf_dir, spread: bool = True) -> DataFrame:
    return table(spark, sf_dir, "documents", spread).select("doc_id", "text")


def labels(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))


def labeled(spark, sf_dir) -> DataFrame:
    """(doc_id, text, label). labels holds one row per doc, so the join keeps doc_id unique.
    Not spread on read: feature paths hash-partition the raw reviews on id themselves."""
    return documents(spark, sf_dir, spread=False).join(labels(spark, sf_dir), "doc_id")


def test_reviews(spark, sf_dir) -> DataFrame:
    """(doc_id, text) of every document without a label."""
    return documents(spark, sf_dir, spread=False).join(labels(spark, sf_dir), "doc_id", "left_anti")


def unlabeled(spark, sf_dir) -> DataFrame:
    """(review_id, text) of conversation turns."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.concat_ws("_", F.col("conv_id").cast("string"),
                                F.col("turn").cast("string")).alias("review_id"), "text")


def pages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "html")


def benchmark(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")


def embeddings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
