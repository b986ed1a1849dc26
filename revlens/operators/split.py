"""Deterministic splits (E1-E4) and class weights.

Order is ``md5('<seed>|<id>')`` then id, so the assignment is the same on any cluster
layout (``randomSplit`` depends on partitioning). Row numbers come from the distributed
ranking helper, never from a window over a whole class.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.ranking import row_number0


#: Labelled rows of the quick searches (E4, E8): their documented bound.
QUICK_ROWS = 5000


def shuffle_key(id_col: str, seed: int = 42):
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def _ranked(df, id_col, seed, group_cols=()):
    keyed = df.withColumn("_key", shuffle_key(id_col, seed))
    return row_number0(keyed, ["_key", id_col], group_cols, out="_rn")


def holdout_split(df: DataFrame, test_size: float = 0.2, id_col: str = "id", seed: int = 42) -> DataFrame:
    """The first ceil(test_size * n) rows in shuffle order are validation (is_valid = 1)."""
    n_valid = math.ceil(test_size * df.count())
    r = _ranked(df, id_col, seed)
    return r.withColumn("is_valid", (F.col("_rn") < n_valid).cast("int")).drop("_key", "_rn")


def _class_sizes(df, label_col):
    return {r[0]: r[1] for r in df.groupBy(label_col).count().collect()}  # one row per class


def stratified_holdout(df: DataFrame, test_size: float = 0.2, label_col: str = "label",
                       id_col: str = "id", seed: int = 42) -> DataFrame:
    """E1 inside each class: the first ceil(test_size * n_c) of class c are validation."""
    sizes = _class_sizes(df, label_col)
    cut = F.lit(None).cast("long")
    for c, n in sizes.items():
        cut = F.when(F.col(label_col) == F.lit(c), F.lit(math.ceil(test_size * n))).otherwise(cut)
    r = _ranked(df, id_col, seed, [label_col])
    return r.withColumn("is_valid", (F.col("_rn") < cut).cast("int")).drop("_key", "_rn")


def stratified_kfold(df: DataFrame, k: int = 5, label_col: str = "label", id_col: str = "id",
                     seed: int = 42) -> DataFrame:
    """fold = (row number within class in shuffle order) mod k — sizes differ by <= 1."""
    r = _ranked(df, id_col, seed, [label_col])
    return r.withColumn("fold", (F.col("_rn") % k).cast("int")).drop("_key", "_rn")


def first_n_subset(df: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """The first n rows by id (the order is made explicit). The ids are cut alone and joined
    back, so the rows themselves keep their partitions."""
    ids = df.select(F.col(id_col).alias("_first")).orderBy("_first").limit(n)
    return df.join(ids, df[id_col] == ids["_first"], "left_semi")


def class_weights_balanced(df: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, n, weight = n_total / (n_classes * n_label)), one row per class."""
    from pyspark.sql import Window
    c = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()  # over the per-class table: one row per class
    return c.select(F.col(label_col).cast("int").alias("label"), "n",
                    (F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label_col: str = "label", out: str = "weight") -> DataFrame:
    w = class_weights_balanced(df, label_col)
    return df.join(F.broadcast(w.select(F.col("label").alias(label_col), F.col("weight").alias(out))), label_col)
