"""Ensemble algebra (G1-G11) over long predictions (id, model, p).

Every combiner is one aggregate per id (a handful of rows per id, partial aggregation
map-side), so all of them run in the same GROUP BY. Weights are a small table joined by
model name (never by position), broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.ranking import average_rank_table


def weights_table(spark, weights: dict[str, float]) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "model string, weight double")


def with_weights(pred: DataFrame, weights: DataFrame) -> DataFrame:
    """Join weights by model name; a model without a weight row is dropped (as a missing
    input file is skipped)."""
    return pred.join(F.broadcast(weights), "model")


def clip01(c):
    """G10."""
    return F.greatest(F.least(c, F.lit(1.0)), F.lit(0.0))


def _geo(p):
    # ln(0) is NULL in Spark and would be skipped by avg: any zero makes the product zero
    return F.when(F.min(p) <= 0, F.lit(0.0)).otherwise(F.exp(F.avg(F.log(p))))


def combiners(pred: DataFrame, weights: DataFrame | None = None, normalise: bool = True,
              threshold: float = 0.5, hi: float = 0.6, lo: float = 0.4, id_col: str = "id") -> DataFrame:
    """G1-G8 in one aggregate: mean, weighted, tjflexic, aggressive, geometric, harmonic,
    power(3), median."""
    p = F.col("p")
    df = with_weights(pred, weights) if weights is not None else pred.withColumn("weight", F.lit(1.0))
    wsum = F.sum(F.col("weight") * p)
    weighted = wsum / F.sum("weight") if normalise else wsum
    agg = df.groupBy(id_col).agg(
        F.avg(p).alias("ens_mean"), weighted.alias("ens_weighted"),
        F.max(p).alias("_max"), F.min(p).alias("_min"),
        _geo(p).alias("ens_geometric"),
        (F.count(F.lit(1)) / F.sum(F.lit(1.0) / (p + F.lit(0.001)))).alias("ens_harmonic"),
        F.pow(F.avg(F.pow(p, 3.0)), 1.0 / 3.0).alias("ens_power"),
        F.median(p).alias("ens_median"))
    base = F.col("ens_weighted")
    return agg.select(
        id_col, "ens_mean", "ens_weighted",
        F.when(base > threshold, F.col("_max")).otherwise(F.col("_min")).alias("ens_tjflexic"),
        F.when(base > hi, F.col("_max")).when(base < lo, F.col("_min")).otherwise(base).alias("ens_aggressive"),
        "ens_geometric", "ens_harmonic", "ens_power", "ens_median")


def rank_average(pred: DataFrame, id_col: str = "id", rank_col: str = "p") -> DataFrame:
    """Each model's average-tie rank of ``rank_col``, mean over models, divided by the row count of
    a model. Ranks are computed per distinct (model, value) and joined back on both."""
    ranks = average_rank_table(pred, rank_col, ["model"])
    n_rows = pred.groupBy("model").agg(F.count(F.lit(1)).alias("_n"))  # one row per model
    r = (pred.join(ranks.select("model", rank_col, "avg_rank"), ["model", rank_col])
         .join(F.broadcast(n_rows), "model"))
    return r.groupBy(id_col).agg(F.avg(F.col("avg_rank") / F.col("_n")).alias("ens_rank"))


def as_models(ens: DataFrame, columns: list[str], id_col: str = "id") -> DataFrame:
    """Turn ensemble columns back into prediction rows (id, model, p) for the next level."""
    arr = F.array(*[F.struct(F.lit(c).alias("model"), F.col(c).alias("p")) for c in columns])
    return ens.select(id_col, F.explode(arr).alias("e")).select(id_col, "e.model", "e.p")
