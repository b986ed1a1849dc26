"""Evaluation (E5-E7, E9, E11, E13) over long prediction tables (id, model[, fold], label, p).

AUC is exact (Mann-Whitney with average ranks for ties): predictions are first reduced to
one row per distinct score, so a hot score value is a single row, and ranks come from the
distributed running-count helper instead of a window over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.ranking import average_rank_table


def threshold_label(p_col: str = "p", threshold: float = 0.5):
    """P > threshold -> 1 else 0."""
    return (F.col(p_col) > F.lit(threshold)).cast("int")


def accuracy(pred: DataFrame, group_cols: Sequence[str] = ("model",), p_col: str = "p",
             label_col: str = "label", threshold: float = 0.5) -> DataFrame:
    """E5: share of reviews whose thresholded prediction equals the label."""
    hit = (threshold_label(p_col, threshold) == F.col(label_col)).cast("double")
    return pred.groupBy(*group_cols).agg(F.avg(hit).alias("accuracy"))


def roc_auc(pred: DataFrame, group_cols: Sequence[str] = ("model",), p_col: str = "p",
            label_col: str = "label") -> DataFrame:
    """Exact ROC AUC per group."""
    ranks = average_rank_table(pred, p_col, group_cols,
                               {"npos": (F.col(label_col) == 1).cast("long")})
    g = ranks.groupBy(*group_cols).agg(F.sum("npos").alias("P"), F.sum("cnt").alias("n"),
                                       F.sum(F.col("npos") * F.col("avg_rank")).alias("S"))
    P = F.col("P").cast("double")
    N = (F.col("n") - F.col("P")).cast("double")
    auc = (F.col("S") - P * (P + 1) / 2) / F.nullif(P * N, F.lit(0.0))
    return g.select(*group_cols, auc.alias("auc"))


def auc_by_windows(pred: DataFrame, group_cols: Sequence[str] = ("model",), rank_col: str = "p", label_col: str = "label") -> DataFrame:
    """The same number another way, to check ``roc_auc`` with: for each distinct value, positives times the
    negatives below it and half of those beside it, over all pairs. A window over distinct values per group."""
    from pyspark.sql import Window
    per = pred.groupBy(*group_cols, rank_col).agg(F.count_if(F.col(label_col) == 1).alias("pos"), F.count_if(F.col(label_col) == 0).alias("neg"))
    below = F.coalesce(F.sum("neg").over(Window.partitionBy(*group_cols).orderBy(rank_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = per.withColumn("won", F.col("pos") * (below + F.col("neg") / 2.0))
    return won.groupBy(*group_cols).agg((F.sum("won") / F.nullif((F.sum("pos") * F.sum("neg")).cast("double"), F.lit(0.0))).alias("auc"))


def cross_validate(pred: DataFrame, model_col: str = "model", fold_col: str = "fold",
                   rank_col: str = "p") -> DataFrame:
    """Per-fold AUC (of ``rank_col``: a probability or a raw score) and accuracy, then mean and
    population std over folds."""
    per = roc_auc(pred, (model_col, fold_col), rank_col).join(accuracy(pred, (model_col, fold_col)), [model_col, fold_col])
    return per.groupBy(model_col).agg(
        F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"),
        F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"),
        F.count(F.lit(1)).alias("n_folds"))


def select_best(metrics: DataFrame, metric: str = "mean_auc", key: str = "model") -> DataFrame:
    """The configuration with the highest metric (ties: smallest key)."""
    return metrics.orderBy(F.col(metric).desc(), F.col(key)).limit(1).select(
        F.col(key).alias("best"), F.col(metric).alias("best_" + metric))


def score_gate(metric_col: str = "auc", high: float = 0.94, mid: float = 0.90):
    """Band a score."""
    m = F.col(metric_col)
    return F.when(m >= high, F.lit("excellent")).when(m >= mid, F.lit("good")).otherwise(F.lit("below"))


def model_comparison(metrics: DataFrame, baseline: str, metric: str = "auc", key: str = "model") -> DataFrame:
    """metric per model and its difference to the baseline model (a one-row side)."""
    base = metrics.filter(F.col(key) == baseline).select(F.col(metric).alias("_base"))
    base_v = base.first()
    b = F.lit(None).cast("double") if base_v is None else F.lit(float(base_v[0]))
    return metrics.select(key, metric, (F.col(metric) - b).alias("delta_" + metric))
