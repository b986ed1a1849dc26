"""Closed-form scorers that are pure aggregates: multinomial naive Bayes (F8), the
NB log-ratio linear scorer and the generic linear scorer (F16).

All of them train with one aggregate over the long term table and score with a join
against a vocabulary-sized model table, so they scale like a GROUP BY. The out-of-fold
variants train all k fold models in the same aggregate: counts of the training part of
fold f are the totals minus the counts inside fold f.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.operators.features import BROADCAST_VOCAB_ROWS

# Log-odds are bounded so that exp() stays finite for very long reviews.
MAX_LOGODDS = 700.0


def sigmoid(logodds):
    z = F.greatest(F.least(logodds, F.lit(MAX_LOGODDS)), F.lit(-MAX_LOGODDS))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _maybe_broadcast(df, rows):
    return F.broadcast(df) if rows is not None and rows <= BROADCAST_VOCAB_ROWS else df


def fold_class_counts(tf: DataFrame, vocab: DataFrame, k: int, binary: bool,
                      max_features: int | None = None) -> DataFrame:
    """(fold, term, idx, pos, neg): class sums of the *training* part of every fold.
    ``tf`` carries (id, label, fold, term or idx, tf), with idx only terms of ``vocab``. A fold x vocabulary grid is generated with
    an explode (k rows per term), never a join without keys."""
    x = F.lit(1).cast("long") if binary else F.col("tf").cast("long")
    j = tf if "idx" in tf.columns else tf.join(_maybe_broadcast(vocab.select("term", "idx"), max_features), "term")
    inside = j.groupBy("fold", "idx").agg(
        F.sum(F.when(F.col("label") == 1, x).otherwise(0)).alias("pos_in"),
        F.sum(F.when(F.col("label") == 0, x).otherwise(0)).alias("neg_in"))
    totals = inside.groupBy("idx").agg(F.sum("pos_in").alias("pos_all"), F.sum("neg_in").alias("neg_all"))
    grid = vocab.select("term", "idx", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"))
    g = (grid.join(totals, "idx", "left").join(inside, ["fold", "idx"], "left").na.fill(0, [
        "pos_all", "neg_all", "pos_in", "neg_in"]))
    return g.select("fold", "term", "idx", (F.col("pos_all") - F.col("pos_in")).alias("pos"),
                    (F.col("neg_all") - F.col("neg_in")).alias("neg"))


def fold_class_sizes(docs: DataFrame) -> DataFrame:
    """(fold, n_pos, n_neg) of the training part of every fold; docs carry (fold, label)."""
    per = docs.groupBy("fold").agg(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("p_in"),
                                   F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("n_in"))
    every = Window.partitionBy()  # over the per-fold table: k rows
    return per.select("fold", (F.sum("p_in").over(every) - F.col("p_in")).alias("n_pos"),
                      (F.sum("n_in").over(every) - F.col("n_in")).alias("n_neg"))


def _per_fold_totals(counts: DataFrame, cols: dict) -> DataFrame:
    """Per-fold sums over the vocabulary: k rows, joined back by fold (broadcast)."""
    return F.broadcast(counts.groupBy("fold").agg(*[e.alias(n) for n, e in cols.items()]))


def mnb_fold_models(counts: DataFrame, sizes: DataFrame, alpha: float = 0.5) -> DataFrame:
    """(fold, term, idx, w) with w = ln P(t|1) - ln P(t|0) (smoothed); the class prior goes into
    ``fold_bias``. Sums over the vocabulary are one per-fold aggregate (k rows), joined back."""
    t = _per_fold_totals(counts, {"_v": F.count(F.lit(1)), "_sp": F.sum("pos"), "_sn": F.sum("neg")})
    lp1 = F.log((F.col("pos") + alpha) / (F.col("_sp") + alpha * F.col("_v")))
    lp0 = F.log((F.col("neg") + alpha) / (F.col("_sn") + alpha * F.col("_v")))
    return counts.join(t, "fold").select("fold", "term", "idx", (lp1 - lp0).alias("w"))


def fold_bias(sizes: DataFrame) -> DataFrame:
    """Class log-prior difference ln(n_pos / n_neg) per fold."""
    return sizes.select("fold", F.log(F.col("n_pos") / F.col("n_neg")).alias("b"))


def nbr_fold_models(counts: DataFrame, alpha: float = 1.0) -> DataFrame:
    """(fold, term, idx, w = r): NB log-count ratio of every fold's training part."""
    p = F.col("pos") + alpha
    q = F.col("neg") + alpha
    t = _per_fold_totals(counts, {"_sp": F.sum(p), "_sq": F.sum(q)})
    return counts.join(t, "fold").select("fold", "term", "idx",
                                         F.log((p / F.col("_sp")) / (q / F.col("_sq"))).alias("w"))


def score_folds(tf: DataFrame, docs: DataFrame, models: DataFrame, bias: DataFrame, k: int,
                vocab_rows: int | None, binary: bool, model_name: str) -> DataFrame:
    """(id, model, fold, label, logodds, p): each review scored by the model of its own fold.
    Reviews with no vocabulary term keep the bias alone (left join back to the review list)."""
    x = F.lit(1.0) if binary else F.col("tf").cast("double")
    key = "idx" if "idx" in tf.columns else "term"
    m = _maybe_broadcast(models.select("fold", key, "w"), None if vocab_rows is None else k * vocab_rows)
    s = tf.join(m, ["fold", key]).groupBy("id").agg(F.sum(x * F.col("w")).alias("s"))
    out = (docs.select("id", "fold", "label").join(s, "id", "left")
           .join(F.broadcast(bias), "fold")
           .withColumn("logodds", F.col("b") + F.coalesce(F.col("s"), F.lit(0.0))))
    return out.select("id", F.lit(model_name).alias("model"), "fold", "label", "logodds",
                      sigmoid(F.col("logodds")).alias("p"))


def linear_scorer(feat: DataFrame, coef: DataFrame, docs: DataFrame, bias: float | None = 0.0,
                  id_col: str = "id", coef_rows: int | None = None) -> DataFrame:
    """F16: p = sigmoid(b + sum_j w_j x_j) from long features (id, idx, value) and a
    coefficient table (idx, w); reviews without features get sigmoid(b)."""
    c = _maybe_broadcast(coef.select("idx", "w"), coef_rows)
    s = feat.join(c, "idx").groupBy(id_col).agg(F.sum(F.col("value") * F.col("w")).alias("s"))
    z = F.lit(float(bias or 0.0)) + F.coalesce(F.col("s"), F.lit(0.0))
    return docs.select(id_col).join(s, id_col, "left").select(id_col, z.alias("logodds"), sigmoid(z).alias("p"))


def mnb_model(class_sums: DataFrame, alpha: float = 0.5) -> DataFrame:
    """(idx, w = ln P(t|1) - ln P(t|0)) of a multinomial NB fitted on all rows; ``class_sums``
    (term, idx, pos, neg) holds raw counts. Vocabulary-sized windows."""
    t = class_sums.agg(F.count(F.lit(1)).alias("v"), F.sum("pos").alias("sp"), F.sum("neg").alias("sn")).first()
    v, sp, sn = float(t["v"]), float(t["sp"] or 0), float(t["sn"] or 0)
    lp1 = F.log((F.col("pos") + alpha) / F.lit(sp + alpha * v))
    lp0 = F.log((F.col("neg") + alpha) / F.lit(sn + alpha * v))
    return class_sums.select("term", "idx", (lp1 - lp0).alias("w"))


def prior_log_odds(docs: DataFrame, label_col: str = "label") -> float:
    """ln(n_pos / n_neg) — one scalar reaches the driver."""
    r = docs.agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).alias("p"),
                 F.sum(F.when(F.col(label_col) == 0, 1).otherwise(0)).alias("n")).first()
    import math
    return math.log(r["p"] / r["n"]) if r["p"] and r["n"] else 0.0
