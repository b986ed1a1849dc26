"""Catalog: splits, metrics, closed-form scorers and ensembles (E1-E13, F8, F16, F17,
G1-G11, A9, A10).

Every key here is exact in both engines. The shared prediction table is the out-of-fold
output (5 stratified folds, vocabulary fitted on all labeled reviews) of three closed-form
scorers:
  mnb  multinomial naive Bayes, alpha 0.5, counts of letters-cleaner unigrams (5,000, min_df 2)
  nbr  NB log-count-ratio linear scorer, 0/1 presence of 1-2-grams (10,000, min_df 2)
  lex  lexicon share (pos + 1) / (pos + neg + 2)
Metrics rank by log-odds rounded to six decimals, so that both engines see the same ties and long
reviews whose probabilities are all but 0 or 1 keep their order; only output columns are rounded.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions import profiles as P
from revlens.functions import wordlists as W
from revlens.operators import ensemble as G
from revlens.operators import features as FT
from revlens.operators import metrics as M
from revlens.operators import scorers as S
from revlens.operators import split as SP
from revlens.plans import duck as D
from revlens.plans.registry import query
from revlens.session import scratch_path, scratch_paths, written
from revlens.sources import tables

K = 5
SEED = 42
ENS_WEIGHTS = {"mnb": 0.5, "nbr": 0.3, "lex": 0.2}
RAW_WEIGHTS = {"mnb": 0.6, "nbr": 0.5, "lex": 0.3}

# --------------------------------------------------------------------------- Spark side


def labeled_ids(spark, sf):
    return tables.labeled(spark, sf).select(F.col("doc_id").alias("id"), "label", "text")


def folds(spark, sf):
    """(id, label, fold) — fold assignment from (id, label) only, joined back to the text."""
    lab = labeled_ids(spark, sf)
    f = SP.stratified_kfold(lab.select("id", "label"), K, "label", "id", SEED)
    # the join shuffles raw text on id: cleaning and the per-review aggregates run after it
    parts = FT.review_parts(lab)
    joined = lab.join(f.select("id", "fold"), "id")
    return joined.repartition(parts, "id") if parts else joined.repartition("id")


def _fold_scorer(d, n, lo, hi, max_features, min_df, binary, name, sizes):
    if binary:  # ranked by document count
        vocab = written(FT.document_vocabulary(d, n, lo, hi, max_features, min_df, keys=("id", "label", "fold")), "vocabulary")
        tf = written(FT.known_counts(d, vocab, lo, hi, max_features, keep_cols=("label", "fold")), "known-counts")
    else:
        vocab, tf = FT.fit_counts(d, n, lo, hi, max_features, min_df, keep_cols=("label", "fold"))
        vocab, tf = written(vocab, "vocabulary"), written(tf, "known-counts")
    counts = S.fold_class_counts(tf, vocab, K, binary, max_features)
    models = S.nbr_fold_models(counts) if binary else S.mnb_fold_models(counts, sizes, 0.5)
    return S.score_folds(tf, d, models, S.fold_bias(sizes), K, max_features, binary, name)


SCORERS = ("mnb", "nbr", "lex")
#: Prediction tables written by this process: (application, input, scorer) -> path.
_WRITTEN: dict[tuple, str] = {}


def _stamp(spark, sf):
    """What tells one state of the input from another: rows and newest file of both tables."""
    return tuple(tuple(spark.read.parquet(f"{sf.rstrip('/')}/{t}.parquet").agg(
        F.count(F.lit(1)), F.max("_metadata.file_modification_time").cast("string")).first())
        for t in ("documents", "labels"))


def _score_all(spark, sf, wanted):
    """The wanted scorers' rows; len2 words are cleaned once for the two scorers that take them."""
    docs = folds(spark, sf)
    n = tables.labels(spark, sf).count()
    out = {}
    if {"mnb", "nbr"} & set(wanted):
        sizes = written(S.fold_class_sizes(docs.select("fold", "label")), "fold-sizes")
    if "mnb" in wanted:
        d = docs.select("id", "label", "fold", P.profile_tokens("letters", "text").alias("words"))
        out["mnb"] = _fold_scorer(d, n, 1, 1, 5000, 2, False, "mnb", sizes)
    if {"nbr", "lex"} & set(wanted):
        d = docs.select("id", "label", "fold", P.profile_tokens("len2", "text").alias("words"))
        if {"nbr", "lex"} <= set(wanted):
            d = FT.cleaned(d)
        if "nbr" in wanted:
            out["nbr"] = _fold_scorer(d, n, 1, 2, 10000, 2, True, "nbr", sizes)
        if "lex" in wanted:
            hits = FT.lexicon_counts(F.col("words"), W.LEXICON_POSITIVE, W.LEXICON_NEGATIVE, W.LEXICON_NEGATION)
            lex = d.select("id", "fold", "label", hits[0], hits[1])
            out["lex"] = lex.select("id", F.lit("lex").alias("model"), "fold", "label",
                                    F.log((F.col("pos") + 1.0) / (F.col("neg") + 1.0)).alias("logodds"),
                                    ((F.col("pos") + 1.0) / (F.col("pos") + F.col("neg") + 2.0)).alias("p"))
    return out


def oof_predictions(spark, sf, wanted=SCORERS):
    """(id, model, fold, label, z, p) of the wanted scorers. ``z`` is the log-odds rounded to six
    decimals, which absorbs the engines' noise and is what ranks; ``p`` is not rounded. A scorer's
    table is written once per application and state of the input, and read by every metric."""
    key = (spark.sparkContext.applicationId, sf, _stamp(spark, sf))
    missing = [m for m in wanted if (*key, m) not in _WRITTEN or _WRITTEN[(*key, m)] not in scratch_paths(spark)]
    if missing:
        for m, rows in _score_all(spark, sf, missing).items():
            path = scratch_path(spark, f"oof-{m}")
            rows.select("id", "model", "fold", "label", F.round("logodds", 6).alias("z"), "p").write.parquet(path)
            _WRITTEN[(*key, m)] = path
    out = None
    for m in wanted:
        one = spark.read.parquet(_WRITTEN[(*key, m)])
        out = one if out is None else out.unionByName(one)
    return out


def _r6(c):
    return F.round(c, 6).alias(c)


# --------------------------------------------------------------------------- SQL side

_FOLDS_SQL = f"""folds AS (
  SELECT d.doc_id AS id, d.text, l.quality AS label,
         CAST((row_number() OVER (PARTITION BY l.quality ORDER BY md5('{SEED}|' || CAST(d.doc_id AS VARCHAR)), d.doc_id) - 1) % {K} AS INTEGER) AS fold
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
sizes AS (
  SELECT fold, (SELECT count(*) FROM folds WHERE label = 1) - sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS n_pos,
         (SELECT count(*) FROM folds WHERE label = 0) - sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS n_neg
  FROM folds GROUP BY fold)"""


def _scorer_sql(p, profile, lo, hi, max_features, min_df, binary, name):
    x = "1.0" if binary else "t.tf"
    if binary:
        w = (f"ln(((pos + 1.0) / sum(pos + 1.0) OVER (PARTITION BY fold)) / "
             f"((neg + 1.0) / sum(neg + 1.0) OVER (PARTITION BY fold)))")
    else:
        w = (f"ln((pos + 0.5) / (sum(pos) OVER (PARTITION BY fold) + 0.5 * count(*) OVER (PARTITION BY fold))) - "
             f"ln((neg + 0.5) / (sum(neg) OVER (PARTITION BY fold) + 0.5 * count(*) OVER (PARTITION BY fold)))")
    xin = "1" if binary else "tf"
    return D.fit_ctes(profile, lo, hi, max_features, min_df, 1.0, binary=binary,
                      docs_sql="SELECT id, text, label, fold FROM folds", prefix=p,
                      carry=("label", "fold")) + f""",
{p}in AS (SELECT t.fold, v.idx, sum(CASE WHEN t.label = 1 THEN {xin} ELSE 0 END) AS pos_in,
                sum(CASE WHEN t.label = 0 THEN {xin} ELSE 0 END) AS neg_in
         FROM {p}tf t JOIN {p}vocab v ON t.term = v.term GROUP BY t.fold, v.idx),
{p}tot AS (SELECT idx, sum(pos_in) AS pos_all, sum(neg_in) AS neg_all FROM {p}in GROUP BY idx),
{p}grid AS (SELECT v.term, v.idx, f.fold FROM {p}vocab v CROSS JOIN (SELECT unnest(range({K})) AS fold) f),
{p}cnt AS (SELECT g.fold, g.term, g.idx, coalesce(a.pos_all, 0) - coalesce(i.pos_in, 0) AS pos,
                  coalesce(a.neg_all, 0) - coalesce(i.neg_in, 0) AS neg
           FROM {p}grid g LEFT JOIN {p}tot a ON g.idx = a.idx LEFT JOIN {p}in i ON i.fold = g.fold AND i.idx = g.idx),
{p}model AS (SELECT fold, term, {w} AS w FROM {p}cnt),
{p}s AS (SELECT t.id, sum({x} * m.w) AS s FROM {p}tf t JOIN {p}model m ON t.fold = m.fold AND t.term = m.term GROUP BY t.id),
{p}pred AS (SELECT f.id, '{name}' AS model, f.fold, f.label,
                   ln(CAST(z.n_pos AS DOUBLE) / z.n_neg) + coalesce(s.s, 0.0) AS logodds
            FROM folds f LEFT JOIN {p}s s ON f.id = s.id JOIN sizes z ON f.fold = z.fold)"""


def _lex_hits(words, lst):
    return f"len(list_intersect(list_distinct({words}), [{', '.join(D.q(w) for w in lst)}]))"


PRED_CTES = "WITH " + _FOLDS_SQL + ",\n" + _scorer_sql("a_", "letters", 1, 1, 5000, 2, False, "mnb") + ",\n" \
    + _scorer_sql("b_", "len2", 1, 2, 10000, 2, True, "nbr") + f""",
c_w AS (SELECT id, fold, label, {D.profile_tokens('len2', 'text')} AS w FROM folds),
c_pred AS (SELECT id, 'lex' AS model, fold, label,
                  ln(({_lex_hits('w', W.LEXICON_POSITIVE)} + 1.0) / ({_lex_hits('w', W.LEXICON_NEGATIVE)} + 1.0)) AS logodds,
                  ({_lex_hits('w', W.LEXICON_POSITIVE)} + 1.0) / ({_lex_hits('w', W.LEXICON_POSITIVE)} + {_lex_hits('w', W.LEXICON_NEGATIVE)} + 2.0) AS p
           FROM c_w),
pred AS (
  SELECT id, model, fold, label, round(logodds, 6) AS z, 1.0 / (1.0 + exp(-greatest(least(logodds, 700.0), -700.0))) AS p FROM a_pred
  UNION ALL
  SELECT id, model, fold, label, round(logodds, 6) AS z, 1.0 / (1.0 + exp(-greatest(least(logodds, 700.0), -700.0))) AS p FROM b_pred
  UNION ALL
  SELECT id, model, fold, label, round(logodds, 6) AS z, p FROM c_pred)"""

_AUC_CTE = """r AS (SELECT {g}, z, count(*) AS cnt, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS npos FROM pred GROUP BY {g}, z),
r2 AS (SELECT *, coalesce(sum(cnt) OVER (PARTITION BY {g} ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 + (cnt + 1) / 2.0 AS avg_rank FROM r),
auc AS (SELECT {g}, (sum(npos * avg_rank) - sum(npos) * (sum(npos) + 1) / 2.0)
                    / (CAST(sum(npos) AS DOUBLE) * (sum(cnt) - sum(npos))) AS auc FROM r2 GROUP BY {g}),
acc AS (SELECT {g}, avg(CASE WHEN (CASE WHEN p > 0.5 THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END) AS accuracy
        FROM pred GROUP BY {g})"""


def auc_ctes(group: str) -> str:
    return _AUC_CTE.format(g=group)


# --------------------------------------------------------------------------- splits

_LAB = "SELECT d.doc_id AS id, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
_MD5 = f"md5('{SEED}|' || CAST(id AS VARCHAR))"


@query("holdout_split", f"""
WITH lab AS ({_LAB}), r AS (SELECT id, label, row_number() OVER (ORDER BY {_MD5}, id) - 1 AS rn FROM lab)
SELECT id AS doc_id, label, CAST(rn < ceil(CAST(0.2 AS DOUBLE) * (SELECT count(*) FROM lab)) AS INTEGER) AS is_valid FROM r""")
def holdout_split_q(spark, sf):
    """80/20, unstratified, seed 42."""
    lab = labeled_ids(spark, sf).select("id", "label")
    return SP.holdout_split(lab, 0.2, "id", SEED).select(F.col("id").alias("doc_id"), "label", "is_valid")


@query("stratified_holdout", f"""
WITH lab AS ({_LAB}),
r AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY {_MD5}, id) - 1 AS rn,
             count(*) OVER (PARTITION BY label) AS nc FROM lab)
SELECT id AS doc_id, label, CAST(rn < ceil(CAST(0.2 AS DOUBLE) * nc) AS INTEGER) AS is_valid FROM r""")
def stratified_holdout_q(spark, sf):
    """80/20 within each class."""
    lab = labeled_ids(spark, sf).select("id", "label")
    return SP.stratified_holdout(lab, 0.2, "label", "id", SEED).select(
        F.col("id").alias("doc_id"), "label", "is_valid")


@query("stratified_kfold", f"""
WITH lab AS ({_LAB})
SELECT id AS doc_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {_MD5}, id) - 1) % {K} AS INTEGER) AS fold
FROM lab""")
def stratified_kfold_q(spark, sf):
    """Five stratified folds, seed 42."""
    lab = labeled_ids(spark, sf).select("id", "label")
    return SP.stratified_kfold(lab, K, "label", "id", SEED).select(F.col("id").alias("doc_id"), "label", "fold")


@query("first_n_subset", f"SELECT id AS doc_id, label FROM ({_LAB}) lab ORDER BY id LIMIT {SP.QUICK_ROWS}")
def first_n_subset_q(spark, sf, fit_rows=SP.QUICK_ROWS):
    """The leading ``fit_rows`` labeled reviews by id (the quick-search subset)."""
    lab = labeled_ids(spark, sf).select("id", "label")
    return SP.first_n_subset(lab, fit_rows, "id").select(F.col("id").alias("doc_id"), "label")


@query("class_weights_balanced", f"""
WITH lab AS ({_LAB}), c AS (SELECT label, count(*) AS n FROM lab GROUP BY label)
SELECT CAST(label AS INTEGER) AS label, CAST(n AS BIGINT) AS n,
       round((SELECT count(*) FROM lab) / ((SELECT count(*) FROM c) * CAST(n AS DOUBLE)), 6) AS weight FROM c""")
def class_weights_q(spark, sf):
    """N / (2 n_c)."""
    w = SP.class_weights_balanced(labeled_ids(spark, sf).select("label"))
    return w.select("label", F.col("n").cast("long").alias("n"), _r6("weight"))


# --------------------------------------------------------------------------- scorers / metrics


@query("multinomial_nb", PRED_CTES + """
SELECT id AS doc_id, fold, label, round(p, 9) AS p FROM pred WHERE model = 'mnb'""")
def multinomial_nb_q(spark, sf):
    """F8: out-of-fold multinomial NB posteriors (class log prior + smoothed likelihood)."""
    return oof_predictions(spark, sf, ("mnb",)).select(
        F.col("id").alias("doc_id"), "fold", "label", F.round("p", 9).alias("p"))


@query("oof_predictions", PRED_CTES + "\nSELECT id AS doc_id, model, fold, label, round(p, 9) AS p FROM pred")
def oof_predictions_q(spark, sf):
    """The shared prediction table: three scorers, out of fold."""
    return oof_predictions(spark, sf).select(F.col("id").alias("doc_id"), "model", "fold", "label",
                                              F.round("p", 9).alias("p"))


@query("linear_scorer", "WITH " + D.fit_ctes("len2", 1, 4, 80000, 1, binary=True) + """,
cs AS (SELECT v.term, v.idx, sum(CASE WHEN t.label = 1 THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN t.label = 0 THEN 1 ELSE 0 END) AS neg
       FROM tf t JOIN vocab v ON t.term = v.term GROUP BY v.term, v.idx),
r AS (SELECT term, ln(((pos + 1.0) / sum(pos + 1.0) OVER ()) / ((neg + 1.0) / sum(neg + 1.0) OVER ())) AS r FROM cs),
b AS (SELECT ln(CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) / sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)) AS b FROM docs),
s AS (SELECT t.id, sum(r.r) AS s FROM tf t JOIN r ON t.term = r.term GROUP BY t.id),
z AS (SELECT d.id, (SELECT b FROM b) + coalesce(s.s, 0.0) AS z FROM docs d LEFT JOIN s ON d.id = s.id)
SELECT id AS doc_id, round(z, 6) AS logodds, round(1.0 / (1.0 + exp(-greatest(least(z, 700.0), -700.0))), 6) AS p FROM z""")
def linear_scorer_q(spark, sf):
    """F16: sigmoid(b + sum w x) with w = NB log-count ratios of 0/1 1-4-grams (80,000 terms)
    and b = ln(n_pos / n_neg), scored in sample."""
    from revlens.plans.q_features import fit
    docs, tf, _, v = fit(spark, sf, "len2", 1, 4, 80000, 1, binary=True)
    r = FT.nb_log_ratio(FT.nb_class_sums(tf, v, 80000)).select("idx", F.col("r").alias("w"))
    cnt = {row[0]: row[1] for row in tables.labeled(spark, sf).groupBy("label").count().collect()}
    import math
    b = math.log(cnt.get(1, 0) / cnt.get(0, 1)) if cnt.get(1) and cnt.get(0) else 0.0
    feat = FT.count_matrix(tf, v, 80000, binary=True)
    out = S.linear_scorer(feat, r, docs, b, "id", 80000)
    return out.select(F.col("id").alias("doc_id"), _r6("logodds"), _r6("p"))


@query("accuracy", PRED_CTES + ",\n" + auc_ctes("model") + "\nSELECT model, round(accuracy, 6) AS accuracy FROM acc")
def accuracy_q(spark, sf):
    """E5 per scorer (out of fold)."""
    return M.accuracy(oof_predictions(spark, sf)).select("model", _r6("accuracy"))


@query("roc_auc", PRED_CTES + ",\n" + auc_ctes("model") + "\nSELECT model, round(auc, 6) AS auc FROM auc")
def roc_auc_q(spark, sf):
    """Exact AUC with average ranks for ties, per scorer."""
    return M.roc_auc(oof_predictions(spark, sf), p_col="z").select("model", _r6("auc"))


_CV_SQL = PRED_CTES + ",\n" + auc_ctes("model, fold") + """,
per AS (SELECT a.model, a.fold, a.auc, c.accuracy FROM auc a JOIN acc c ON a.model = c.model AND a.fold = c.fold),
cv AS (SELECT model, avg(auc) AS mean_auc, stddev_pop(auc) AS std_auc, avg(accuracy) AS mean_accuracy,
              stddev_pop(accuracy) AS std_accuracy, count(*) AS n_folds FROM per GROUP BY model)"""


@query("cross_validate", _CV_SQL + """
SELECT model, round(mean_auc, 6) AS mean_auc, round(std_auc, 6) AS std_auc, round(mean_accuracy, 6) AS mean_accuracy,
       round(std_accuracy, 6) AS std_accuracy, CAST(n_folds AS BIGINT) AS n_folds FROM cv""")
def cross_validate_q(spark, sf):
    """Per-fold AUC / accuracy, mean and population std."""
    cv = M.cross_validate(oof_predictions(spark, sf), rank_col="z")
    return cv.select("model", _r6("mean_auc"), _r6("std_auc"), _r6("mean_accuracy"), _r6("std_accuracy"),
                     F.col("n_folds").cast("long").alias("n_folds"))


@query("select_best", _CV_SQL + """
SELECT model AS best, round(mean_auc, 6) AS best_mean_auc FROM cv ORDER BY mean_auc DESC, model LIMIT 1""")
def select_best_q(spark, sf):
    """Argmax of the CV metric."""
    best = M.select_best(M.cross_validate(oof_predictions(spark, sf), rank_col="z"))
    return best.select("best", _r6("best_mean_auc"))


@query("score_gate", PRED_CTES + ",\n" + auc_ctes("model") + """
SELECT model, round(auc, 6) AS auc,
       CASE WHEN auc >= 0.94 THEN 'excellent' WHEN auc >= 0.90 THEN 'good' ELSE 'below' END AS band FROM auc""")
def score_gate_q(spark, sf):
    """Band each scorer's AUC at 0.94 / 0.90."""
    a = M.roc_auc(oof_predictions(spark, sf), p_col="z")
    return a.select("model", _r6("auc"), M.score_gate("auc").alias("band"))


@query("threshold_label", PRED_CTES + """
SELECT id AS doc_id, model, CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS pred FROM pred""")
def threshold_label_q(spark, sf):
    """P > 0.5 -> 1."""
    return oof_predictions(spark, sf).select(F.col("id").alias("doc_id"), "model",
                                             M.threshold_label().alias("pred"))


@query("model_comparison_report", PRED_CTES + ",\n" + auc_ctes("model") + """
SELECT model, round(auc, 6) AS auc, round(auc - (SELECT auc FROM auc WHERE model = 'lex'), 6) AS delta_auc FROM auc""")
def model_comparison_q(spark, sf):
    """AUC per scorer and its gain over the lexicon baseline."""
    rep = M.model_comparison(M.roc_auc(oof_predictions(spark, sf), p_col="z"), "lex")
    return rep.select("model", _r6("auc"), _r6("delta_auc"))


@query("class_balance", PRED_CTES + """
SELECT model, CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS pred, CAST(count(*) AS BIGINT) AS n
FROM pred GROUP BY ALL""")
def class_balance_q(spark, sf):
    """Predicted positives / negatives per scorer."""
    return (oof_predictions(spark, sf).groupBy("model", M.threshold_label().alias("pred"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("prediction_range", PRED_CTES + """
SELECT model, round(min(p), 6) AS min_p, round(max(p), 6) AS max_p FROM pred GROUP BY model""")
def prediction_range_q(spark, sf):
    """A10: min / max of each prediction vector."""
    return oof_predictions(spark, sf).groupBy("model").agg(F.round(F.min("p"), 6).alias("min_p"),
                                                           F.round(F.max("p"), 6).alias("max_p"))


# --------------------------------------------------------------------------- ensembles

def _wvalues(weights):
    return "(VALUES " + ", ".join(f"('{k}', CAST({v!r} AS DOUBLE))" for k, v in weights.items()) + ") AS w(model, weight)"


_COMB_SQL = PRED_CTES + f""",
pw AS (SELECT p.*, w.weight FROM pred p JOIN {_wvalues(ENS_WEIGHTS)} ON p.model = w.model),
comb AS (SELECT id, avg(p) AS ens_mean, sum(weight * p) / sum(weight) AS ens_weighted, max(p) AS mx, min(p) AS mn,
                CASE WHEN min(p) <= 0 THEN 0.0 ELSE exp(avg(ln(CASE WHEN p > 0 THEN p END))) END AS ens_geometric,
                count(*) / sum(1.0 / (p + 0.001)) AS ens_harmonic, pow(avg(pow(p, 3.0)), 1.0 / 3.0) AS ens_power,
                CAST(median(p) AS DOUBLE) AS ens_median
         FROM pw GROUP BY id),
ens AS (SELECT id, ens_mean, ens_weighted, CASE WHEN ens_weighted > 0.5 THEN mx ELSE mn END AS ens_tjflexic,
               CASE WHEN ens_weighted > 0.6 THEN mx WHEN ens_weighted < 0.4 THEN mn ELSE ens_weighted END AS ens_aggressive,
               ens_geometric, ens_harmonic, ens_power, ens_median FROM comb)"""


def _combined(spark, sf):
    pred = oof_predictions(spark, sf)
    return G.combiners(pred, G.weights_table(spark, ENS_WEIGHTS))


for _col, _doc in [("ens_mean", "G1: mean over models"), ("ens_weighted", "G2: normalised weighted mean"),
                   ("ens_tjflexic", "G3: weighted base > 0.5 -> max over models, else min"),
                   ("ens_aggressive", "G4: > 0.6 -> max, < 0.4 -> min, else unchanged"),
                   ("ens_geometric", "G5: geometric mean (zero-safe)"),
                   ("ens_harmonic", "G6: n / sum 1/(p + 0.001)"), ("ens_power", "G7: power mean, exponent 3"),
                   ("ens_median", "G8: per-review median")]:
    def _mk(col, doc):
        @query(col, _COMB_SQL + f"\nSELECT id AS doc_id, round({col}, 6) AS p FROM ens")
        def _q(spark, sf):
            return _combined(spark, sf).select(F.col("id").alias("doc_id"), F.round(col, 6).alias("p"))
        _q.__doc__ = doc
        return _q
    _mk(_col, _doc)


@query("ens_rank_average", PRED_CTES + """,
r AS (SELECT model, z, count(*) AS cnt FROM pred GROUP BY model, z),
r2 AS (SELECT model, z, coalesce(sum(cnt) OVER (PARTITION BY model ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                        + (cnt + 1) / 2.0 AS avg_rank, sum(cnt) OVER (PARTITION BY model) AS n FROM r)
SELECT pred.id AS doc_id, round(avg(r2.avg_rank / r2.n), 6) AS p
FROM pred JOIN r2 ON pred.model = r2.model AND pred.z = r2.z GROUP BY pred.id""")
def ens_rank_average_q(spark, sf):
    """Average-tie rank per model, mean over models, scaled by the row count."""
    r = G.rank_average(oof_predictions(spark, sf), rank_col="z")
    return r.select(F.col("id").alias("doc_id"), F.round("ens_rank", 6).alias("p"))


@query("clip01", PRED_CTES + f""",
pw AS (SELECT p.*, w.weight FROM pred p JOIN {_wvalues(RAW_WEIGHTS)} ON p.model = w.model)
SELECT id AS doc_id, round(greatest(least(sum(weight * p), 1.0), 0.0), 6) AS p FROM pw GROUP BY id""")
def clip01_q(spark, sf):
    """Raw (not renormalised) weighted sum, clipped to [0, 1]."""
    c = G.combiners(oof_predictions(spark, sf), G.weights_table(spark, RAW_WEIGHTS), normalise=False)
    return c.select(F.col("id").alias("doc_id"), F.round(G.clip01(F.col("ens_weighted")), 6).alias("p"))


@query("meta_stack", _COMB_SQL + """,
lvl AS (SELECT id, model, p FROM pred
        UNION ALL SELECT id, 'ens_mean', ens_mean FROM ens
        UNION ALL SELECT id, 'ens_tjflexic', ens_tjflexic FROM ens
        UNION ALL SELECT id, 'ens_geometric', ens_geometric FROM ens)
SELECT id AS doc_id, round(avg(p), 6) AS p_mean,
       round(CASE WHEN avg(p) > 0.5 THEN max(p) ELSE min(p) END, 6) AS p_tjflexic FROM lvl GROUP BY id""")
def meta_stack_q(spark, sf):
    """Level-1 ensembles become inputs of a level-2 mean / TJflexic."""
    pred = oof_predictions(spark, sf)
    lvl1 = G.combiners(pred, G.weights_table(spark, ENS_WEIGHTS))
    stacked = pred.select("id", "model", "p").unionByName(
        G.as_models(lvl1, ["ens_mean", "ens_tjflexic", "ens_geometric"]))
    lvl2 = G.combiners(stacked)
    return lvl2.select(F.col("id").alias("doc_id"), F.round("ens_mean", 6).alias("p_mean"),
                       F.round("ens_tjflexic", 6).alias("p_tjflexic"))
