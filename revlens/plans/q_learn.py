"""Catalog: learners and learner compositions.

These are iterative fits: no SQL states their numbers. Keys whose fit has a slope that a second pass
measures return that with their ids (see fit_query); the others return their rows, and beside each a key
``<key>_check`` returns facts that a second, plain way computes from the fit and that a broken fit fails.
Training reviews = labeled; scored reviews = the documents without a label.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions import profiles as P
from revlens.functions import wordlists as W
from revlens.operators import boosting as B
from revlens.operators import ensemble as G
from revlens.operators import features as FT
from revlens.operators import learn as L
from revlens.operators import linear as N
from revlens.operators import metrics as M
from revlens.operators import scorers as S
from revlens.operators.embed import CENTROIDS
from revlens.operators.split import QUICK_ROWS, first_n_subset, stratified_holdout, stratified_kfold, with_class_weight
from revlens.plans.registry import query
from revlens.session import scratch_path, written
from revlens.sources import reviews_io as IO
from revlens.sources import tables


def train_test(spark, sf, profile):
    lab = FT.cleaned(FT.by_review(tables.labeled(spark, sf), "doc_id").select(
        F.col("doc_id").alias("id"), "label", P.profile_tokens(profile, "text").alias("words")))
    test = FT.by_review(tables.test_reviews(spark, sf), "doc_id").select(
        F.col("doc_id").alias("id"), P.profile_tokens(profile, "text").alias("words"))
    return lab, test


def tfidf_vectors(spark, sf, profile, lo, hi, mf, min_df=1, max_df=1.0):
    lab, test = train_test(spark, sf, profile)
    tr, te, width, vocab = L.tfidf_train_test(lab, test, lo, hi, mf, min_df, max_df)
    return L.vectors_for(tr, width, lab), L.vectors_for(te, width, test, keep=()), vocab


#: A fit counts as done where the objective's slope is below this share of its slope at zero weights.
SLOPE = 0.02

_TEST_SQL = "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"

#: Key -> (spark, sf) -> the fit's own rows (probabilities, scores, labels).
PREDICTIONS: dict = {}


def fit_query(key, flags=(), checks=("p_in_range",), models=()):
    """Register an iterative fit. Its rows can't be stated in SQL, so the query returns what must hold
    of them: the ids (and models) that are scored and, per row, checks of the values and of the fit.
    The function returns (rows, flags); PREDICTIONS[key] gives the rows themselves."""
    names = [*checks, *flags]
    sql = "SELECT doc_id" + (", model" if models else "") + "".join(f", TRUE AS {n}" for n in names) + f" FROM ({_TEST_SQL}) t"
    if models:
        sql += " CROSS JOIN (VALUES " + ", ".join(f"('{m}')" for m in models) + ") AS m(model)"

    def deco(fn):
        def run(spark, sf):
            rows, got = fn(spark, sf)
            return rows.select("doc_id", *(["model"] if models else []), *(CHECKS[c]().alias(c) for c in checks),
                               *(F.lit(bool(got[f])).alias(f) for f in flags))
        run.__doc__ = fn.__doc__
        PREDICTIONS[key] = lambda spark, sf: fn(spark, sf)[0]
        query(key, sql)(run)
        return fn
    return deco


def _in_unit(*cols):
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull() & ~F.isnan(c) & F.col(c).between(0.0, 1.0)
    return out


def _side(base, flexic="ens_tjflexic"):
    return F.when(F.col(base) > 0.5, F.col(flexic) >= F.col(base) - 1e-9).otherwise(F.col(flexic) <= F.col(base) + 1e-9)


#: Name -> the check of a row (columns can only be made once a session is there).
CHECKS = {
    "p_in_range": lambda: _in_unit("p"),
    "label_fits": lambda: F.col("sentiment") == (F.col("p") > 0.5).cast("int"),
    "score_finite": lambda: F.col("score").isNotNull() & ~F.isnan("score") & (F.abs("score") < 1e6),
    "means_in_range": lambda: _in_unit("ens_mean", "ens_tjflexic"),
    "side_of_mean": lambda: _side("ens_mean"),
    "all_in_range": lambda: _in_unit("ens_mean", "ens_weighted", "ens_tjflexic", "ens_aggressive"),
    "side_of_base": lambda: _side("ens_weighted"),
}


def _rows(df, *cols):
    return df.select(F.col("id").alias("doc_id"), *cols)


@fit_query("logistic_regression", ("at_optimum",))
def logistic_regression_q(spark, sf):
    """default cleaner, 1-5-gram TF-IDF (80,000), C = 10; test probabilities."""
    tr, te, _ = tfidf_vectors(spark, sf, "minstop_url", 1, 5, 80000)
    m = L.fit_lr(tr, 10.0)
    return _rows(L.p_positive(m.transform(te)), "p"), {"at_optimum": L.logistic_slope(m, tr, 1 / (10.0 * tr.count())) < SLOPE}


def _balanced_lr(spark, sf):
    tr, te, _ = tfidf_vectors(spark, sf, "contract_stop", 1, 2, 10000, 2, 0.85)
    m = L.fit_lr(tr, 1.0, max_iter=400, balanced=True, tol=1e-9)
    weighted = with_class_weight(tr, "label", "w")
    total = weighted.agg(F.sum("w")).first()[0]
    return L.p_positive(m.transform(te)), {"at_optimum": L.logistic_slope(m, weighted, 1 / total, "w") < SLOPE}


@fit_query("logistic_regression_balanced", ("at_optimum",))
def logistic_regression_balanced_q(spark, sf):
    """F2: contraction cleaner, 1-2-grams (10,000, min_df 2, max_df 0.85), C = 1, balanced."""
    out, flags = _balanced_lr(spark, sf)
    return _rows(out, "p"), flags


@fit_query("c_sweep", ("at_optimum",), models=("lr_c10", "lr_c50", "lr_c30"))
def c_sweep_q(spark, sf):
    """C in {10, 50, 30} over one written feature table -> (doc_id, model, p)."""
    tr, te, _ = tfidf_vectors(spark, sf, "minstop_url", 1, 5, 80000)
    slopes = []
    sweep = L.c_sweep(tr, te, [10.0, 50.0, 30.0], slopes=slopes)
    return _rows(sweep, "model", "p"), {"at_optimum": max(slopes) < SLOPE}


@fit_query("ridge_classifier", ("at_optimum",), ("score_finite",))
def ridge_classifier_q(spark, sf):
    """ridge on +-1 targets, alpha 1, balanced; decision scores of the test reviews."""
    tr, te, _ = tfidf_vectors(spark, sf, "contract_ca_stop", 1, 2, 15000, 2, 0.85)
    m = L.ridge_classifier(tr, 1.0)
    return _rows(m.transform(te), F.col("prediction").alias("score")), {"at_optimum": L.ridge_slope(m, tr, 1.0) < SLOPE}


@fit_query("sgd_log_loss", ("at_optimum",))
def sgd_log_loss_q(spark, sf):
    """logistic loss, l2 alpha 1e-4 (aggressive cleaner, 1-5-grams, 120,000)."""
    tr, te, _ = tfidf_vectors(spark, sf, "aggressive", 1, 5, 120000)
    m = L.sgd_log_loss(tr)
    return _rows(L.p_positive(m.transform(te)), "p"), {"at_optimum": L.logistic_slope(m, tr, 1e-4) < SLOPE}


def rows_query(key):
    """Register a fit that returns its own rows."""
    def deco(fn):
        PREDICTIONS[key] = fn
        return query(key)(fn)
    return deco


def _svc_tables(spark, sf):
    tr, te, _ = tfidf_vectors(spark, sf, "minstop", 1, 4, 50000)
    return tr, te


@rows_query("calibrated_linear_svc")
def calibrated_linear_svc_q(spark, sf):
    """linear SVC (squared hinge, C 0.5) with sigmoid calibration, 3 folds, mean of the folds."""
    return _rows(L.calibrated_many(*_svc_tables(spark, sf), {"svc_c05": 0.5}, "svc")[0], "model", "p")


#: C values of the calibrated logistic regressions.
CALIBRATED_C = (10.0, 30.0, 50.0, 100.0, 200.0)
_CALIBRATED = {f"cal_lr_c{c:g}": c for c in CALIBRATED_C}


def _cal_tables(spark, sf):
    tr, te, _ = tfidf_vectors(spark, sf, "padneg", 1, 5, 100000, 1, 0.95)
    return tr, te


@rows_query("calibrated_logistic")
def calibrated_logistic_q(spark, sf):
    """the same wrapper around LR, C in {10, 30, 50, 100, 200} (1-5-grams, 100,000, max_df 0.95)."""
    return _rows(L.calibrated_many(*_cal_tables(spark, sf), _CALIBRATED, "lr")[0], "model", "p")


def calibration_facts(out, cal, base):
    """A row per classifier: whether it is at its optimum, its sigmoid's gradient is zero and its slope positive, and
    the mean probabilities are those of a plain sum over its name's sigmoids."""
    z = None
    for m in cal.names():
        c = F.lit(cal.platts[m].a) * F.max(F.when(F.col("model") == m, F.col("score"))) + F.lit(cal.platts[m].b)
        one = F.when(F.lit(m).startswith(F.col("name")), F.lit(1.0) / (F.lit(1.0) + F.exp(-c))).otherwise(F.lit(0.0))
        z = one if z is None else z + one
    folds = len(cal.names()) // len({m.split("|")[0] for m in cal.names()})
    plain = cal.scores.withColumn("name", F.concat(F.substring_index("model", "|", 1), F.lit("|"))).groupBy("id", "name").agg((z / folds).alias("q"))
    met = out.withColumn("name", F.concat("model", F.lit("|"))).join(plain, ["id", "name"], "full")
    far = met.filter("p is null or q is null or abs(p - q) > 1e-9").count()
    rows = [(m.spec.name.split("|")[0], int(m.spec.name.split("|")[1]), m.slope < SLOPE and (base != "svc" or abs(m.gap) < SLOPE),
             cal.platts[m.spec.name].slope < 1e-4 and cal.platts[m.spec.name].a > 0, far == 0) for m in cal.models]
    return out.sparkSession.createDataFrame(rows, "model string, fold int, at_optimum boolean, sigmoid_fits boolean, mean_agrees boolean")


def _calibration_sql(names):
    return ("SELECT m AS model, CAST(f AS INTEGER) AS fold, TRUE AS at_optimum, TRUE AS sigmoid_fits, TRUE AS mean_agrees FROM (VALUES "
            + ", ".join(f"('{n}')" for n in names) + ") AS t(m), range(3) r(f)")


@query("calibrated_linear_svc_check", _calibration_sql(["svc_c05"]))
def calibrated_linear_svc_check_q(spark, sf):
    """The facts of F6: slope and dual gap of the squared hinge, stationary sigmoids, means."""
    return calibration_facts(*L.calibrated_many(*_svc_tables(spark, sf), {"svc_c05": 0.5}, "svc"), "svc")


@query("calibrated_logistic_check", _calibration_sql(_CALIBRATED))
def calibrated_logistic_check_q(spark, sf):
    """The facts of F7."""
    return calibration_facts(*L.calibrated_many(*_cal_tables(spark, sf), _CALIBRATED, "lr"), "lr")


def _nb_blocks(spark, sf, profile, lo, hi, mf, clipped, reviews=None, counted=None):
    lab, test = reviews or train_test(spark, sf, profile)
    tr, te, width, tf, vocab = L.binary_train_test(lab, test, lo, hi, mf, counted=counted)
    sums = FT.nb_class_sums(tf, vocab, mf)
    r = FT.nb_log_ratio_clipped(sums) if clipped else FT.nb_log_ratio(sums)
    return lab, test, FT.nb_weighted(tr, r, max_features=mf), FT.nb_weighted(te, r, max_features=mf), width


@fit_query("nbsvm", ("at_optimum",))
def nbsvm_q(spark, sf):
    """LR (C = 1) on clipped NB-weighted 0/1 1-5-grams (70,000)."""
    lab, test, tr, te, width = _nb_blocks(spark, sf, "minstop", 1, 5, 70000, True)
    train = L.vectors_for(tr, width, lab)
    m = L.fit_lr(train, 1.0)
    out = L.p_positive(m.transform(L.vectors_for(te, width, test, keep=())))
    return _rows(out, "p"), {"at_optimum": L.logistic_slope(m, train, 1 / train.count()) < SLOPE}


@fit_query("nbsvm_tfidf", ("at_optimum",), models=("nbsvm_c10", "nbsvm_c30", "nbsvm_c50"))
def nbsvm_tfidf_q(spark, sf):
    """NB-weighted 1-4-grams (80,000) stacked with 1-5-gram TF-IDF (60,000), C in {10, 30, 50}."""
    lab, test, tr_nb, te_nb, w1 = _nb_blocks(spark, sf, "len2", 1, 4, 80000, False)
    tr_t, te_t, w2, _ = L.tfidf_train_test(lab, test, 1, 5, 60000)
    tr = FT.hstack([(tr_nb.select("id", "idx", "value"), w1), (tr_t, w2)])
    te = FT.hstack([(te_nb.select("id", "idx", "value"), w1), (te_t, w2)])
    sweep = L.c_sweep(L.vectors_for(tr, w1 + w2, lab), L.vectors_for(te, w1 + w2, test, keep=()),
                      [10.0, 30.0, 50.0], "nbsvm_c", slopes=(slopes := []))
    return _rows(sweep, "model", "p"), {"at_optimum": max(slopes) < SLOPE}


def _bow_vectors(spark, sf, mf=5000):
    lab, test = train_test(spark, sf, "letters")
    n = lab.count()
    vocab, tf = FT.fit_counts(lab, n, 1, 1, mf, 2)
    width = vocab.count()
    ttf = FT.known_counts(test, vocab, 1, 1, mf)
    tr = L.vectors_for(FT.count_matrix(tf, vocab, mf), width, lab)
    te = L.vectors_for(FT.count_matrix(ttf, vocab, mf), width, test, keep=())
    return tr, te, vocab


def _labels(df):
    return _rows(L.p_positive(df), F.col("prediction").cast("int").alias("sentiment"), "p")


@rows_query("random_forest")
def random_forest_q(spark, sf):
    """100 trees, depth 10, on unigram counts (5,000, min_df 2); hard labels + probability."""
    tr, te, _ = _bow_vectors(spark, sf)
    return _labels(L.random_forest(tr, 100, 10).transform(te))


#: A model that knows nothing ranks held-out reviews at 0.5.
BETTER_AUC = 0.55


@query("random_forest_check", "SELECT TRUE AS ranks_held_out, TRUE AS label_fits, count(*) AS n_scored FROM (" + _TEST_SQL + ") t")
def random_forest_check_q(spark, sf):
    """F11 on four fifths of the labeled reviews ranks the rest better than chance by a margin; the labels of the test
    reviews are the probabilities cut at a half."""
    tr, te, _ = _bow_vectors(spark, sf)
    split = stratified_holdout(tr.select("id", "label"), 0.2, "label", "id").select("id", "is_valid")
    both = written(tr.join(split, "id"), "held-out")
    model = L.random_forest(both.filter("is_valid = 0"), 100, 10)
    auc = M.auc_by_windows(L.p_positive(model.transform(both.filter("is_valid = 1"))).withColumn("model", F.lit("rf"))).first()["auc"]
    rows = _labels(model.transform(te)).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("sentiment") != (F.col("p") > 0.5).cast("int")).alias("bad")).first()
    return spark.range(1).select(F.lit(auc > BETTER_AUC).alias("ranks_held_out"), F.lit(rows["bad"] == 0).alias("label_fits"),
                                 F.lit(rows["n"]).cast("long").alias("n_scored"))


@rows_query("top_feature_importances")
def top_feature_importances_q(spark, sf):
    """The 20 most important words of the forest and their importances."""
    tr, _, vocab = _bow_vectors(spark, sf)
    return L.top_feature_importances(L.random_forest(tr, 100, 10), vocab, 20).select("term", "importance")


#: A word that no review holds.
PLANTED = "zzplantedzz"


@query("top_feature_importances_check", f"SELECT '{PLANTED}' AS term, TRUE AS first, TRUE AS sums_to_one, TRUE AS descending")
def top_feature_importances_check_q(spark, sf):
    """D23 on the same reviews with a word planted in the positive ones: it comes first, and all importances sum to one."""
    lab, _ = train_test(spark, sf, "letters")
    lab = lab.withColumn("words", F.when(F.col("label") == 1, F.concat("words", F.array(F.lit(PLANTED)))).otherwise(F.col("words")))
    vocab, tf = FT.fit_counts(lab, lab.count(), 1, 1, 5000, 2)
    model = L.random_forest(L.vectors_for(FT.count_matrix(tf, vocab, 5000), vocab.count(), lab), 100, 10)
    top = [tuple(r) for r in L.top_feature_importances(model, vocab, 20).select("term", "importance").collect()]
    own = [v for _, v in top]
    return spark.range(1).select(F.lit(PLANTED).alias("term"), F.lit(top[0][0] == PLANTED).alias("first"),
                                 F.lit(abs(float(model.featureImportances.values.sum()) - 1.0) < 1e-9).alias("sums_to_one"),
                                 F.lit(own == sorted(own, reverse=True)).alias("descending"))


#: Dimensions of the trained vectors in the chains below.
VECTOR_SIZE = 300


def _trained_vectors(spark, sf, vector_size=VECTOR_SIZE):
    """(word, vector) of skip-gram trained on the labeled and unlabeled sentences."""
    from revlens.operators import embed as EM
    from revlens.plans.q_embed import trained_model
    return written(EM.model_vectors(trained_model(spark, sf, vector_size)), "trained-vectors")


def _mean_vectors(spark, sf, vector_size=VECTOR_SIZE):
    """D14 -> D17: mean trained vectors of the training and test reviews."""
    from pyspark.ml.functions import array_to_vector
    from revlens.operators import embed as EM
    lab, test = train_test(spark, sf, "letters")
    vec = _trained_vectors(spark, sf, vector_size)
    mk = lambda d: EM.mean_word_vector(d, vec, vector_size).join(d.drop("words"), "id")
    tr = mk(lab).select("id", F.col("label").cast("double").alias("label"), array_to_vector("vector").alias("features"))
    te = mk(test).select("id", array_to_vector("vector").alias("features"))
    return tr, te


def _dense(vectors):
    """Long (id, idx, value) of a table of vectors in full."""
    from pyspark.ml.functions import vector_to_array
    return vectors.select("id", F.posexplode(vector_to_array("features")).alias("idx", "value")).filter("value != 0")


#: Depth 10, no row or column sampling; F13: the reviewed script's regularised trees.
TREES = B.Params(rounds=200, depth=10, step=0.1, row_share=1.0, col_share=1.0, min_child=1.0, min_gain=0.0, l1=0.0, l2=1.0)
FUSED_TREES = B.Params(rounds=300, depth=6, step=0.05, row_share=0.8, col_share=0.8, min_child=5.0, min_gain=0.1, l1=0.1, l2=1.0)


@rows_query("boosted_trees")
def boosted_trees_q(spark, sf, params=TREES):
    """second-order boosted trees (200 rounds, depth 10, step 0.1, l2 1) on mean trained word vectors (D14 -> D17)."""
    tr, te = _mean_vectors(spark, sf)
    tr = written(tr, "vectors")
    m = B.fit_boosted(_dense(tr), tr.select("id", "label"), VECTOR_SIZE, params)
    p = B.score_boosted(m, _dense(te), te.select("id"))
    return _rows(p, (F.col("p") > 0.5).cast("int").alias("sentiment"), "p")


def _fused_tables(spark, sf, k, vector_size):
    """F13's features: (train, labeled ids with folds, test, test ids, width)."""
    from revlens.operators import embed as EM
    lab, test = train_test(spark, sf, "letters")
    vocab, tf = FT.fit_counts(lab, lab.count(), 1, 2, 8000, 2, 0.8)
    w1 = vocab.count()
    vec = _trained_vectors(spark, sf, vector_size)
    w2c = written(EM.kmeans_centroids(vec, k).assign(vec).select("word", "centroid"), "centroids")

    def blocks(d, tfd):
        bow = FT.count_matrix(tfd, vocab, 8000).select("id", "idx", F.col("value").cast("double").alias("value"))
        mv = EM.mean_word_vector(d, vec, vector_size).select("id", F.posexplode("vector").alias("idx", "value")) \
            .filter(F.col("value") != 0)
        hist = EM.centroid_histogram(d, w2c).select("id", F.col("centroid").alias("idx"), F.col("share").alias("value"))
        return written(FT.hstack([(bow, w1), (mv, vector_size), (hist, k)]), "fused")

    folds = written(stratified_kfold(lab.select("id", "label"), 5, "label", "id").select("id", "label", "fold"), "folds")
    return blocks(lab, tf), folds, blocks(test, FT.known_counts(test, vocab, 1, 2, 8000)), test.select("id"), w1 + vector_size + k


def _fused(spark, sf, params, k, vector_size):
    """The model of F13 with a model per fold left out, its out-of-fold rows, and the test reviews' rows."""
    train, folds, test, ids, width = _fused_tables(spark, sf, k, vector_size)
    model = B.fit_boosted(train, folds, width, params, folds=5)
    own = B.score_boosted(model, train, folds.select("id")).join(folds, "id").filter("model = fold")
    out = written(own.select("id", "fold", F.col("label").cast("int").alias("label"), "p"), "out-of-fold")
    rest = B.score_boosted(model, test, ids).filter(F.col("model") == 5).select("id", "p")
    return model, out, rest


@rows_query("fused_boosted_trees")
def fused_boosted_trees_q(spark, sf, k=CENTROIDS, vector_size=VECTOR_SIZE, params=FUSED_TREES):
    """1-2-gram counts (8,000, min_df 2, max_df 0.8) + mean trained word vector + histogram over k trained
    centroids (D14 -> D17, D18 -> D20) -> second-order boosted trees (300 rounds, depth 6, step 0.05, row and column
    sampling 0.8, leaf l1 0.1 and l2 1, minimum gain 0.1), five folds and the whole in the same passes. Labeled reviews
    have their out-of-fold probability, fold, the fold's AUC and the mean over the folds; test reviews the
    whole model's probability; both a hard label."""
    _, out, rest = _fused(spark, sf, params, k, vector_size)
    auc = M.roc_auc(out.withColumn("model", F.lit("fused")), ("model", "fold")).select("fold", F.col("auc").alias("fold_auc"))
    auc = written(auc, "fold-scores")  # five rows
    mean = auc.agg(F.avg("fold_auc")).first()[0]
    cv = out.join(F.broadcast(auc), "fold").select("id", "p", "fold", "fold_auc", F.lit(mean).cast("double").alias("mean_auc"))
    test = rest.select("id", "p", F.lit(None).cast("int").alias("fold"), F.lit(None).cast("double").alias("fold_auc"),
                       F.lit(None).cast("double").alias("mean_auc"))
    return _rows(cv.unionByName(test), "fold", (F.col("p") > 0.5).cast("int").alias("sentiment"), "p", "fold_auc", "mean_auc")


#: Rounds and dimensions of the checks of the trees.
CHECK_ROUNDS, CHECK_VECTOR = 12, 50


@query("fused_boosted_trees_check", "SELECT TRUE AS ranks_out_of_fold, TRUE AS folds_whole, TRUE AS root_split_agrees, "
                                    "count(*) AS n_labeled FROM documents d JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def fused_boosted_trees_check_q(spark, sf, k=CENTROIDS):
    """F13 with 12 rounds and 50 dimensions: out-of-fold AUC above chance by a margin, every labeled review scored once, and
    the first tree's first split found again by plain aggregates over the values."""
    from dataclasses import replace
    params = replace(FUSED_TREES, rounds=CHECK_ROUNDS, step=0.3, row_share=1.0, col_share=1.0)
    train, folds, _, _, width = _fused_tables(spark, sf, k, CHECK_VECTOR)
    model = B.fit_boosted(train, folds, width, params, folds=5)
    own = written(B.score_boosted(model, train, folds.select("id")).join(folds, "id").filter("model = fold"), "out-of-fold")
    auc = M.auc_by_windows(own.withColumn("model", F.lit("fused")), ("model",)).first()["auc"]
    n = own.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("d")).first()
    return spark.range(1).select(F.lit(auc > BETTER_AUC).alias("ranks_out_of_fold"), F.lit(n["n"] == n["d"]).alias("folds_whole"),
                                 F.lit(plain_root(train, folds, model, params)).alias("root_split_agrees"), F.lit(n["n"]).cast("long").alias("n_labeled"))


def plain_root(train, docs, model, params):
    """Whether no split of all rows gains more than the first one of the whole model's first tree: all splits at the
    same cuts, by one aggregate per (feature, cut) over the values that are there."""
    rows = docs.agg(F.sum(F.lit(0.5) - F.col("label")).alias("g"), (F.count(F.lit(1)) * 0.25).alias("h")).first()
    cuts = train.sparkSession.createDataFrame([(f, i, float(c)) for f, own in enumerate(model.cuts.cuts) for i, c in enumerate(own)],
                                              "idx int, bin int, cut double")
    own = train.filter("value != 0").join(docs.select("id", "label"), "id").withColumn("g", F.lit(0.5) - F.col("label"))
    per = own.groupBy("idx").agg(F.sum("g").alias("tg"), (F.count(F.lit(1)) * 0.25).alias("th"))
    low = own.groupBy("idx", "value").agg(F.sum("g").alias("g"), (F.count(F.lit(1)) * 0.25).alias("h")).join(cuts, "idx").filter(
        F.col("value") <= F.col("cut")).groupBy("idx", "bin").agg(F.sum("g").alias("lg"), F.sum("h").alias("lh"))
    all_ = cuts.join(per, "idx").join(low, ["idx", "bin"], "left").fillna(0.0, ["lg", "lh"])
    zero = F.col("cut") >= 0  # rows without a value are zero
    left_g = F.col("lg") + F.when(zero, F.lit(rows["g"]) - F.col("tg")).otherwise(0.0)
    left_h = F.col("lh") + F.when(zero, F.lit(rows["h"]) - F.col("th")).otherwise(0.0)
    worth = lambda g, h: F.pow(F.greatest(F.abs(g) - params.l1, F.lit(0.0)), 2) / (h + params.l2)
    all_ = all_.select("idx", "bin", left_g.alias("a"), left_h.alias("b")).filter(
        (F.col("b") >= params.min_child) & (F.lit(rows["h"]) - F.col("b") >= params.min_child))
    gain = worth(F.col("a"), F.col("b")) + worth(F.lit(rows["g"]) - F.col("a"), F.lit(rows["h"]) - F.col("b")) - worth(F.lit(rows["g"]), F.lit(rows["h"]))
    all_ = written(all_.withColumn("gain", gain), "plain-splits")
    best = all_.agg(F.max("gain")).first()[0]
    tree = model.trees[-1][0]
    if best is None or best <= 1e-12:
        return bool(tree.feature[0] < 0)
    mine = all_.filter((F.col("idx") == int(tree.feature[0])) & (F.col("bin") == int(tree.cut[0]))).first()
    return mine is not None and abs(mine["gain"] - best) <= 1e-6 * max(1.0, best)


def _lexicon_members(spark, sf):
    lab, test = train_test(spark, sf, "len2")
    tr_t, te_t, w, _ = L.tfidf_train_test(lab, test, 1, 5, 80000)
    lexcols = ["pos", "neg", "negation", "eff_pos", "eff_neg"]

    def lex(d):
        return FT.dense_block(d.select("id", *FT.lexicon_counts(F.col("words"), W.LEXICON_POSITIVE,
                                                                W.LEXICON_NEGATIVE, W.LEXICON_NEGATION)), lexcols)
    tr = L.vectors_for(FT.hstack([(tr_t, w), (lex(lab), 5)]), w + 5, lab)
    te = L.vectors_for(FT.hstack([(te_t, w), (lex(test), 5)]), w + 5, test, keep=())
    return L.c_sweep(tr, te, [10.0, 30.0, 50.0])


def _word_char_members(spark, sf):
    lab, test = train_test(spark, sf, "articles")
    tr_w, te_w, w1, _ = L.tfidf_train_test(lab, test, 1, 5, 80000, 2)
    tr_c, te_c, w2, _ = L.tfidf_train_test(lab, test, 3, 6, 50000, 2, analyzer="char_wb")
    tr = L.vectors_for(FT.hstack([(tr_w, w1), (tr_c, w2)]), w1 + w2, lab)
    te = L.vectors_for(FT.hstack([(te_w, w1), (te_c, w2)]), w1 + w2, test, keep=())
    return L.c_sweep(tr, te, [10.0, 30.0, 50.0])


@rows_query("lexicon_tfidf_sweep")
def lexicon_tfidf_sweep_q(spark, sf):
    """1-5-gram TF-IDF (80,000) + five lexicon columns -> LR C in {10, 30, 50} -> mean and TJflexic."""
    return _rows(G.combiners(_lexicon_members(spark, sf)), "ens_mean", "ens_tjflexic")


@rows_query("word_char_sweep")
def word_char_sweep_q(spark, sf):
    """word 1-5-gram TF-IDF (80,000, min_df 2) + char_wb 3-6 TF-IDF (50,000, min_df 2) -> LR sweep."""
    return _rows(G.combiners(_word_char_members(spark, sf)), "ens_mean", "ens_tjflexic")


def ensemble_facts(members, ens, weights):
    """Per review whether every model scored it once with a probability, the models differ, and mean, weighted mean,
    TJflexic and aggressive value (those that ``ens`` has) are those of plain arithmetic over its members' values."""
    names = sorted(weights)
    total = sum(weights.values())
    wide = members.groupBy("id").pivot("model", names).agg(F.first("p"), F.count("p"))
    p = {n: F.col(f"`{n}_first(p)`") for n in names}
    whole = F.lit(True)
    for n in names:
        whole = whole & (F.coalesce(F.col(f"`{n}_count(p)`"), F.lit(0)) == 1) & p[n].between(0.0, 1.0) & ~F.isnan(p[n])
    mean = sum(p.values()) / len(names)
    weighted = sum(p[n] * weights[n] for n in names) / total
    top, low = F.greatest(*p.values()), F.least(*p.values())
    base = weighted
    want = {"ens_mean": mean, "ens_weighted": weighted, "ens_tjflexic": F.when(base > 0.5, top).otherwise(low),
            "ens_aggressive": F.when(base > 0.6, top).when(base < 0.4, low).otherwise(base)}
    met = ens.join(wide, "id", "full")
    near = F.lit(True)
    for c, x in want.items():
        if c in ens.columns:
            # at the edge of a rule rounding decides
            edge = (F.abs(base - 0.5) < 1e-9) | (F.abs(base - 0.6) < 1e-9) | (F.abs(base - 0.4) < 1e-9)
            near = near & (edge | (F.abs(F.col(c) - x) <= 1e-9))
    return _rows(met, F.coalesce(whole, F.lit(False)).alias("members_whole"), F.coalesce(near, F.lit(False)).alias("agrees"))


_ENSEMBLE_SQL = "SELECT doc_id, TRUE AS members_whole, TRUE AS agrees FROM (" + _TEST_SQL + ") t"
_SWEEP_WEIGHTS = {f"lr_c{c:g}": 1.0 for c in (10.0, 30.0, 50.0)}


@query("lexicon_tfidf_sweep_check", _ENSEMBLE_SQL)
def lexicon_tfidf_sweep_check_q(spark, sf):
    """F14's ensemble against plain arithmetic over its three members."""
    members = written(_lexicon_members(spark, sf), "members")
    return ensemble_facts(members, G.combiners(members).select("id", "ens_mean", "ens_tjflexic"), _SWEEP_WEIGHTS)


@query("word_char_sweep_check", _ENSEMBLE_SQL)
def word_char_sweep_check_q(spark, sf):
    """The same of the word and character mix."""
    members = written(_word_char_members(spark, sf), "members")
    return ensemble_facts(members, G.combiners(members).select("id", "ens_mean", "ens_tjflexic"), _SWEEP_WEIGHTS)


@fit_query("refit_and_predict", ("at_optimum",), ("p_in_range", "label_fits"))
def refit_and_predict_q(spark, sf):
    """refit on every labeled review, predict the test reviews (label and probability)."""
    out, flags = _balanced_lr(spark, sf)
    return _rows(out, F.col("prediction").cast("int").alias("sentiment"), "p"), flags


#: E8's configurations: n-gram range, features, C.
GRID = {f"cfg{i}_n{hi}_f{mf}_c{C:g}": ((lo, hi), mf, C) for i, ((lo, hi), mf, C) in enumerate([
    ((1, 4), 50000, 10.0), ((1, 4), 60000, 20.0), ((1, 5), 60000, 10.0),
    ((1, 5), 70000, 30.0), ((1, 5), 80000, 50.0), ((1, 6), 80000, 30.0)])}


def _cv_scores(folded, k, name, score):
    """(id, model, fold, label, p) of each fold by a model of the others; ``score(train, rest)`` adds p."""
    out = None
    for f in range(k):
        p = score(folded.filter(F.col("fold") != f), folded.filter(F.col("fold") == f)).select(
            "id", F.lit(name).alias("model"), "fold", F.col("label").cast("int").alias("label"), "p")
        out = p if out is None else out.unionByName(p)
    return out


def _fold_scores(blocks, specs, widths):
    """Out-of-fold scores (id, model, fold, label, p) of logistic models named model|fold, all fitted in the same passes,
    and the models."""
    models = N.fit_many(blocks, specs, widths)
    scores = N.score_many(blocks, models, held_out=True)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("score")))
    return written(scores.select("id", F.substring_index("model", "|", 1).alias("model"), "fold", "label", p.alias("p")), "fold-scores"), models


def _lr_scores(C, balanced=False):
    return lambda train, rest: L.p_positive(L.fit_lr(train, C, balanced=balanced).transform(rest))


def _ridge_scores(train, rest):
    """Ridge has no probability: its raw score is what ranks."""
    return L.ridge_classifier(train, 1.0).transform(rest).withColumn("p", F.col("prediction"))


#: C values of the flagship model.
FLAGSHIP_C = (10.0, 50.0, 30.0)


@fit_query("flagship_chain", ("cv_in_range", "same_in_file"), ("means_in_range", "side_of_mean"))
def flagship_chain_q(spark, sf, k=5):
    """The flagship model end to end: 1-5-gram TF-IDF (80,000), k-fold AUC for three C, one model per C on
    all labeled reviews, mean and TJflexic of their probabilities, submission file written and read back."""
    lab, test = train_test(spark, sf, "minstop_url")
    tr, te, width, _ = L.tfidf_train_test(lab, test, 1, 5, 80000)
    train, rest = L.vectors_for(tr, width, lab), L.vectors_for(te, width, test, keep=())
    cv = _fold_scores(N.packed_vectors([L.with_folds(train, k)]),
                      [N.Spec(f"lr_c{C:g}|{f}", C, 0, f) for C in FLAGSHIP_C for f in range(k)], [width])[0]
    auc = M.cross_validate(cv).select("mean_auc").collect()  # a row per C
    ens = written(G.combiners(L.c_sweep(train, rest, FLAGSHIP_C)).select("id", "ens_mean", "ens_tjflexic"), "flagship")
    path = scratch_path(spark, "submission")
    IO.write_submission(ens, path, "id", "ens_tjflexic")
    back = IO.read_submission(spark, path)
    differ = ens.select(F.col("id").cast("string").alias("id"), "ens_tjflexic").join(back, "id", "full").filter(
        "sentiment is null or ens_tjflexic is null or abs(sentiment - ens_tjflexic) > 1e-12")
    return _rows(ens, "ens_mean", "ens_tjflexic"), {
        "cv_in_range": len(auc) == len(FLAGSHIP_C) and all(0.0 <= r[0] <= 1.0 for r in auc), "same_in_file": differ.isEmpty()}


@query("holdout_scores", "SELECT m AS model, TRUE AS auc_in_range, TRUE AS accuracy_in_range, TRUE AS beats_chance FROM "
                         "(VALUES ('lr_balanced'), ('ridge_balanced')) AS t(m)")
def holdout_scores_q(spark, sf):
    """Hold-out evaluation (E2 -> F2, F4 -> E5, E6): 80/20 within each class, AUC by raw score for ridge."""
    s = holdout_scores(spark, sf)
    return s.select("model", F.col("auc").between(0.0, 1.0).alias("auc_in_range"),
                    F.col("accuracy").between(0.0, 1.0).alias("accuracy_in_range"),
                    (F.col("auc") > 0.5).alias("beats_chance"))


def holdout_scores(spark, sf):
    """(model, auc, accuracy) on the held-out fifth of the labeled reviews; ridge is cut at score 0."""
    lab, _ = train_test(spark, sf, "contract_ca_stop")
    tr, _, width, _ = L.tfidf_train_test(lab, None, 1, 2, 15000, 2, 0.85)
    vec = L.vectors_for(tr, width, lab)
    split = stratified_holdout(vec.select("id", "label"), 0.2, "label", "id").select("id", "is_valid")
    vec = written(vec.join(split, "id"), "held-out")
    fit, rest = vec.filter("is_valid = 0"), vec.filter("is_valid = 1")
    preds = [(n, f(fit, rest).select("id", F.lit(n).alias("model"), F.col("label").cast("int").alias("label"), "p"), cut)
             for n, f, cut in (("lr_balanced", _lr_scores(1.0, True), 0.5), ("ridge_balanced", _ridge_scores, 0.0))]
    out = None
    for _, p, cut in preds:
        one = M.roc_auc(p).join(M.accuracy(p, threshold=cut), "model")
        out = one if out is None else out.unionByName(one)
    return out


def _winner_scores(spark, sf, k):
    lab, test = train_test(spark, sf, "contract_ca_stop")
    tr, te, width, _ = L.tfidf_train_test(lab, test, 1, 2, 15000, 2, 0.85)
    train, rest = L.vectors_for(tr, width, lab), L.vectors_for(te, width, test, keep=())
    folded = L.with_folds(train, k)
    scorers = {"lr_balanced": _lr_scores(1.0, True), "ridge_balanced": _ridge_scores}
    cv = None
    for name, score in scorers.items():
        one = _cv_scores(folded, k, name, score)
        cv = one if cv is None else cv.unionByName(one)
    return train, rest, scorers, written(cv, "fold-scores")


@rows_query("cv_winner_refit")
def cv_winner_refit_q(spark, sf, k=5):
    """k-fold AUC of balanced logistic regression against ridge (by raw score), then the winner fitted on
    every labeled review and the test reviews scored: the winner's name and its scores."""
    train, rest, scorers, cv = _winner_scores(spark, sf, k)
    best = M.select_best(M.cross_validate(cv)).first()["best"]
    return _rows(scorers[best](train, rest), F.lit(best).alias("winner"), F.col("p").alias("score"))


def _auc_facts(cv, mean_auc):
    """(model, auc_agrees): the mean AUC of every model of fold scores (model, fold, label, p) by windows over distinct
    values, against ``mean_auc`` (model, mean_auc)."""
    plain = M.auc_by_windows(cv, ("model", "fold")).groupBy("model").agg(F.avg("auc").alias("plain"))
    return mean_auc.join(plain, "model", "full").select("model", F.coalesce(F.abs(F.col("plain") - F.col("mean_auc")) < 1e-9, F.lit(False)).alias("auc_agrees"), "plain")


@query("cv_winner_refit_check", "SELECT m AS model, TRUE AS auc_agrees, TRUE AS above_chance, n AS n_scored FROM "
       "(VALUES ('lr_balanced'), ('ridge_balanced')) AS t(m), (SELECT count(*) AS n FROM documents d JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id) c")
def cv_winner_refit_check_q(spark, sf, k=5):
    """The fold AUC behind the choice, computed another way, and how many reviews each model scored out of fold."""
    _, _, _, cv = _winner_scores(spark, sf, k)
    facts = _auc_facts(cv, M.cross_validate(cv).select("model", "mean_auc"))
    n = cv.groupBy("model").agg(F.countDistinct("id").alias("n_scored"))
    return facts.join(n, "model").select("model", "auc_agrees", (F.col("plain") > 0.5).alias("above_chance"), "n_scored")


def grid_fit(docs, configs, k, min_df=1, max_df=1.0):
    """Out-of-fold scores (id, model, fold, label, p) and the models of every configuration
    name -> (lo, hi, max_features, C): all configurations and folds are fitted in the same passes."""
    n = docs.count()
    folds = written(stratified_kfold(docs.select("id", "label"), k, "label", "id").select("id", "label", "fold"), "folds")
    if min_df == 1 and max_df == 1.0:
        feats = FT.gram_lattice(docs, None, n, {m: c[:3] for m, c in configs.items()})
    else:
        feats = {m: (t[0], None, t[2]) for m, c in configs.items() for t in [L.tfidf_train_test(docs, None, *c[:3], min_df, max_df)]}
    blocks = N.packed([(feats[m][0], folds) for m in configs])
    specs = [N.Spec(f"{m}|{f}", configs[m][3], t, f) for t, m in enumerate(configs) for f in range(k)]
    return _fold_scores(blocks, specs, [feats[m][2] for m in configs])


def _first_best(cv, names):
    """Configuration with the highest mean AUC; of equal ones the first (a strict comparison in order)."""
    got = {r["model"]: r["mean_auc"] for r in cv.collect()}  # a row per configuration
    return max(names, key=lambda m: (got[m], -list(names).index(m)))


_GRID = {m: (lo, hi, mf, C) for m, ((lo, hi), mf, C) in GRID.items()}


def _quick(spark, sf, fit_rows):
    lab, _ = train_test(spark, sf, "minstop")
    return written(first_n_subset(lab, fit_rows, "id"), "quick").repartition("id")


def _grid_rows(cv, names):
    best = _first_best(cv, names)
    return cv.select("model", "mean_auc", "std_auc", "n_folds", (F.col("model") == best).alias("best"))


@rows_query("grid_search")
def grid_search_q(spark, sf, fit_rows=QUICK_ROWS):
    """Six (n-gram, features, C) configurations x 3 folds on the leading ``fit_rows`` labeled reviews (the
    quick-search bound): mean and deviation of the AUC, and which configuration wins (the first of equal ones)."""
    scores, _ = grid_fit(_quick(spark, sf, fit_rows), _GRID, 3)
    return _grid_rows(written(M.cross_validate(scores), "grid"), _GRID)


def _grid_sql(names, n):
    return ("SELECT m AS model, TRUE AS auc_agrees, TRUE AS at_optimum, TRUE AS above_chance, n AS n_scored FROM (VALUES "
            + ", ".join(f"('{m}')" for m in names) + f") AS t(m), (SELECT {n} AS n FROM documents d JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id) c")


def _grid_facts(scores, models):
    slope = {}
    for m in models:
        slope.setdefault(m.spec.name.split("|")[0], []).append(m.slope)
    good = scores.sparkSession.createDataFrame([(m, max(x) < SLOPE) for m, x in slope.items()], "model string, at_optimum boolean")
    facts = _auc_facts(scores, M.cross_validate(scores).select("model", "mean_auc"))
    n = scores.groupBy("model").agg(F.countDistinct("id").alias("n_scored"))
    return facts.join(n, "model").join(F.broadcast(good), "model").select(
        "model", "auc_agrees", "at_optimum", (F.col("plain") > 0.5).alias("above_chance"), "n_scored")


@query("grid_search_check", _grid_sql(GRID, f"least({QUICK_ROWS}, count(*))"))
def grid_search_check_q(spark, sf, fit_rows=QUICK_ROWS):
    """Each configuration's mean AUC another way, the slopes of its fits, and the reviews it scored out of fold."""
    return _grid_facts(*grid_fit(_quick(spark, sf, fit_rows), _GRID, 3))


@rows_query("grid_winner_refit")
def grid_winner_refit_q(spark, sf, fit_rows=QUICK_ROWS):
    """E8's winner on every labeled review with C, 2 C and 3 C: mean and TJflexic of the test reviews."""
    scores, _ = grid_fit(_quick(spark, sf, fit_rows), _GRID, 3)
    best = _first_best(M.cross_validate(scores), _GRID)
    lo, hi, mf, C = _GRID[best]
    tr, te, _ = tfidf_vectors(spark, sf, "minstop", lo, hi, mf)
    ens = G.combiners(L.c_sweep(tr, te, [C, 2 * C, 3 * C]))
    return _rows(ens, F.lit(best).alias("winner"), "ens_mean", "ens_tjflexic")


#: E10's configurations: 1-2- against 1-3-grams.
RANGES = {"ngram_1_2": (1, 2, 15000, 1.0), "ngram_1_3": (1, 3, 15000, 1.0)}


@rows_query("ngram_range_search")
def ngram_range_search_q(spark, sf):
    """5-fold CV of 1-2- vs 1-3-grams (15,000 terms, min_df 2, max_df 0.85); the better one is marked."""
    lab, _ = train_test(spark, sf, "contract_ca_stop")
    scores, _ = grid_fit(lab, RANGES, 5, 2, 0.85)
    return _grid_rows(written(M.cross_validate(scores), "ranges"), RANGES)


@query("ngram_range_search_check", _grid_sql(RANGES, "count(*)"))
def ngram_range_search_check_q(spark, sf):
    """The facts of grid_search_check about E10."""
    lab, _ = train_test(spark, sf, "contract_ca_stop")
    return _grid_facts(*grid_fit(lab, RANGES, 5, 2, 0.85))


#: G12's members and weights.
GROUP_WEIGHTS = dict(zip(["v1_n4_c20", "v1_n5_c30", "v1_n6_c50", "v2_n5_c30", "v3_n5_c30", "nbsvm_c1", "mnb_a05", "svc_c05"],
                         [0.15, 0.15, 0.15, 0.12, 0.12, 0.12, 0.08, 0.06]))


def _group_members(spark, sf):
    """G12's eight models: the logistic ones in the same passes, reviews of one cleaner cleaned and counted once."""
    lab, test = train_test(spark, sf, "minstop")
    n = lab.count()
    v1 = {"v1_n4_c20": (1, 4, 60000), "v1_n5_c30": (1, 5, 70000), "v1_n6_c50": (1, 6, 80000), "svc": (1, 4, 50000)}
    feats = FT.gram_lattice(lab, test, n, v1, {"nb": (1, 5, 70000, "df"), "mnb": (1, 5, 70000, "cf")})
    for name, profile in (("v2_n5_c30", "len3"), ("v3_n5_c30", "exclaim")):
        own, rest = train_test(spark, sf, profile)
        feats[name] = L.tfidf_train_test(own, rest, 1, 5, 70000)[:3]
    _, _, tr_nb, te_nb, width = _nb_blocks(spark, sf, "minstop", 1, 5, 70000, True, (lab, test), feats["nb"])
    feats["nbsvm_c1"] = tr_nb, te_nb, width
    names = [m for m in GROUP_WEIGHTS if m in feats]
    C = {"v1_n4_c20": 20.0, "v1_n5_c30": 30.0, "v1_n6_c50": 50.0, "v2_n5_c30": 30.0, "v3_n5_c30": 30.0, "nbsvm_c1": 1.0}
    train = N.packed([(feats[m][0], lab.select("id", "label")) for m in names])
    models = N.fit_many(train, [N.Spec(m, C[m], t) for t, m in enumerate(names)], [feats[m][2] for m in names])
    rest = N.packed([(feats[m][1], test.select("id")) for m in names])
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("score")))
    out = N.score_many(rest, models).select("id", "model", p.alias("p"))
    # multinomial NB (alpha 0.5): one aggregate to fit, one join to score
    vocab, tf, known = feats["mnb"]
    model = S.mnb_model(FT.nb_class_sums(tf, vocab, 70000, binary=False), 0.5)
    sc = S.linear_scorer(FT.count_matrix(known, vocab, 70000), model, test, S.prior_log_odds(lab), "id", 70000)
    out = out.unionByName(sc.select("id", F.lit("mnb_a05").alias("model"), "p"))
    svc = L.vectors_for(feats["svc"][0], feats["svc"][2], lab), L.vectors_for(feats["svc"][1], feats["svc"][2], test, keep=())
    return written(out.unionByName(L.calibrated(*svc, "svc", 0.5, 3, "svc_c05")), "members")


_GROUP_COLUMNS = ("ens_mean", "ens_weighted", "ens_tjflexic", "ens_aggressive")


@rows_query("ens_of_groups")
def ens_of_groups_q(spark, sf):
    """Eight models in five groups (TF-IDF LR x3, other cleaners x2, NB-SVM, multinomial
    NB, calibrated SVM) -> mean, weighted, TJflexic and aggressive outputs."""
    return _rows(G.combiners(_group_members(spark, sf), G.weights_table(spark, GROUP_WEIGHTS)), *_GROUP_COLUMNS)


@query("ens_of_groups_check", _ENSEMBLE_SQL)
def ens_of_groups_check_q(spark, sf):
    """G12's outputs against plain arithmetic over its eight members."""
    members = _group_members(spark, sf)
    ens = G.combiners(members, G.weights_table(spark, GROUP_WEIGHTS)).select("id", *_GROUP_COLUMNS)
    return ensemble_facts(members, ens, GROUP_WEIGHTS)
