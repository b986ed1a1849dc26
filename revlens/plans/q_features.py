"""Catalog: n-grams, vocabularies and sparse feature matrices.

Configurations are the reviewed scripts' own vectorizer instances (n-gram range,
max_features, min_df / max_df, cleaner), fitted on the labeled reviews.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions import profiles as P
from revlens.functions import wordlists as W
from revlens.operators import features as FT
from revlens.plans import duck as D
from revlens.plans.registry import query
from revlens.session import written
from revlens.sources import tables


def labeled_docs(spark, sf, profile):
    return FT.by_review(tables.labeled(spark, sf), "doc_id").select(F.col("doc_id").alias("id"), "label",
                                            P.profile_tokens(profile, "text").alias("words"))


def fit(spark, sf, profile, lo, hi, max_features, min_df=1, max_df=1.0, analyzer="word", binary=False,
        with_label=True):
    """(docs, tf, n_docs, vocab_with_idf) for one vectorizer instance on the labeled reviews.
    ``with_label`` carries the label in the term table (needed by the NB statistics only)."""
    docs = FT.cleaned(labeled_docs(spark, sf, profile))
    n = tables.labeled(spark, sf).count()  # same rows, counted before the id shuffle
    keep = ("label",) if with_label else ()
    if not binary:
        vocab, tf = FT.fit_counts(docs, n, lo, hi, max_features, min_df, max_df, analyzer, keep)
        return docs, tf, n, vocab
    vocab = written(FT.with_smooth_idf(FT.document_vocabulary(docs, n, lo, hi, max_features, min_df, max_df, analyzer), n), "vocabulary")
    tf = FT.known_counts(docs, vocab, lo, hi, max_features, analyzer, keep)
    return docs, tf, n, vocab


def _gram_summary(grams):
    from revlens.functions.ngrams import let
    s = let(grams, lambda g: F.struct(F.size(g).cast("long").alias("n_grams"),
                                      F.size(F.array_distinct(g)).cast("long").alias("n_distinct"),
                                      F.array_min(g).alias("min_gram"), F.array_max(g).alias("max_gram")))
    return [s.getField(c).alias(c) for c in ("n_grams", "n_distinct", "min_gram", "max_gram")]


def _gram_summary_sql(g):
    return (f"CAST(len({g}) AS BIGINT) AS n_grams, CAST(len(list_distinct({g})) AS BIGINT) AS n_distinct, "
            f"list_min({g}) AS min_gram, list_max({g}) AS max_gram")


@query("word_ngrams", f"""
SELECT doc_id, {_gram_summary_sql('gr')} FROM (
  SELECT doc_id, {D.word_ngrams('g', 1, 3)} AS gr FROM (
    SELECT doc_id, {D.vec_tokens(D.profile_tokens('minstop', 'text'))} AS g FROM documents) a) b""")
def word_ngrams_q(spark, sf):
    """D1 over every review: 1-3-grams of the minimal cleaner's tokens."""
    d = tables.documents(spark, sf)
    return d.select("doc_id", *_gram_summary(FT.doc_grams(P.profile_tokens("minstop", "text"), 1, 3)))


@query("char_wb_ngrams", f"""
SELECT doc_id, {_gram_summary_sql('gr')} FROM (
  SELECT doc_id, {D.char_wb_ngrams('g', 3, 6)} AS gr FROM (
    SELECT doc_id, list_transform({D.profile_tokens('articles', 'text')}, lambda x: lower(x)) AS g FROM documents) a) b""")
def char_wb_ngrams_q(spark, sf):
    """D2 over every review: padded-word character 3-6-grams."""
    d = tables.documents(spark, sf)
    return d.select("doc_id", *_gram_summary(FT.doc_grams(P.profile_tokens("articles", "text"), 3, 6, "char_wb")))


@query("vocabulary", "WITH " + D.fit_ctes("letters", 1, 2, 8000, 2, 0.8) + """
SELECT term, idx, CAST(df AS BIGINT) AS df, CAST(cf AS BIGINT) AS cf FROM vocab""")
def vocabulary_q(spark, sf):
    """D3: 1-2-grams, 8,000 terms, min_df 2, max_df 0.8 (letters cleaner)."""
    _, _, _, v = fit(spark, sf, "letters", 1, 2, 8000, 2, 0.8, with_label=False)
    return v.select("term", "idx", F.col("df").cast("long").alias("df"), F.col("cf").cast("long").alias("cf"))


@query("count_bow", "WITH " + D.fit_ctes("letters", 1, 1, 5000, 2, 0.8) + """
SELECT t.id AS doc_id, t.term, v.idx, CAST(t.tf AS BIGINT) AS value FROM tf t JOIN vocab v ON t.term = v.term""")
def count_bow_q(spark, sf):
    """Raw counts, unigrams, 5,000 terms, min_df 2, max_df 0.8."""
    _, tf, _, v = fit(spark, sf, "letters", 1, 1, 5000, 2, 0.8, with_label=False)
    return FT.count_matrix(tf, v, 5000).withColumnRenamed("id", "doc_id")


@query("binary_bow", "WITH " + D.fit_ctes("len2", 1, 4, 80000, 1, binary=True) + """
SELECT t.id AS doc_id, t.term, v.idx, CAST(1 AS BIGINT) AS value FROM tf t JOIN vocab v ON t.term = v.term""")
def binary_bow_q(spark, sf):
    """0/1 presence, 1-4-grams, 80,000 terms ranked by document count."""
    _, tf, _, v = fit(spark, sf, "len2", 1, 4, 80000, 1, binary=True)
    return FT.count_matrix(tf, v, 80000, binary=True).withColumnRenamed("id", "doc_id")


@query("document_frequency", "WITH " + D.fit_ctes("contract_stop", 1, 2, 10000, 2, 0.85) + """
SELECT term, CAST(df AS BIGINT) AS df, round(idf, 6) AS idf FROM vocab""")
def document_frequency_q(spark, sf):
    """Document frequency and smooth idf, 1-2-grams, 10,000 terms, min_df 2, max_df 0.85."""
    _, _, _, v = fit(spark, sf, "contract_stop", 1, 2, 10000, 2, 0.85, with_label=False)
    return v.select("term", F.col("df").cast("long").alias("df"), F.round("idf", 6).alias("idf"))


TFIDF_SQL = "WITH " + D.fit_ctes("minstop_url", 1, 5, 80000, 1) + ",\n" + D.tfidf_cte("tf", "vocab", "x") + """
SELECT id AS doc_id, term, round(value, 6) AS weight FROM x"""


@query("tfidf", TFIDF_SQL)
def tfidf_q(spark, sf):
    """D7, the flagship: default cleaner, 1-5-grams, 80,000 terms, sublinear tf, smooth idf, l2."""
    _, tf, _, v = fit(spark, sf, "minstop_url", 1, 5, 80000, 1, with_label=False)
    m = FT.tfidf_matrix(tf, v, 80000)
    return m.select(F.col("id").alias("doc_id"), "term", F.round("value", 6).alias("weight"))


@query("char_tfidf", "WITH " + D.fit_ctes("articles", 3, 6, 50000, 2, analyzer="char_wb") + ",\n"
       + D.tfidf_cte("tf", "vocab", "x") + """
SELECT id AS doc_id, term, round(value, 6) AS weight FROM x""")
def char_tfidf_q(spark, sf):
    """char_wb 3-6-grams, 50,000 terms, min_df 2."""
    _, tf, _, v = fit(spark, sf, "articles", 3, 6, 50000, 2, analyzer="char_wb", with_label=False)
    m = FT.tfidf_matrix(tf, v, 50000)
    return m.select(F.col("id").alias("doc_id"), "term", F.round("value", 6).alias("weight"))


_UNSEEN_DOCS = "SELECT item_id AS id, text, CAST(NULL AS INTEGER) AS label FROM benchmark"


@query("transform_unseen", "WITH " + D.fit_ctes("contract_stop", 1, 2, 10000, 2, 0.85) + ",\n"
       + D.fit_ctes("contract_stop", 1, 2, None, docs_sql=_UNSEEN_DOCS, prefix="u_") + ",\n"
       + D.tfidf_cte("u_tf", "vocab", "x") + """
SELECT id AS doc_id, term, round(value, 6) AS weight FROM x""")
def transform_unseen_q(spark, sf):
    """Vocabulary + idf fitted on the labeled reviews applied to unseen documents
    (benchmark); unknown terms are ignored."""
    _, _, _, v = fit(spark, sf, "contract_stop", 1, 2, 10000, 2, 0.85, with_label=False)
    unseen = FT.by_review(tables.benchmark(spark, sf), "doc_id").select(
        F.col("doc_id").alias("id"), P.profile_tokens("contract_stop", "text").alias("words"))
    utf = FT.known_counts(unseen, v, 1, 2, 10000)
    m = FT.tfidf_matrix(utf, v, 10000)
    return m.select(F.col("id").alias("doc_id"), "term", F.round("value", 6).alias("weight"))


def _class_sums_sql(binary=True):
    x = "1" if binary else "t.tf"
    return f"""cs AS (SELECT v.term, v.idx, sum(CASE WHEN t.label = 1 THEN {x} ELSE 0 END) AS pos,
                  sum(CASE WHEN t.label = 0 THEN {x} ELSE 0 END) AS neg
           FROM tf t JOIN vocab v ON t.term = v.term GROUP BY v.term, v.idx)"""


NB_RATIO_CTES = D.fit_ctes("len2", 1, 4, 80000, 1, binary=True) + ",\n" + _class_sums_sql() + """,
r AS (SELECT term, idx, ln(((pos + 1.0) / sum(pos + 1.0) OVER ()) / ((neg + 1.0) / sum(neg + 1.0) OVER ())) AS r FROM cs)"""


@query("nb_log_ratio", "WITH " + NB_RATIO_CTES + "\nSELECT term, idx, round(r, 6) AS r FROM r")
def nb_log_ratio_q(spark, sf):
    """NB log-count ratio, binary 1-4-grams, 80,000 terms, alpha 1."""
    _, tf, _, v = fit(spark, sf, "len2", 1, 4, 80000, 1, binary=True)
    r = FT.nb_log_ratio(FT.nb_class_sums(tf, v, 80000))
    return r.select("term", "idx", F.round("r", 6).alias("r"))


@query("nb_log_ratio_clipped", "WITH " + D.fit_ctes("minstop", 1, 5, 70000, 1, binary=True) + ",\n"
       + _class_sums_sql() + """
SELECT term, idx, round(greatest(least(ln((pos + 1.0) / (neg + 1.0)), 5.0), -5.0), 6) AS r FROM cs""")
def nb_log_ratio_clipped_q(spark, sf):
    """ln(p/q) without class totals, clipped to +-5; binary 1-5-grams, 70,000 terms."""
    _, tf, _, v = fit(spark, sf, "minstop", 1, 5, 70000, 1, binary=True)
    r = FT.nb_log_ratio_clipped(FT.nb_class_sums(tf, v, 70000))
    return r.select("term", "idx", F.round("r", 6).alias("r"))


@query("nb_weighted_features", "WITH " + NB_RATIO_CTES + """
SELECT t.id AS doc_id, t.term, r.idx, round(r.r, 6) AS value FROM tf t JOIN r ON t.term = r.term""")
def nb_weighted_features_q(spark, sf):
    """0/1 presence times the log-count ratio."""
    _, tf, _, v = fit(spark, sf, "len2", 1, 4, 80000, 1, binary=True)
    r = FT.nb_log_ratio(FT.nb_class_sums(tf, v, 80000))
    x = FT.nb_weighted(FT.count_matrix(tf, v, 80000, binary=True), r, max_features=80000)
    return x.select(F.col("id").alias("doc_id"), "term", "idx", F.round("value", 6).alias("value"))


def _lex_sql(words):
    def hits(lst):
        return f"CAST(len(list_intersect(list_distinct({words}), [{', '.join(D.q(w) for w in lst)}])) AS BIGINT)"
    p, n, g = hits(W.LEXICON_POSITIVE), hits(W.LEXICON_NEGATIVE), hits(W.LEXICON_NEGATION)
    return f"{p} AS pos, {n} AS neg, {g} AS negation, {p} - {g} AS eff_pos, {n} + {g} AS eff_neg"


@query("lexicon_counts", f"""
SELECT doc_id, {_lex_sql('w')} FROM (SELECT doc_id, {D.profile_tokens('len2', 'text')} AS w FROM documents) t""")
def lexicon_counts_q(spark, sf):
    """D13 over every review."""
    d = tables.documents(spark, sf)
    return d.select("doc_id", *FT.lexicon_counts(P.profile_tokens("len2", "text"), W.LEXICON_POSITIVE,
                                                 W.LEXICON_NEGATIVE, W.LEXICON_NEGATION))


@query("hstack_features", "WITH " + D.fit_ctes("len2", 1, 5, 80000, 1) + ",\n" + D.tfidf_cte("tf", "vocab", "x") + f""",
lex AS (SELECT id, {_lex_sql('words')} FROM docs),
nv AS (SELECT count(*) AS n FROM vocab),
lexl AS (SELECT id, CAST(k - 1 + (SELECT n FROM nv) AS INTEGER) AS idx, CAST(v AS DOUBLE) AS value
         FROM (SELECT id, unnest([pos, neg, negation, eff_pos, eff_neg]) AS v,
                      unnest([1, 2, 3, 4, 5]) AS k FROM lex) t WHERE v <> 0)
SELECT id AS doc_id, idx, round(value, 6) AS value FROM x
UNION ALL SELECT id AS doc_id, idx, round(value, 6) AS value FROM lexl""")
def hstack_features_q(spark, sf):
    """TF-IDF block (1-5-grams, 80,000 terms) followed by the five lexicon columns."""
    docs, tf, _, v = fit(spark, sf, "len2", 1, 5, 80000, 1, with_label=False)
    width = v.count()
    lex = docs.select("id", *FT.lexicon_counts(F.col("words"), W.LEXICON_POSITIVE, W.LEXICON_NEGATIVE,
                                               W.LEXICON_NEGATION))
    blocks = [(FT.tfidf_matrix(tf, v, 80000).select("id", "idx", "value"), width),
              (FT.dense_block(lex, ["pos", "neg", "negation", "eff_pos", "eff_neg"]), 5)]
    out = FT.hstack(blocks)
    return out.select(F.col("id").alias("doc_id"), "idx", F.round("value", 6).alias("value"))


@query("feature_listing", "WITH " + D.fit_ctes("contract_stop", 1, 2, 10000, 2, 0.85) + """
SELECT 'first' AS part, CAST((SELECT count(*) FROM vocab) AS BIGINT) AS n_features, idx, term
FROM (SELECT * FROM vocab ORDER BY idx LIMIT 20) a
UNION ALL
SELECT 'contains_not' AS part, CAST((SELECT count(*) FROM vocab) AS BIGINT) AS n_features, idx, term
FROM (SELECT * FROM vocab WHERE contains(term, 'not') ORDER BY term LIMIT 15) b""")
def feature_listing_q(spark, sf):
    """Vocabulary size, the first 20 feature names and the first 15 containing 'not'."""
    _, _, _, v = fit(spark, sf, "contract_stop", 1, 2, 10000, 2, 0.85, with_label=False)
    n = v.count()
    first = v.orderBy("idx").limit(20).select(F.lit("first").alias("part"), "idx", "term")
    nots = (v.filter(F.col("term").contains("not")).orderBy("term").limit(15)
            .select(F.lit("contains_not").alias("part"), "idx", "term"))
    return first.unionByName(nots).select("part", F.lit(n).cast("long").alias("n_features"), "idx", "term")
