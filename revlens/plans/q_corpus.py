"""Catalog: tokens, sentences and corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions import profiles as P
from revlens.functions.ngrams import treebank_word_split, vectorizer_tokens
from revlens.operators import corpus as C
from revlens.plans import duck as D
from revlens.plans.registry import query
from revlens.sources import tables


@query("vectorizer_tokens", f"""
SELECT doc_id, array_to_string({D.vec_tokens(D.profile_tokens('letters', 'text'))}, ' ') AS tokens
FROM documents""")
def vectorizer_tokens_q(spark, sf):
    return tables.documents(spark, sf).select(
        "doc_id", F.array_join(vectorizer_tokens(P.profile_tokens("letters", "text")), " ").alias("tokens"))


@query("treebank_word_split", f"""
SELECT doc_id, array_to_string({D.treebank(D.profile_tokens('letters', 'text'))}, ' ') AS tokens
FROM documents""")
def treebank_q(spark, sf):
    return tables.documents(spark, sf).select(
        "doc_id", F.array_join(treebank_word_split(P.profile_tokens("letters", "text")), " ").alias("tokens"))


def _sent_out(df):
    return df.select("review_id", F.col("sent_no").cast("long").alias("sent_no"),
                     F.size("words").cast("long").alias("n_words"),
                     F.array_join("words", " ").alias("sentence"))


def _sent_sql(src_select: str, mode: str) -> str:
    return f"""
SELECT review_id, CAST(generate_subscripts(s, 1) - 1 AS BIGINT) AS sent_no,
       CAST(len(unnest(s)) AS BIGINT) AS n_words, array_to_string(unnest(s), ' ') AS sentence
FROM (SELECT review_id, {D.sentences('text', mode)} AS s FROM ({src_select}) src) t"""


_LABELED_SQL = "SELECT CAST(d.doc_id AS VARCHAR) AS review_id, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
_UNLAB_SQL = "SELECT CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS review_id, text FROM conversations"
_DOCS_SQL = "SELECT CAST(doc_id AS VARCHAR) AS review_id, text FROM documents"


@query("sentence_corpus", _sent_sql(_LABELED_SQL, "clean_first"))
def sentence_corpus_q(spark, sf):
    """C2 in the reviewed scripts' order (clean, then split), no cap."""
    return _sent_out(C.sentence_rows(tables.labeled(spark, sf), "doc_id", mode="clean_first"))


@query("review_to_sentences", _sent_sql(_DOCS_SQL, "split_first"))
def review_to_sentences_q(spark, sf):
    """Every review split into sentences (markup removed first), no cap."""
    return _sent_out(C.sentence_rows(tables.documents(spark, sf), "doc_id", mode="split_first"))


def _union_corpus(spark, sf):
    lab = C.sentence_rows(tables.labeled(spark, sf), "doc_id", mode="split_first", corpus="labeled")
    unl = C.sentence_rows(tables.unlabeled(spark, sf), "review_id", mode="split_first", corpus="unlabeled")
    return C.corpus_union(lab, unl)


_UNION_SQL = f"""
WITH corpus AS (
  SELECT 'labeled' AS corpus, review_id, unnest(s) AS words FROM (SELECT review_id, {D.sentences('text', 'split_first')} AS s FROM ({_LABELED_SQL}) a) x
  UNION ALL
  SELECT 'unlabeled' AS corpus, review_id, unnest(s) AS words FROM (SELECT review_id, {D.sentences('text', 'split_first')} AS s FROM ({_UNLAB_SQL}) b) y
)"""


@query("corpus_union", _UNION_SQL + """
SELECT corpus, CAST(count(*) AS BIGINT) AS n_sentences, CAST(sum(len(words)) AS BIGINT) AS n_words,
       CAST(count(DISTINCT review_id) AS BIGINT) AS n_reviews
FROM corpus GROUP BY corpus""")
def corpus_union_q(spark, sf):
    u = _union_corpus(spark, sf)
    return u.groupBy("corpus").agg(F.count(F.lit(1)).alias("n_sentences"),
                                   F.sum(F.size("words")).cast("long").alias("n_words"),
                                   F.countDistinct("review_id").alias("n_reviews"))


@query("sentence_length_stats", _UNION_SQL + """
SELECT CAST(min(len(words)) AS BIGINT) AS min_len, CAST(max(len(words)) AS BIGINT) AS max_len,
       round(avg(len(words)), 6) AS mean_len, round(CAST(median(len(words)) AS DOUBLE), 6) AS median_len,
       CAST(count(*) AS BIGINT) AS n_sentences
FROM corpus""")
def sentence_length_stats_q(spark, sf):
    s = C.sentence_length_stats(_union_corpus(spark, sf))
    return s.select("min_len", "max_len", F.round("mean_len", 6).alias("mean_len"),
                    F.round("median_len", 6).alias("median_len"), "n_sentences")


@query("corpus_size_stats", _UNION_SQL + """
SELECT CAST(count(*) AS BIGINT) AS total_words, CAST(count(DISTINCT w) AS BIGINT) AS distinct_words
FROM (SELECT unnest(words) AS w FROM corpus) t""")
def corpus_size_stats_q(spark, sf):
    return C.corpus_size_stats(_union_corpus(spark, sf))


@query("top_words", _UNION_SQL + """
SELECT word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(words) AS word FROM corpus) t
GROUP BY word ORDER BY n DESC, word LIMIT 10""")
def top_words_q(spark, sf):
    return C.top_words(_union_corpus(spark, sf), 10)


@query("word_frequency", _UNION_SQL + """
SELECT word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(words) AS word FROM corpus) t GROUP BY word""")
def word_frequency_q(spark, sf):
    return C.word_frequency(_union_corpus(spark, sf))


@query("review_sentence_preview", f"""
WITH r AS (SELECT d.doc_id, {D.sentences('d.text', 'split_first')} AS s
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id
           ORDER BY d.doc_id LIMIT 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, sent_no, sentence FROM (
  SELECT doc_id, s, CAST(generate_subscripts(s, 1) - 1 AS BIGINT) AS sent_no,
         array_to_string(unnest(s), ' ') AS sentence FROM r) t
WHERE sent_no < 5""")
def review_sentence_preview_q(spark, sf):
    """Sentence count and the first five sentences of the first labeled review."""
    first = tables.labeled(spark, sf).orderBy("doc_id").limit(1)
    s = first.select("doc_id", C.review_sentences(F.col("text"), "split_first").alias("s"))
    return (s.select("doc_id", F.size("s").cast("long").alias("n_sentences"),
                     F.posexplode("s").alias("sent_no", "w"))
            .filter(F.col("sent_no") < 5)
            .select("doc_id", "n_sentences", F.col("sent_no").cast("long").alias("sent_no"),
                    F.array_join("w", " ").alias("sentence")))
