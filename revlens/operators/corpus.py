"""Sentences and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions import profiles as P
from revlens.functions import text as T
from revlens.functions.ngrams import treebank_word_split

# Sentence boundary used by the split-first mode: a run of terminators or line breaks.
SENTENCE_BREAK = r"[.!?\n]+"


def review_sentences(text: Column, mode: str = "split_first", max_sentences: int | None = None) -> Column:
    """ARRAY<ARRAY<STRING>>: the word lists of one review's sentences, empty ones dropped.

    clean_first  the reviewed scripts' order: letters-only clean, then sentence split, so a
                 review is at most one sentence (the cap never binds);
    split_first  markup removed, then split at terminators / line breaks, then each piece
                 cleaned to a-z words.
    """
    text = T.text_or_empty(text)
    if mode == "clean_first":
        words = treebank_word_split(P.profile_tokens("letters", text))
        sents = F.array(words)
    elif mode == "split_first":
        pieces = F.filter(F.split(T.html_text(text), SENTENCE_BREAK), lambda p: F.trim(p) != "")
        if max_sentences is not None:
            pieces = F.slice(pieces, 1, int(max_sentences))
        sents = F.transform(pieces, lambda p: treebank_word_split(
            F.transform(T.letter_words(p), lambda w: F.lower(w))))
    else:
        raise ValueError(mode)
    if mode == "clean_first" and max_sentences is not None:
        sents = F.slice(sents, 1, int(max_sentences))
    return F.filter(sents, lambda s: F.size(s) > 0)


def sentence_rows(reviews: DataFrame, id_col: str, text_col: str = "text", mode: str = "split_first",
                  max_sentences: int | None = None, corpus: str | None = None) -> DataFrame:
    """One row per sentence (id, sent_no, words)."""
    cols = [F.col(id_col).cast("string").alias("review_id")]
    if corpus is not None:
        cols.insert(0, F.lit(corpus).alias("corpus"))
    return reviews.select(*cols, F.posexplode(review_sentences(F.col(text_col), mode, max_sentences))
                          .alias("sent_no", "words"))


def corpus_union(*parts: DataFrame) -> DataFrame:
    """Bag union (UNION ALL) of sentence tables."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sentence_length_stats(sentences: DataFrame) -> DataFrame:
    """Min / max / mean / exact median of words per sentence. The exact median keeps a
    count per distinct length, so its buffer is bounded by the longest sentence."""
    n = F.size("words")
    return sentences.agg(F.min(n).cast("long").alias("min_len"), F.max(n).cast("long").alias("max_len"),
                         F.avg(n).alias("mean_len"), F.median(n).cast("double").alias("median_len"),
                         F.count(F.lit(1)).alias("n_sentences"))


def word_frequency(sentences: DataFrame) -> DataFrame:
    """Word -> count, partial aggregation per task before the shuffle on word."""
    return (sentences.select(F.explode("words").alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def corpus_size_stats(sentences: DataFrame) -> DataFrame:
    """Total words and distinct words (distinct via the word-count aggregate)."""
    wf = word_frequency(sentences)
    return wf.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_words"),
                  F.count(F.lit(1)).alias("distinct_words"))


def top_words(sentences: DataFrame, k: int = 10) -> DataFrame:
    """K most common words, ties by word (TakeOrderedAndProject: per-task top-k)."""
    return word_frequency(sentences).orderBy(F.col("n").desc(), F.col("word")).limit(k)
