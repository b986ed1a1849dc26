"""Catalog: text-cleaning primitives (B1-B16) and profiles (P1-P13) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions import profiles as P
from revlens.functions import text as T
from revlens.functions import wordlists as W
from revlens.plans import duck as D
from revlens.plans.registry import query
from revlens.sources import tables


def _docs(spark, sf):
    return tables.documents(spark, sf)


def _pages(spark, sf):
    return tables.pages(spark, sf)


def _doc_text_query(key, spark_fn, sql_expr, source="documents"):
    """Register key -> (id, out) over a whole text table."""
    if source == "documents":
        idc, col, loader = "doc_id", "text", _docs
    else:
        idc, col, loader = "page_id", "html", _pages
    sql = f"SELECT {idc}, {sql_expr(D.text(col))} AS out FROM {source}"

    @query(key, sql)
    def _q(spark, sf):
        df = loader(spark, sf)
        return df.select(idc, spark_fn(T.text_or_empty(col)).alias("out"))
    return _q


_doc_text_query("str_lower", T.str_lower, D.lower)
_doc_text_query("html_text", T.html_text, D.html_text, "pages")
_doc_text_query("strip_tags_space", T.strip_tags_space, D.tags_space, "pages")
_doc_text_query("strip_urls", T.strip_urls, D.urls, "pages")
_doc_text_query("letters_only", T.letters_only, D.letters)
_doc_text_query("letters_and_space", T.letters_and_space, D.letters_space)
_doc_text_query("word_chars_only", T.word_chars_only, D.word_chars)
_doc_text_query("expand_contractions",
                lambda c: T.expand_contractions(T.str_lower(c), W.RULES_R8),
                lambda c: D.contractions(D.lower(c), W.RULES_R8))
_doc_text_query("isolate_negations",
                lambda c: T.isolate_negations(T.str_lower(c), W.PAD_AGGRESSIVE),
                lambda c: D.pad(D.lower(c), W.PAD_AGGRESSIVE))
_doc_text_query("mark_exclamations", T.mark_exclamations, D.exclaim)
_doc_text_query("split_words",
                lambda c: F.array_join(T.split_words(T.letters_and_space(T.str_lower(c))), "|"),
                lambda c: f"array_to_string({D.split(D.letters_space(D.lower(c)))}, '|')")
_doc_text_query("drop_stopwords",
                lambda c: T.join_words(T.drop_stopwords(T.split_words(T.letters_and_space(T.str_lower(c))),
                                                        W.STOP_LONG, W.NEGATION_KEEP_P4)),
                lambda c: D.join(D.drop(D.split(D.letters_space(D.lower(c))), W.STOP_LONG, W.NEGATION_KEEP_P4)))
_doc_text_query("min_token_length",
                lambda c: T.join_words(T.min_token_length(T.split_words(T.letters_and_space(T.str_lower(c))),
                                                          2, W.NEGATION_SHORT)),
                lambda c: D.join(D.minlen(D.split(D.letters_space(D.lower(c))), 2, W.NEGATION_SHORT)))
_doc_text_query("join_words",
                lambda c: T.join_words(T.split_words(c)),
                lambda c: D.join(D.split(c)))
_doc_text_query("squeeze_trim", T.squeeze_trim, D.strip)


@query("distinct_words", f"""
SELECT doc_id, CAST(len(list_distinct({D.profile_tokens('letters', 'text')})) AS BIGINT) AS n_distinct,
       CAST(len({D.profile_tokens('letters', 'text')}) AS BIGINT) AS n_words
FROM documents""")
def distinct_words(spark, sf):
    w = P.profile_tokens("letters", "text")
    return _docs(spark, sf).select("doc_id", F.size(T.distinct_words(w)).cast("long").alias("n_distinct"),
                                   F.size(w).cast("long").alias("n_words"))


# Thirteen profiles over the whole review table (P1-P4 and P13 also over the markup table
# would be the same code; the review table is the one the reviewed scripts clean).
for _name in P.PROFILES:
    def _mk(name):
        sql = f"SELECT doc_id, {D.profile_text(name, 'text')} AS clean FROM documents"

        @query(f"clean_{name}", sql)
        def _q(spark, sf):
            return _docs(spark, sf).select("doc_id", P.profile_text(name, "text").alias("clean"))
        return _q
    _mk(_name)


@query("clean_letters_pages", f"SELECT page_id, {D.profile_text('letters', 'html')} AS clean FROM pages")
def clean_letters_pages(spark, sf):
    """P1 on raw web pages: the markup branch (comments, scripts, entities) of the profile."""
    return _pages(spark, sf).select("page_id", P.profile_text("letters", "html").alias("clean"))
