"""Text-cleaning primitives (B1-B16) as Column builders.

Every builder maps a Column to a Column with built-in Spark SQL functions only, so the
whole cleaning chain stays inside whole-stage codegen. Patterns are written so that Java
regex and RE2 (used by the DuckDB oracle) agree on them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.functions.wordlists import HTML_ENTITIES

_AMP_SENTINEL = "\u0001"


def _lit_replace(c: Column, search: str, repl: str) -> Column:
    return F.replace(c, F.lit(search), F.lit(repl))


def text_or_empty(c: Column | str) -> Column:
    """A missing review is the empty document (never the token 'nan')."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


# B1
def str_lower(c: Column) -> Column:
    return F.lower(c)


# B2
def html_text(c: Column) -> Column:
    """Visible text of markup: comments, script and style bodies dropped, tags vanish with
    no separator, entities decoded ('&amp;' last, other entities become a space)."""
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    c = F.regexp_replace(c, r"(?is)<script\b.*?</script>", "")
    c = F.regexp_replace(c, r"(?is)<style\b.*?</style>", "")
    c = F.regexp_replace(c, r"<[^>]+>", "")
    c = _lit_replace(c, "&amp;", _AMP_SENTINEL)
    for ent, val in HTML_ENTITIES:
        c = _lit_replace(c, ent, val)
    c = F.regexp_replace(c, r"&[#a-zA-Z0-9]+;", " ")
    return _lit_replace(c, _AMP_SENTINEL, "&")


# B3
def strip_tags_space(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", " ")


# B4
def strip_urls(c: Column, http_only: bool = False) -> Column:
    return F.regexp_replace(c, r"http\S+" if http_only else r"http\S+|www\S+", " ")


# B5
def letters_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^a-zA-Z]", " ")


# B6
def letters_and_space(c: Column) -> Column:
    return F.regexp_replace(c, r"[^a-zA-Z\s]", " ")


# B7
def word_chars_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", " ")


# B8
def expand_contractions(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Ordered literal substring rules, applied left to right."""
    for short, full in rules:
        c = _lit_replace(c, short, full)
    return c


# B9
def isolate_negations(c: Column, words: Iterable[str]) -> Column:
    """Pad every occurrence of each word (as a substring) with spaces, in list order."""
    for w in words:
        c = _lit_replace(c, w, f" {w} ")
    return c


# B10
def mark_exclamations(c: Column) -> Column:
    return F.regexp_replace(c, r"!+", " EXCLAMATION ")


# B11
def split_words(c: Column) -> Column:
    """Whitespace split with empty pieces dropped (``split('')`` alone yields [''])."""
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


# B5 or B6, then B11
def letter_words(c: Column) -> Column:
    """``split_words(letters_and_space(c))``: the runs of letters. Whatever is between two of them goes at once; taking it
    sign by sign costs more than all other steps of a cleaner."""
    return F.filter(F.split(F.regexp_replace(c, r"[^a-zA-Z]+", " "), " "), lambda x: x != "")


# B12
def drop_stopwords(words: Column, stop: Sequence[str], keep: Sequence[str] = ()) -> Column:
    stop = list(stop)
    keep = list(keep)
    if keep:
        return F.filter(words, lambda w: ~w.isin(stop) | w.isin(keep))
    return F.filter(words, lambda w: ~w.isin(stop))


# B13
def min_token_length(words: Column, longer_than: int, keep: Sequence[str] = ()) -> Column:
    keep = list(keep)
    if keep:
        return F.filter(words, lambda w: (F.length(w) > longer_than) | w.isin(keep))
    return F.filter(words, lambda w: F.length(w) > longer_than)


# B14
def join_words(words: Column) -> Column:
    return F.array_join(words, " ")


# B15
def squeeze_trim(c: Column) -> Column:
    """Outer strip of all whitespace (inner runs stay)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


# B16
def distinct_words(words: Column) -> Column:
    return F.array_distinct(words)
