"""The thirteen cleaning profiles (P1-P13), each a composition of the B primitives.

B5 or B6 with B11 after it is ``letter_words``. ``profile_tokens(name, col)`` returns ARRAY<STRING>; ``profile_text`` the space-joined
string the reviewed scripts feed to their vectorizers. P13 keeps raw text (no split).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.functions import wordlists as W


def _p1(c):  # clean_letters
    return F.transform(T.letter_words(T.html_text(c)), lambda w: F.lower(w))


def _p2(c):  # clean_contract_stop
    c = T.expand_contractions(T.str_lower(T.html_text(c)), W.RULES_R7)
    w = T.letter_words(c)
    return T.drop_stopwords(w, W.STOP_LONG, W.NEGATION_KEEP_P2)


def _p3(c):  # clean_contract
    c = T.expand_contractions(T.str_lower(T.html_text(c)), W.RULES_R5)
    return T.letter_words(c)


def _p4(c):  # clean_contract_ca_stop
    c = T.expand_contractions(T.str_lower(T.html_text(c)), W.RULES_R8)
    w = T.letter_words(c)
    return T.drop_stopwords(w, W.STOP_LONG, W.NEGATION_KEEP_P4)


def _p5(c):  # clean_minstop_url (default)
    c = T.expand_contractions(T.str_lower(c), W.RULES_R2)
    c = T.strip_urls(T.strip_tags_space(c))
    w = T.drop_stopwords(T.letter_words(c), W.minus(W.MINIMAL_STOP, W.NEGATION_BASIC))
    return T.min_token_length(w, 1)


def _p6(c):  # clean_minstop
    c = T.expand_contractions(T.str_lower(c), W.RULES_R1)
    c = T.strip_tags_space(c)
    w = T.drop_stopwords(T.letter_words(c), W.MINIMAL_STOP)
    return T.min_token_length(w, 1)


def _p7(c):  # clean_len3
    c = T.expand_contractions(T.str_lower(c), W.RULES_R1)
    c = T.strip_tags_space(c)
    return T.min_token_length(T.letter_words(c), 2)


def _p8(c):  # clean_exclaim
    c = T.mark_exclamations(T.expand_contractions(T.str_lower(c), W.RULES_R1))
    c = T.strip_tags_space(c)
    w = T.drop_stopwords(T.letter_words(c), W.minus(W.MINIMAL_STOP, W.NEGATION_ENSEMBLE))
    return T.min_token_length(w, 1)


def _p9(c):  # clean_len2
    c = T.expand_contractions(T.str_lower(c), W.RULES_R2)
    c = T.strip_tags_space(c)
    return T.min_token_length(T.letter_words(c), 1)


def _p10(c):  # clean_articles
    c = T.expand_contractions(T.str_lower(c), W.RULES_R2)
    c = T.strip_tags_space(c)
    w = T.drop_stopwords(T.letter_words(c), W.ARTICLES)
    return T.min_token_length(w, 1)


def _p11(c):  # clean_aggressive
    c = T.expand_contractions(T.str_lower(c), W.RULES_R5AGG)
    c = T.isolate_negations(c, W.PAD_AGGRESSIVE)
    c = T.strip_tags_space(c)
    return T.min_token_length(T.letter_words(c), 2, W.NEGATION_SHORT)


def _p12(c):  # clean_padneg
    c = T.expand_contractions(T.str_lower(c), W.RULES_R2)
    c = T.isolate_negations(c, W.PAD_CALIBRATED)
    c = T.strip_tags_space(c)
    return T.min_token_length(T.letter_words(c), 1, W.NEGATION_SHORT)


def _p13(c):  # clean_wordchars (string result)
    c = T.strip_urls(T.strip_tags_space(T.str_lower(c)), http_only=True)
    return T.squeeze_trim(T.word_chars_only(c))


PROFILES = {
    "letters": _p1,
    "contract_stop": _p2,
    "contract": _p3,
    "contract_ca_stop": _p4,
    "minstop_url": _p5,
    "minstop": _p6,
    "len3": _p7,
    "exclaim": _p8,
    "len2": _p9,
    "articles": _p10,
    "aggressive": _p11,
    "padneg": _p12,
    "wordchars": _p13,
}

STRING_PROFILES = {"wordchars"}
DEFAULT_PROFILE = "minstop_url"


def profile_tokens(name: str, c: Column | str) -> Column:
    if name in STRING_PROFILES:
        raise ValueError(f"profile {name!r} yields text, not tokens")
    return PROFILES[name](T.text_or_empty(c))


def profile_text(name: str, c: Column | str) -> Column:
    out = PROFILES[name](T.text_or_empty(c))
    return out if name in STRING_PROFILES else T.join_words(out)
