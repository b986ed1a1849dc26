"""N-gram builders over a token array (D1, D2, C1, C4) — higher-order functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.functions.wordlists import TREEBANK_SPLITS


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Spark does not share sub-expressions inside higher-order functions: an array expression
    referenced in a lambda is recomputed per element. Binding it through a one-element
    transform keeps every reference a variable lookup."""
    return F.element_at(F.transform(F.array(value), body), 1)


def vectorizer_tokens(words: Column) -> Column:
    """What a default word analyzer keeps of a cleaned a-z token list: lowercase,
    two or more word characters (one-letter tokens vanish before n-grams)."""
    return F.filter(F.transform(words, lambda w: F.lower(w)), lambda w: F.length(w) > 1)


def word_ngrams(words: Column, lo: int = 1, hi: int = 1) -> Column:
    """Contiguous n-grams lo..hi joined by one space, as one array (explode once).

    Built incrementally: the n-gram at position i is the (n-1)-gram at i plus one space and
    word i+n-1, so each gram costs one concatenation instead of re-joining n words. Every
    intermediate array is bound once (``let``)."""
    if lo < 1 or hi < lo:
        raise ValueError("need 1 <= lo <= hi")

    def body(w):
        size = F.size(w)

        def step(prev, n, acc):
            if n > hi:
                return acc[0] if len(acc) == 1 else F.concat(*acc)
            cur = F.transform(F.slice(prev, 1, F.greatest(size - (n - 1), F.lit(0))),
                              lambda g, i: F.concat(g, F.lit(" "), F.element_at(w, i + n)))
            return let(cur, lambda c: step(c, n + 1, acc + ([c] if n >= lo else [])))

        return step(w, 2, [w] if lo == 1 else [])
    return let(words, body)


def char_wb_ngrams(words: Column, lo: int = 3, hi: int = 6) -> Column:
    """Character n-grams inside space-padded words. A padded word no longer than n
    contributes itself once and no longer grams."""
    def body(ws):
        return _char_wb(ws, lo, hi)
    return let(words, body)


def _char_wb_one(words: Column, n: int, first: bool) -> Column:
    # plain one-argument lambdas: a defaulted second parameter would be read as the index
    def keep(z):
        return F.lit(True) if first else F.length(z) + 2 >= n

    def grams(z):
        padded = F.concat(F.lit(" "), z, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(z) + (3 - n), F.lit(1))),
                           lambda i: F.substring(padded, i, F.lit(n)))
    return F.flatten(F.transform(F.filter(words, keep), grams))


def _char_wb(words: Column, lo: int, hi: int) -> Column:
    parts = [_char_wb_one(words, n, n == lo) for n in range(lo, hi + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def treebank_word_split(words: Column) -> Column:
    """C4: the word tokenizer on a-z text splits six fused forms in two; others stay."""
    def split_one(w):
        expr = F.array(w)
        for fused, pieces in reversed(TREEBANK_SPLITS):
            expr = F.when(w == fused, F.array(*[F.lit(p) for p in pieces])).otherwise(expr)
        return expr
    return F.flatten(F.transform(words, split_one))
