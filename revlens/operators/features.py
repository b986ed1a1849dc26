"""Sparse text features in long form.

Shapes
------
docs   (id, words ARRAY<STRING>[, label])        one row per review, id unique
tf     (id[, label], term, tf)                    one row per (review, term)
vocab  (term, idx, df, cf[, idf])                 at most ``max_features`` rows
feat   (id, idx, value)                           sparse document-term matrix

Plan shape: the reviews are hash-partitioned on id once (the raw text is the smallest
thing to move), so the (id, term) aggregate and every per-review window after it run
without another exchange. Term statistics aggregate partially per task before the shuffle
on term (hot terms such as 'the' collapse map-side). The vocabulary comes first; then the reviews are read
again and only its terms are counted, so no table of all n-grams is written. It is broadcast only when
``max_features`` bounds it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.ngrams import char_wb_ngrams, vectorizer_tokens, word_ngrams
from revlens.operators import grams as GR
from revlens.operators.ranking import row_number0
from revlens.session import written

# Largest vocabulary shipped to every task as a broadcast hash table (rows).
BROADCAST_VOCAB_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, row_bound: int | None) -> DataFrame:
    """Broadcast only a side whose row count is bounded by a parameter below the limit."""
    if row_bound is not None and row_bound <= BROADCAST_VOCAB_ROWS:
        return F.broadcast(df)
    return df


def doc_grams(words: Column, lo: int = 1, hi: int = 1, analyzer: str = "word") -> Column:
    if analyzer == "word":
        return word_ngrams(vectorizer_tokens(words), lo, hi)
    if analyzer == "char_wb":
        return char_wb_ngrams(F.transform(words, lambda w: F.lower(w)), lo, hi)
    raise ValueError(analyzer)


def term_frequencies(docs: DataFrame, id_col: str = "id", words_col: str = "words",
                     lo: int = 1, hi: int = 1, analyzer: str = "word",
                     keep_cols: tuple[str, ...] = (), partitioned: bool = False) -> DataFrame:
    """(id, *keep_cols, term, tf). ``keep_cols`` must be functionally dependent on id (label).

    ``partitioned=True``: the caller already hash-partitioned the raw reviews on id (see
    ``by_review``), so cleaning runs after that shuffle, in parallel, and no second
    exchange is planned here."""
    base = docs if partitioned else docs.repartition(id_col)
    exploded = (base
                .select(id_col, *keep_cols, F.explode(doc_grams(F.col(words_col), lo, hi, analyzer)).alias("term")))
    return exploded.groupBy(id_col, *keep_cols, "term").agg(F.count(F.lit(1)).alias("tf"))


def by_review(reviews: DataFrame, id_col: str) -> DataFrame:
    """Hash-partition raw reviews on their id before any cleaning: the one shuffle of the
    vectorizer moves raw text, and the per-review aggregate / norm window reuse it. Above PART_CHARS for each
    core the number of parts grows with the text: a part is one task, which holds the counts of all its n-grams."""
    parts = review_parts(reviews)
    return reviews.repartition(parts, id_col) if parts else reviews.repartition(id_col)


#: Characters of text, or of cleaned words with their spaces, in a part of the reviews.
PART_CHARS = 2 << 20


def review_parts(reviews: DataFrame) -> int | None:
    """Parts for reviews with a column text or words; None if as many as there are cores hold them."""
    held = F.length("text") if "text" in reviews.columns else F.size("words") + F.aggregate(
        "words", F.lit(0).cast("long"), lambda acc, w: acc + F.coalesce(F.length(w), F.lit(0)))
    parts = -(-(reviews.agg(F.sum(held)).first()[0] or 0) // PART_CHARS)
    return parts if parts > reviews.sparkSession.sparkContext.defaultParallelism else None


def cleaned(docs: DataFrame, id_col: str = "id") -> DataFrame:
    """``docs`` written and partitioned on their id again: reviews are cleaned once, however often terms are counted."""
    return by_review(written(docs, "words"), id_col)


def _doc_count_bound(x, n_docs):
    return x if isinstance(x, int) and not isinstance(x, bool) else float(x) * n_docs


def term_statistics(tf: DataFrame) -> DataFrame:
    """(term, df, cf): reviews and occurrences of every term, written (a row for each term)."""
    return written(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")), "term-counts")


def _least_of_top(stats: DataFrame, k: int, rank_col: str) -> tuple[int | None, bool]:
    """The ``k``-th largest ``rank_col`` (the smallest, if there are fewer rows; None of no rows), and whether there are k rows."""
    w = Window.orderBy(F.col(rank_col).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row for each count
    counts = stats.groupBy(rank_col).agg(F.count(F.lit(1)).alias("_n")).withColumn("_upto", F.sum("_n").over(w))
    r = counts.filter(F.col("_upto") - F.col("_n") < k).agg(F.min(rank_col), F.max("_upto")).first()
    return r[0], (r[1] or 0) >= k


def top_terms(stats: DataFrame, k: int, rank_col: str = "cf", keep_rank: bool = False) -> DataFrame:
    """The first ``k`` terms by ``rank_col`` descending, ties by term (with their place as _rk, if asked for). How many terms have each count tells from
    which count on terms can be among them, and only those are ranked."""
    least, _ = _least_of_top(stats, k, rank_col)
    some = stats.filter(F.col(rank_col) >= F.lit(least if least is not None else 0))
    top = row_number0(some, [F.col(rank_col).desc(), F.col("term")], out="_rk").filter(F.col("_rk") < k)
    return top if keep_rank else top.drop("_rk")


def vocabulary(tf: DataFrame, n_docs: int, max_features: int | None = None,
               min_df: int | float = 1, max_df: int | float = 1.0, binary: bool = False) -> DataFrame:
    """(term, idx, df, cf): document-frequency window first, then the top ``max_features`` by
    corpus count (document count when ``binary``), ties by term; idx in term order. ``tf`` is a table of term
    frequencies, or already of ``term_statistics``."""
    lo, hi = _doc_count_bound(min_df, n_docs), _doc_count_bound(max_df, n_docs)
    window = (F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi))
    if "tf" in tf.columns:
        counts = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")).filter(window)
        kept = written(counts, "term-counts") if max_features is not None else counts
    else:
        kept = tf.filter(window)
    if max_features is not None:
        top = top_terms(kept, int(max_features), "df" if binary else "cf")
        # at most max_features rows: one small sorted window is fine here
        return top.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
    return row_number0(kept, ["term"], out="idx")  # bigint: the number of terms is not bounded


def document_vocabulary(docs: DataFrame, n_docs: int, lo: int, hi: int, max_features: int, min_df: int | float = 1,
                        max_df: int | float = 1.0, analyzer: str = "word", keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """``vocabulary`` of terms ranked by document count, from the terms that can be among them."""
    if analyzer != "word":
        tf = docs.select(*keys, F.explode(doc_grams(F.col("words"), lo, hi, analyzer)).alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))
        return vocabulary(tf, n_docs, max_features, min_df, max_df, binary=True)
    low, high = _doc_count_bound(min_df, n_docs), _doc_count_bound(max_df, n_docs)
    stats = Counted(docs, n_docs, lo, hi, by_review=keys).first(max_features, low, high)
    return vocabulary(stats, n_docs, max_features, min_df, max_df, binary=True)


def term_totals(docs: DataFrame, lo: int, hi: int, analyzer: str = "word", words_col: str = "words") -> DataFrame:
    """(term, cf): occurrences of every term."""
    return docs.select(F.explode(doc_grams(F.col(words_col), lo, hi, analyzer)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("cf"))


#: Reviews up to which all terms are counted at once, and buckets in which terms are counted first where there are more.
DIRECT_REVIEWS, BUCKETS = 2_000, 1 << 23


class Counted:
    """Terms of ``docs`` with their counts, as many as a ranking needs. ``by_review`` names the columns of a review, within
    which terms are counted first. ``both``: rankings by cf and by df can be asked for, so buckets count occurrences, of
    which a term has no fewer than reviews.

    Terms are first counted in BUCKETS buckets of their hash, whose number doesn't grow with the reviews. A bucket's
    count is at least that of each of its terms, so a ranking's first terms are all in buckets that reach the least
    count among them. Its first words are an n-gram that is there as often, so theirs reach it too. That count is guessed, and the terms of the buckets that reach the guess are counted; where
    the least count among the first of those is below the guess, it is one that all first terms reach, and the terms of
    the buckets that reach it are counted. All other terms, most of which are there once or twice, are never kept."""

    def __init__(self, docs: DataFrame, n_docs: int, lo: int, hi: int, by_review: tuple[str, ...] = (),
                 words_col: str = "words", both: bool = False):
        self.docs, self.by_review, self.words_col = docs, by_review, words_col
        self.range, self.buckets, self.size = (lo, hi), None, BUCKETS
        self.order = F.size(F.split("term", " "))
        if n_docs > DIRECT_REVIEWS:
            self.buckets = written(GR.bucket_counts(GR.word_lists(docs, (), words_col), lo, hi, self.size, bool(by_review) and not both), "gram-buckets")

    def _counts(self, floor: int) -> DataFrame:
        """(term, cf), or (term, df, cf) if ``by_review``, of all terms that occur ``floor`` times at least, and of others."""
        marks = None
        if floor > 1 and self.buckets is not None:
            heavy = self.buckets.filter(F.col("n") >= floor).select("bucket")
            if heavy.count() <= BROADCAST_VOCAB_ROWS:
                marks = GR.bucket_marks(heavy, self.size)
        lists = GR.word_lists(self.docs, self.by_review, self.words_col)
        return written(GR.gram_counts(lists, *self.range, bool(self.by_review), marks), "term-counts" if self.by_review else "term-totals")

    def first(self, wanted: int, low: float = 1, high: float | None = None, ranges: dict[tuple, int] | None = None) -> DataFrame:
        """A written table that holds the first ``wanted`` terms by cf, or by df if ``by_review``, with a df of ``low`` to
        ``high``; ``ranges`` (lo, hi) -> wanted: the first terms of each range of orders, (lo, hi, count) -> wanted: by that count."""
        by, least = ("df", max(1, math.ceil(low))) if self.by_review else ("cf", 1)
        floor = least if self.buckets is None else max(least, _least_of_top(self.buckets, 2 * wanted, "n")[0] or 1)
        while True:
            got = self._counts(floor)
            if floor <= least:
                return got
            own = got.filter(F.col("df") <= F.lit(high)) if high is not None and self.by_review else got
            parts = [(own, wanted, by)] if ranges is None else [
                (own.filter(self.order.between(*r[:2])), n, r[2] if len(r) > 2 else by) for r, n in ranges.items()]
            found = [_least_of_top(*part) for part in parts]
            reached = min(max(least, x) if enough else least for x, enough in found)
            if floor <= reached:
                return got
            floor = reached


def known_counts(docs: DataFrame, vocab: DataFrame, lo: int, hi: int, max_features: int | None, analyzer: str = "word",
                 keep_cols: tuple[str, ...] = (), id_col: str = "id", words_col: str = "words") -> DataFrame:
    """(id, *keep_cols, idx, tf): counts of the terms of ``vocab`` (term, idx). Others are dropped before the
    aggregate, and only numbers are aggregated. Reviews are partitioned on id by the caller (``by_review``). Words are
    looked up in the vocabulary in Arrow batches, if it is bounded."""
    if max_features is not None and max_features <= BROADCAST_VOCAB_ROWS:
        return GR.known_grams(GR.word_lists(docs, (id_col, *keep_cols), words_col, analyzer), vocab, lo, hi, analyzer)
    grams = docs.select(id_col, *keep_cols, F.explode(doc_grams(F.col(words_col), lo, hi, analyzer)).alias("term"))
    return (grams.join(bounded_broadcast(vocab.select("term", "idx"), max_features), "term").groupBy(id_col, *keep_cols, "idx")
            .agg(F.count(F.lit(1)).alias("tf")))


#: Candidates for a vocabulary with a document-frequency window, for each term wanted.
CANDIDATES = 1.25


def fit_counts(docs: DataFrame, n_docs: int, lo: int, hi: int, max_features: int, min_df: int | float = 1, max_df: int | float = 1.0,
               analyzer: str = "word", keep_cols: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The vocabulary (term, idx, df, cf, idf) and the counts (id, *keep_cols, idx or term, tf) of its terms.

    Terms are ranked by their occurrences alone; then the reviews are read again and only candidates are counted by
    review, which gives their document frequencies. Where the window leaves fewer terms than wanted, the candidates
    are doubled, so the result is that of a window over all terms. Occurrences of character n-grams come from those of
    the words that hold them."""
    low, high = _doc_count_bound(min_df, n_docs), _doc_count_bound(max_df, n_docs)
    open_ = low <= 1 and high >= n_docs
    counted = Counted(docs, n_docs, lo, hi) if analyzer == "word" else None
    chars = None if counted else written(GR.char_totals(docs, lo, hi), "term-totals")
    wanted = max_features if open_ else int(CANDIDATES * max_features)
    in_order = Window.orderBy("term")  # as many rows as candidates
    while True:
        totals = counted.first(wanted) if counted else chars
        some = written(top_terms(totals, wanted).withColumn("idx", (F.row_number().over(in_order) - 1).cast("int")), "candidates")
        counts = written(known_counts(docs, some, lo, hi, wanted, analyzer, keep_cols), "known-counts")
        df = counts.groupBy("idx").agg(F.count(F.lit(1)).alias("df"))
        stats = some.join(df, "idx").filter((F.col("df") >= F.lit(low)) & (F.col("df") <= F.lit(high)))
        if open_:
            return written(with_smooth_idf(stats.select("term", "idx", "df", "cf"), n_docs), "vocabulary"), counts
        stats = written(stats, "candidates-kept")
        if stats.count() >= max_features or some.count() < wanted:
            break
        wanted *= 2
    best = Window.orderBy(F.col("cf").desc(), "term")
    kept = stats.withColumn("_rk", F.row_number().over(best)).filter(F.col("_rk") <= max_features).withColumn(
        "new", (F.row_number().over(in_order) - 1).cast("int"))
    kept = written(kept.select("idx", "new", "term", "df", "cf"), "vocabulary-kept")
    counts = counts.join(bounded_broadcast(kept.select("idx", "new"), max_features), "idx").select(
        "id", *keep_cols, F.col("new").alias("idx"), "tf")
    return with_smooth_idf(kept.select("term", F.col("new").alias("idx"), "df", "cf"), n_docs), counts


def with_smooth_idf(vocab: DataFrame, n_docs: int) -> DataFrame:
    """idf = ln((1 + n) / (1 + df)) + 1."""
    return vocab.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))


def _in_vocab(tf: DataFrame, vocab: DataFrame, max_features, cols) -> DataFrame:
    if set(cols) <= set(tf.columns) and "term" in tf.columns:  # counted within the vocabulary
        return tf
    if "idx" in tf.columns:
        return tf.join(bounded_broadcast(vocab.select("idx", "term", *(c for c in cols if c != "idx")), max_features), "idx")
    return tf.join(bounded_broadcast(vocab.select("term", *cols), max_features), "term")


def count_matrix(tf: DataFrame, vocab: DataFrame, max_features: int | None, id_col: str = "id",
                 binary: bool = False) -> DataFrame:
    """(id, term, idx, value) raw or 0/1 counts of vocabulary terms."""
    j = _in_vocab(tf, vocab, max_features, ["idx"])
    val = F.lit(1).cast("long") if binary else F.col("tf").cast("long")
    return j.select(id_col, "term", "idx", val.alias("value"))


def tfidf_matrix(tf: DataFrame, vocab_idf: DataFrame, max_features: int | None, id_col: str = "id",
                 sublinear: bool = True, norm: str | None = "l2") -> DataFrame:
    """(id, term, idx, value) with (1 + ln tf) * idf, then unit l2 norm per review.

    The norm is a window per review: a review's rows are bounded by the vocabulary size and
    tf is already partitioned by review id, so this adds no exchange."""
    if "idx" in tf.columns and "term" not in tf.columns:  # numbers only are exchanged for the norm; terms come after
        j = tf.join(bounded_broadcast(vocab_idf.select("idx", "idf"), max_features), "idx")
    else:
        j = _in_vocab(tf, vocab_idf, max_features, ["idx", "idf"])
    tfw = (F.lit(1.0) + F.log(F.col("tf").cast("double"))) if sublinear else F.col("tf").cast("double")
    named = ["term"] if "term" in j.columns else []
    w = j.select(id_col, *named, "idx", (tfw * F.col("idf")).alias("w"))
    if norm is None:
        out = w.withColumnRenamed("w", "value")
    elif norm == "l2":
        n2 = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
        out = w.select(id_col, *named, "idx", (F.col("w") / n2).alias("value"))
    else:
        raise ValueError(norm)
    return out if named else _in_vocab(out, vocab_idf, max_features, ["idx"]).select(id_col, "term", "idx", "value")


def fit_tfidf(docs: DataFrame, n_docs: int, lo: int, hi: int, max_features: int | None,
              min_df=1, max_df=1.0, id_col: str = "id", words_col: str = "words", analyzer: str = "word"):
    """Fit vocabulary + idf on ``docs`` and return (vocab_idf, feat)."""
    tf = term_frequencies(docs, id_col, words_col, lo, hi, analyzer)
    vocab = with_smooth_idf(vocabulary(tf, n_docs, max_features, min_df, max_df), n_docs)
    return vocab, tfidf_matrix(tf, vocab, max_features, id_col)


def gram_lattice(train: DataFrame, test: DataFrame | None, n_docs: int, configs: dict[str, tuple[int, int, int]],
                 raw: dict[str, tuple[int, int, int, str]] | None = None) -> dict[str, tuple]:
    """TF-IDF of several (lo, hi, max_features) over the same cleaned reviews: name -> (train, test, width), long
    (id, idx, value). N-grams of all orders are totalled once; every configuration's vocabulary is cut from that
    table, whose rankings are shared by configurations of one range; the reviews are counted once within the
    union of the vocabularies (at most the sum of their sizes). ``raw`` (lo, hi, max_features, cf or df): counts of the first
    terms by that count, name -> (vocabulary, train with labels, test), the counts long (id, idx, tf)."""
    raw = raw or {}
    wanted = {**{name: (*c, "cf") for name, c in configs.items()}, **raw}
    low, high = min(c[0] for c in wanted.values()), max(c[1] for c in wanted.values())
    order = F.size(F.split("term", " "))
    ranges = {r: max(c[2] for c in wanted.values() if (*c[:2], c[3]) == r) for r in {(*c[:2], c[3]) for c in wanted.values()}}
    both = any(by == "df" for _, _, by in ranges)
    counted = Counted(train, n_docs, low, high, by_review=("id",) if both else (), both=both)
    totals = counted.first(max(ranges.values()), ranges=ranges).withColumn("order", order)
    in_order = Window.orderBy("term")  # as many rows as terms wanted
    vocabs: dict[str, DataFrame] = {}
    for lo, hi, by in sorted(ranges):
        top = written(top_terms(totals.filter(F.col("order").between(lo, hi)), ranges[lo, hi, by], by, keep_rank=True), "lattice-terms")
        for name, c in wanted.items():
            if (*c[:2], c[3]) == (lo, hi, by):
                vocabs[name] = top.filter(F.col("_rk") < c[2]).withColumn("idx", (F.row_number().over(in_order) - 1).cast("int")).select("term", "idx")
    union = None
    for v in vocabs.values():
        union = v.select("term") if union is None else union.unionByName(v.select("term"))
    size = sum(c[2] for c in wanted.values())
    union = written(union.distinct().withColumn("idx", (F.row_number().over(in_order) - 1).cast("int")), "lattice")
    labelled = written(known_counts(train, union, low, high, size, keep_cols=("label",) if raw else ()), "lattice-counts")
    counts = labelled.select("id", "idx", "tf")
    if raw and train.select("id").distinct().count() < n_docs:  # an id with several labels is one review of the matrix
        counts = written(counts.groupBy("id", "idx").agg(F.sum("tf").alias("tf")), "lattice-counts")
    known = None if test is None else written(known_counts(test, union, low, high, size), "lattice-test")
    df = counts.groupBy("idx").agg(F.count(F.lit(1)).alias("df"))
    union = written(with_smooth_idf(union.join(df, "idx"), n_docs), "lattice-idf")
    out = {}
    for name, v in vocabs.items():
        own = written(v.withColumnRenamed("idx", "new").join(union, "term").select("term", "new", "idx", "idf"), "vocabulary")
        mf, vocab = wanted[name][2], own.select("term", F.col("new").alias("idx"), "idf")

        def cut(c, own=own, mf=mf):
            return c.join(bounded_broadcast(own.select("idx", "new"), mf), "idx").drop("idx").withColumnRenamed("new", "idx")

        if name in raw:
            out[name] = vocab.select("term", "idx"), cut(labelled), None if known is None else cut(known)
            continue
        weigh = lambda c: tfidf_matrix(cut(c), vocab, mf).select("id", "idx", "value")
        out[name] = weigh(counts), None if known is None else weigh(known), own.count()
    return out


def nb_class_sums(tf_labeled: DataFrame, vocab: DataFrame, max_features: int | None,
                  binary: bool = True, label_col: str = "label") -> DataFrame:
    """(term, idx, pos, neg): per-class sums of 0/1 presence (or raw counts) per vocab term."""
    j = _in_vocab(tf_labeled, vocab, max_features, ["idx"])
    x = F.lit(1).cast("long") if binary else F.col("tf").cast("long")
    return j.groupBy("term", "idx").agg(
        F.sum(F.when(F.col(label_col) == 1, x).otherwise(F.lit(0).cast("long"))).alias("pos"),
        F.sum(F.when(F.col(label_col) == 0, x).otherwise(F.lit(0).cast("long"))).alias("neg"))


def nb_log_ratio(class_sums: DataFrame, alpha: float = 1.0) -> DataFrame:
    """r = ln((p/|p|_1) / (q/|q|_1)), p = alpha + positive sums, q = alpha + negative sums.
    The two totals are one scalar aggregate (two numbers reach the driver); the sums, a row for each term of the
    vocabulary, are written first, so that reviews are not read again for the ratios."""
    class_sums = written(class_sums, "class-sums")
    p = F.col("pos") + F.lit(alpha)
    q = F.col("neg") + F.lit(alpha)
    tot = class_sums.agg(F.sum(p).alias("sp"), F.sum(q).alias("sq")).first()
    sp, sq = float(tot["sp"] or 1.0), float(tot["sq"] or 1.0)
    return class_sums.select("term", "idx", F.log((p / F.lit(sp)) / (q / F.lit(sq))).alias("r"))


def nb_log_ratio_clipped(class_sums: DataFrame, bound: float = 5.0) -> DataFrame:
    """clip(ln((pos + 1) / (neg + 1)), -bound, bound) — no class totals."""
    r = F.log((F.col("pos") + 1.0) / (F.col("neg") + 1.0))
    return class_sums.select("term", "idx", F.greatest(F.least(r, F.lit(bound)), F.lit(-bound)).alias("r"))


def nb_weighted(binary_feat: DataFrame, ratios: DataFrame, id_col: str = "id",
                max_features: int | None = None) -> DataFrame:
    """0/1 presence times r, per (review, term). ``ratios`` is vocabulary sized; it is
    broadcast only when ``max_features`` bounds it."""
    return (binary_feat.join(bounded_broadcast(ratios.select("idx", "r"), max_features), "idx")
            .select(id_col, "term", "idx", (F.col("value") * F.col("r")).alias("value")))


def lexicon_counts(words: Column, positive, negative, negation) -> list[Column]:
    """Distinct-word hits and the negation-adjusted pair."""
    d = F.array_distinct(words)

    def hits(lst):
        return F.size(F.array_intersect(d, F.array(*[F.lit(x) for x in lst]))).cast("long")

    pos, neg, ngt = hits(positive), hits(negative), hits(negation)
    return [pos.alias("pos"), neg.alias("neg"), ngt.alias("negation"),
            (pos - ngt).alias("eff_pos"), (neg + ngt).alias("eff_neg")]


def hstack(blocks: list[tuple[DataFrame, int]], id_col: str = "id") -> DataFrame:
    """Union long blocks (id, idx, value); block k's indices shifted by the widths before it."""
    out, offset = None, 0
    for feat, width in blocks:
        b = feat.select(id_col, (F.col("idx") + F.lit(offset)).cast("int").alias("idx"),
                        F.col("value").cast("double").alias("value"))
        out = b if out is None else out.unionByName(b)
        offset += int(width)
    return out


def dense_block(df: DataFrame, cols: list[str], id_col: str = "id") -> DataFrame:
    """Turn a few numeric columns into long (id, idx, value) rows, zeros dropped."""
    arr = F.array(*[F.struct(F.lit(i).alias("idx"), F.col(c).cast("double").alias("value"))
                    for i, c in enumerate(cols)])
    return (df.select(id_col, F.explode(arr).alias("e"))
            .select(id_col, "e.idx", "e.value").filter(F.col("value") != 0))
