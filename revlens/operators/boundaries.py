"""Sentence boundaries learned from the corpus without labels (C2, trained form).

After Kiss and Strunk, "Unsupervised Multilingual Sentence Boundary Detection" (2006): abbreviations,
collocations across a period and frequent sentence starters are found by log-likelihood ratios over the
whole corpus, and each terminator is then decided by them and by how the next word is written elsewhere.

Everything is counted from one table: a word with its case and what stands before it. The word before is
kept only where it ends in a period, so the table has few rows beside the words themselves, and no window
over the corpus is needed. Texts meet only the contexts that are *not* a boundary.

Defined results: a null or empty text has no sentence; repeated rows give repeated sentences; a line end is
always a boundary; a corpus without a period, or of nothing but words with one, has no abbreviations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.functions.ngrams import let, treebank_word_split
from revlens.operators.embed import BROADCAST_BYTES, _met
from revlens.session import written

# Fixed values of the paper: least scores of an abbreviation, a collocation and a sentence starter, and the
# probability of a period after an abbreviation.
ABBREVIATION_SCORE = 0.3
COLLOCATION_SCORE = 7.88
STARTER_SCORE = 30.0
PERIOD_AFTER_ABBREVIATION = 0.99

SPACES = r"[\x20\x09-\x0D]+"
OPENING = r"^[(\"'\[{]+"
CLOSING = r"[)\"'\]},;:.!?]+$"
WORD = r"^\p{L}+(\.\p{L}+)*$"
NUMBER = r"^[0-9]+([.,][0-9]+)*$"
INITIAL = r"^\p{L}$"
PLAIN = r"^\p{L}+$"


def _signs(w: Column, last: Column) -> Column:
    """What a word shows: its type, how it ends, whether one period follows its letters, its case. Most words are
    letters only and need no more than one look; what several fields use is bound once."""
    def case(body):
        return F.when(body.rlike(r"^\p{Lu}"), "upper").when(body.rlike(r"^\p{Ll}"), "lower").otherwise("other").alias("case")

    plain = F.struct(w.alias("w"), F.lower(w).alias("typ"), F.lit("none").alias("term"), F.lit(False).alias("dot"),
                     case(w), last.alias("last"))
    parts = F.struct(F.regexp_extract(w, r"([.!?]+)[)\"'\]}]*$", 1).alias("run"),
                     F.regexp_replace(F.regexp_replace(w, OPENING, ""), CLOSING, "").alias("body"))
    marked = let(parts, lambda x: F.struct(
        w.alias("w"), F.lower(x["body"]).alias("typ"),
        F.when(x["run"] == "", "none").when(x["run"].rlike("[!?]"), "bang").when(x["run"] == ".", "dot")
        .otherwise("ellipsis").alias("term"),
        (F.regexp_extract(w, r"([.!?]*)[)\"'\]},;:]*$", 1) == ".").alias("dot"), case(x["body"]), last.alias("last")))
    return F.when(w.rlike(PLAIN), plain).otherwise(marked)


def review_tokens(text: Column) -> Column:
    """ARRAY<STRUCT<w, typ, term, dot, case, last>>: the words of a text in order; ``last`` ends a line."""
    lines = F.split(T.html_text(T.text_or_empty(text)), "\n")
    return F.flatten(F.transform(lines, lambda line: let(
        F.filter(F.split(line, SPACES), lambda w: w != ""),
        lambda ws: F.transform(ws, lambda w, i: _signs(w, i == F.size(ws) - 1)))))


def _followed(tokens: str = "tokens") -> Column:
    """Each word with its number and what stands before it on its line: how the word before ends ('line' if there is
    none) and, where that is a period or dots, its type."""
    def place(t, i):
        before = F.when(i > 0, F.element_at(tokens, i))  # 1-based: the word at i - 1
        first = F.coalesce(before["last"], F.lit(True))
        term = F.when(first, "line").otherwise(before["term"])
        return F.struct(i.cast("long").alias("pos"), t["typ"].alias("typ"), t["case"].alias("case"), t["dot"].alias("dot"),
                        term.alias("prev_term"),
                        F.when(term.isin("dot", "ellipsis"), before["typ"]).otherwise("").alias("prev_typ"))
    return F.transform(tokens, place)


CONTEXT = ["prev_typ", "prev_term", "typ", "case"]


def context_counts(reviews: DataFrame, text_col: str = "text") -> DataFrame:
    """(prev_typ, prev_term, typ, case, dot, n): the one aggregate over the corpus, summed per task first."""
    return (reviews.select(review_tokens(F.col(text_col)).alias("tokens"))
            .select(F.explode(_followed()).alias("t")).select("t.*")
            .groupBy(*CONTEXT, "dot").agg(F.count(F.lit(1)).alias("n")))


def _cell(observed: Column, row: Column, col: Column, total: Column) -> Column:
    return F.when(observed > 0, observed * F.log(observed * total / (row * col))).otherwise(0.0)


def log_likelihood(a: Column, b: Column, ab: Column, total: Column) -> Column:
    """Dunning's log-likelihood ratio of two events seen a and b times, ab times together, in ``total`` places."""
    a, b, ab, total = (c.cast("double") for c in (a, b, ab, total))
    return 2 * (_cell(ab, a, b, total) + _cell(a - ab, a, total - b, total)
                + _cell(b - ab, total - a, b, total) + _cell(total - a - b + ab, total - a, total - b, total))


def abbreviations(contexts: DataFrame) -> DataFrame:
    """(typ, with_period, n, score): types that a period follows too often for a sentence end. Long types and types
    that also stand without it score less, inner periods score more."""
    sums = contexts.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("dot"), F.col("n")).otherwise(0)).alias("d")).first()
    total, dots = sums["n"] or 0, sums["d"] or 0
    types = (contexts.filter(F.col("typ").rlike(WORD)).groupBy("typ")
             .agg(F.sum(F.when(F.col("dot"), F.col("n")).otherwise(0)).alias("with_period"), F.sum("n").alias("n"))
             .filter(F.col("with_period") > 0))
    if not 0 < dots < total:
        return types.select("typ", "with_period", "n", F.lit(0.0).alias("score")).limit(0)
    p, q = dots / total, PERIOD_AFTER_ABBREVIATION
    k, rest = F.col("with_period").cast("double"), (F.col("n") - F.col("with_period")).cast("double")
    ratio = 2 * (k * F.log(F.lit(q) / p) + rest * F.log(F.lit(1 - q) / (1 - p)))
    inner = F.length("typ") - F.length(F.replace("typ", F.lit("."), F.lit("")))
    letters = (F.length("typ") - inner).cast("double")
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -rest)
    return types.select("typ", "with_period", "n", score.alias("score")).filter(F.col("score") >= ABBREVIATION_SCORE)


def _with_kind(contexts: DataFrame, abbr: DataFrame) -> DataFrame:
    """Contexts with the kind of the word before: abbreviation, initial, number or plain. An abbreviation of one
    letter is an initial."""
    known = abbr.select(F.col("typ").alias("prev_typ"), F.lit(True).alias("known"))
    return (contexts.join(known, "prev_typ", "left")
            .withColumn("kind", F.when(F.col("prev_typ").rlike(INITIAL), "initial").when(F.col("prev_typ").rlike(NUMBER), "number")
                        .when(F.col("known"), "abbreviation").otherwise("plain")).drop("known"))


def word_habits(kinds: DataFrame) -> DataFrame:
    """(typ, n, lower, upper, upper_inside, lower_begin, after_end): how each type is written at the beginning of
    sentences and inside them, by the boundaries that are plain to see, and how often it follows one on a line."""
    plain_end = (F.col("prev_term") == "bang") | ((F.col("prev_term") == "dot") & (F.col("kind") == "plain"))
    begins, inside = plain_end | (F.col("prev_term") == "line"), F.col("prev_term") == "none"

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))
    upper, lower = F.col("case") == "upper", F.col("case") == "lower"
    return kinds.groupBy("typ").agg(F.sum("n").alias("n"), total(lower).alias("lower"), total(upper).alias("upper"),
                                    total(upper & inside).alias("upper_inside"), total(lower & begins).alias("lower_begin"),
                                    total(plain_end).alias("after_end"))


def joined_contexts(contexts: DataFrame) -> DataFrame:
    """(prev_typ, prev_term, typ, case, reason): the contexts whose period or dots end no sentence.

    A collocation (7.88 or more) after an abbreviation, initial or number is joined. After an abbreviation or dots a
    boundary needs evidence: a capital on a word that is written small elsewhere and never capital inside a sentence, or a
    capital on a frequent sentence starter (30 or more). After an initial or number a joint needs evidence: a small
    word that is known in capitals or never begins a sentence small, or after an initial a capital on a word that is
    never small."""
    kinds = written(_with_kind(contexts.groupBy(*CONTEXT).agg(F.sum("n").alias("n")), abbreviations(contexts)), "boundary-kinds")
    habits = word_habits(kinds)
    sums = habits.agg(F.sum("n").alias("n"), F.sum("after_end").alias("ends")).first()
    total, ends = F.lit(sums["n"] or 0), F.lit(sums["ends"] or 0)
    starts = log_likelihood(ends, F.col("n"), F.col("after_end"), total)
    habits = habits.select(
        "typ", F.col("n").alias("typ_n"), "lower", "upper", "upper_inside", "lower_begin",
        (F.col("typ").rlike(WORD) & (F.col("after_end") > 0) & (starts >= STARTER_SCORE)
         & (F.col("after_end") * total > F.col("n") * ends)).alias("starter"))
    open_ends = kinds.filter((F.col("prev_term") == "ellipsis") | ((F.col("prev_term") == "dot") & (F.col("kind") != "plain")))
    dotted = open_ends.filter(F.col("prev_term") == "dot")
    pairs = dotted.groupBy("prev_typ", "typ").agg(F.sum("n").alias("pair_n"))
    firsts = dotted.groupBy("prev_typ").agg(F.sum("n").alias("prev_n"))
    tied = (pairs.filter((F.col("pair_n") > 1) & F.col("typ").rlike(WORD)).join(firsts, "prev_typ")
            .join(habits.select("typ", "typ_n"), "typ")
            .filter((log_likelihood(F.col("prev_n"), F.col("typ_n"), F.col("pair_n"), total) >= COLLOCATION_SCORE)
                    & (F.col("pair_n") * total > F.col("prev_n") * F.col("typ_n")))
            .select("prev_typ", "typ", F.lit("dot").alias("prev_term"), F.lit(True).alias("tied")))
    small, capital = F.col("case") == "lower", F.col("case") == "upper"
    surely = capital & (F.col("lower") > 0) & (F.col("upper_inside") == 0)
    hardly = small & ((F.col("upper") > 0) | (F.col("lower_begin") == 0))
    weak = (F.col("prev_term") == "ellipsis") | (F.col("kind") == "abbreviation")
    reason = (F.when(F.col("tied"), "collocation")
              .when(weak & ~(surely | (capital & F.col("starter"))), F.when(F.col("prev_term") == "ellipsis", "dots").otherwise("abbreviation"))
              .when(~weak & hardly, F.col("kind"))
              .when((F.col("kind") == "initial") & (F.col("prev_term") == "dot") & capital & (F.col("lower") == 0), "initial"))
    return (open_ends.join(tied, ["prev_typ", "typ", "prev_term"], "left").join(habits, "typ")
            .withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(*CONTEXT, "reason"))


def trained_sentence_rows(reviews: DataFrame, joined: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(review_id, sent_no, words): texts cut at line ends and at terminators whose context is not in ``joined``,
    each piece cleaned to a-z words; pieces without a word are dropped and not numbered.

    Texts stay whole: only the positions after a period or dots leave them, meet the contexts (broadcast if measured as
    small, salted if not) and come back as one short list per text. The lists are measured too: small ones are broadcast
    and no text moves, else texts and lists meet by key; texts are cut after that, so no array of words is exchanged."""
    texts = reviews.select(F.col(id_col).cast("string").alias("review_id"), F.col(text_col).alias("text"),
                           F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_key"))
    tokens = review_tokens(F.col("text")).alias("tokens")
    key = F.concat_ws("\x01", *CONTEXT)
    places = (texts.select("review_id", "text_key", tokens)
              .select("review_id", "text_key", F.explode(F.filter(_followed(), lambda t: t["prev_term"].isin("dot", "ellipsis"))).alias("t"))
              .select("review_id", "text_key", "t.*").select("review_id", "text_key", "pos", key.alias("word")))
    table = joined.select(key.alias("word"))
    held = written(_met(places, table, "text_key", F.octet_length("word") + 16)
                   .groupBy("review_id", "text_key").agg(F.collect_set(F.col("pos").cast("int")).alias("held"))
                   .select(F.col("review_id").alias("held_id"), F.col("text_key").alias("held_key"), "held"), "boundary-held")
    if (held.agg(F.sum(4 * F.size("held") + 96)).first()[0] or 0) <= BROADCAST_BYTES:
        held = F.broadcast(held)
    ends = F.filter(F.transform("tokens", lambda t, i: F.when(t["last"] | (t["term"] != "none"), i + 1)), lambda e: e.isNotNull())
    whole = texts.join(held, F.col("review_id").eqNullSafe(F.col("held_id")) & (F.col("text_key") == F.col("held_key")), "left")
    cuts = whole.select("review_id", "held", tokens).select(
        "review_id", "tokens", F.array_except(ends, F.coalesce("held", F.array().cast("array<int>"))).alias("ends"))

    def piece(e, i):
        start = F.when(i > 0, F.element_at("ends", i)).otherwise(0)
        return F.array_join(F.transform(F.slice("tokens", start + 1, e - start), lambda t: t["w"]), " ")
    pieces = F.transform("ends", lambda e, i: treebank_word_split(T.split_words(T.str_lower(T.letters_only(piece(e, i))))))
    return cuts.select("review_id", F.posexplode(F.filter(pieces, lambda s: F.size(s) > 0)).alias("sent_no", "words"))


def trained_sentences(reviews: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """Boundaries learned from all of ``reviews`` and applied to them."""
    contexts = written(context_counts(reviews, text_col), "boundary-contexts")
    return trained_sentence_rows(reviews, written(joined_contexts(contexts), "boundary-joined"), id_col, text_col)
