"""DuckDB SQL fragments for the oracle statements.

These are written independently of the Spark builders (different engine, different
function names); they only share the fixed word lists and rule lists.
"""

from __future__ import annotations

from revlens.functions import wordlists as W


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def inlist(words) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def rx(c: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({c}, {q(pattern)}, {q(repl)}, 'g')"


def rep(c: str, a: str, b: str) -> str:
    return f"replace({c}, {q(a)}, {q(b)})"


def text(c: str) -> str:
    return f"coalesce({c}, '')"


def lower(c):
    return f"lower({c})"


def html_text(c):
    c = rx(c, r"(?s)<!--.*?-->", "")
    c = rx(c, r"(?is)<script\b.*?</script>", "")
    c = rx(c, r"(?is)<style\b.*?</style>", "")
    c = rx(c, r"<[^>]+>", "")
    c = f"replace({c}, '&amp;', chr(1))"
    for ent, val in W.HTML_ENTITIES:
        c = rep(c, ent, val)
    c = rx(c, r"&[#a-zA-Z0-9]+;", " ")
    return f"replace({c}, chr(1), '&')"


def tags_space(c):
    return rx(c, r"<[^>]+>", " ")


def urls(c, http_only=False):
    return rx(c, r"http\S+" if http_only else r"http\S+|www\S+", " ")


def letters(c):
    return rx(c, r"[^a-zA-Z]", " ")


def letters_space(c):
    return rx(c, r"[^a-zA-Z\s]", " ")


def word_chars(c):
    return rx(c, r"[^\p{L}\p{N}_\s]", " ")


def contractions(c, rules):
    for a, b in rules:
        c = rep(c, a, b)
    return c


def pad(c, words):
    for w in words:
        c = rep(c, w, f" {w} ")
    return c


def exclaim(c):
    return rx(c, r"!+", " EXCLAMATION ")


def split(c):
    return f"list_filter(regexp_split_to_array({c}, '\\s+'), lambda x: x <> '')"


def drop(w, stop, keep=()):
    cond = f"x NOT IN {inlist(stop)}"
    if keep:
        cond += f" OR x IN {inlist(keep)}"
    return f"list_filter({w}, lambda x: {cond})"


def minlen(w, n, keep=()):
    cond = f"length(x) > {n}"
    if keep:
        cond += f" OR x IN {inlist(keep)}"
    return f"list_filter({w}, lambda x: {cond})"


def join(w):
    return f"array_to_string({w}, ' ')"


def strip(c):
    return rx(c, r"^\s+|\s+$", "")


def profile_tokens(name: str, col: str) -> str:
    c = text(col)
    if name == "letters":
        return split(lower(letters(html_text(c))))
    if name == "contract_stop":
        w = split(letters_space(contractions(lower(html_text(c)), W.RULES_R7)))
        return drop(w, W.STOP_LONG, W.NEGATION_KEEP_P2)
    if name == "contract":
        return split(letters_space(contractions(lower(html_text(c)), W.RULES_R5)))
    if name == "contract_ca_stop":
        w = split(letters_space(contractions(lower(html_text(c)), W.RULES_R8)))
        return drop(w, W.STOP_LONG, W.NEGATION_KEEP_P4)
    if name == "minstop_url":
        s = letters_space(urls(tags_space(contractions(lower(c), W.RULES_R2))))
        return minlen(drop(split(s), W.minus(W.MINIMAL_STOP, W.NEGATION_BASIC)), 1)
    if name == "minstop":
        s = letters_space(tags_space(contractions(lower(c), W.RULES_R1)))
        return minlen(drop(split(s), W.MINIMAL_STOP), 1)
    if name == "len3":
        s = letters_space(tags_space(contractions(lower(c), W.RULES_R1)))
        return minlen(split(s), 2)
    if name == "exclaim":
        s = letters_space(tags_space(exclaim(contractions(lower(c), W.RULES_R1))))
        return minlen(drop(split(s), W.minus(W.MINIMAL_STOP, W.NEGATION_ENSEMBLE)), 1)
    if name == "len2":
        s = letters_space(tags_space(contractions(lower(c), W.RULES_R2)))
        return minlen(split(s), 1)
    if name == "articles":
        s = letters_space(tags_space(contractions(lower(c), W.RULES_R2)))
        return minlen(drop(split(s), W.ARTICLES), 1)
    if name == "aggressive":
        s = pad(contractions(lower(c), W.RULES_R5AGG), W.PAD_AGGRESSIVE)
        return minlen(split(letters_space(tags_space(s))), 2, W.NEGATION_SHORT)
    if name == "padneg":
        s = pad(contractions(lower(c), W.RULES_R2), W.PAD_CALIBRATED)
        return minlen(split(letters_space(tags_space(s))), 1, W.NEGATION_SHORT)
    raise KeyError(name)


def profile_text(name: str, col: str) -> str:
    if name == "wordchars":
        return strip(word_chars(urls(tags_space(lower(text(col))), http_only=True)))
    return join(profile_tokens(name, col))


def word_ngrams(w: str, lo: int, hi: int) -> str:
    """Contiguous n-grams lo..hi of list ``w`` joined by one space, n-major order."""
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(w)
        else:
            parts.append(
                f"list_transform(range(1, greatest(len({w}) - {n} + 2, 1)), "
                f"lambda i: array_to_string(list_slice({w}, i, i + {n - 1}), ' '))")
    return parts[0] if len(parts) == 1 else "list_concat(" + ", ".join(parts) + ")"


def char_wb_ngrams(w: str, lo: int, hi: int) -> str:
    parts = []
    for n in range(lo, hi + 1):
        cond = "true" if n == lo else f"length(z) + 2 >= {n}"
        parts.append(
            f"flatten(list_transform(list_filter({w}, lambda z: {cond}), lambda z: "
            f"list_transform(range(1, greatest(length(z) + 3 - {n}, 1) + 1), "
            f"lambda i: substring(' ' || z || ' ', i, {n}))))")
    return parts[0] if len(parts) == 1 else "list_concat(" + ", ".join(parts) + ")"


def treebank(w: str) -> str:
    cases = " ".join(f"WHEN x = {q(f)} THEN [{', '.join(q(p) for p in ps)}]" for f, ps in W.TREEBANK_SPLITS)
    return f"flatten(list_transform({w}, lambda x: CASE {cases} ELSE [x] END))"


def vec_tokens(w: str) -> str:
    return f"list_filter(list_transform({w}, lambda x: lower(x)), lambda x: length(x) > 1)"


def sentences(col: str, mode: str) -> str:
    """LIST<LIST<VARCHAR>> of a review's non-empty sentences."""
    if mode == "clean_first":
        return f"list_filter([{treebank(profile_tokens('letters', col))}], lambda s: len(s) > 0)"
    pieces = (f"list_filter(regexp_split_to_array({html_text(text(col))}, '[.!?\\n]+'), "
              f"lambda p: trim(p) <> '')")
    return (f"list_filter(list_transform({pieces}, lambda p: "
            f"{treebank(split(lower(letters('p'))))}), lambda s: len(s) > 0)")


LABELED_DOCS = "SELECT d.doc_id AS id, d.text, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id"


def fit_ctes(profile: str, lo: int, hi: int, max_features, min_df=1, max_df=1.0,
             analyzer: str = "word", binary: bool = False, docs_sql: str = LABELED_DOCS,
             prefix: str = "", carry: tuple[str, ...] = ("label",)) -> str:
    """CTE list (no leading WITH) defining {p}docs(id, label, words), {p}tf(id, label, term, tf),
    {p}nd(n), {p}vocab(term, idx, df, cf, idf)."""
    p = prefix
    toks = vec_tokens("words") if analyzer == "word" else "list_transform(words, lambda x: lower(x))"
    grams = word_ngrams("g", lo, hi) if analyzer == "word" else char_wb_ngrams("g", lo, hi)
    lo_b = str(min_df) if isinstance(min_df, int) else f"CAST({min_df!r} AS DOUBLE) * (SELECT n FROM {p}nd)"
    hi_b = str(max_df) if isinstance(max_df, int) else f"CAST({max_df!r} AS DOUBLE) * (SELECT n FROM {p}nd)"
    rank = "df" if binary else "cf"
    limit = f"ORDER BY {rank} DESC, term LIMIT {max_features}" if max_features else ""
    c = ", ".join(("id",) + tuple(carry))
    return f"""{p}docs AS (SELECT {c}, {profile_tokens(profile, 'text')} AS words FROM ({docs_sql}) s),
{p}gtok AS (SELECT {c}, {toks} AS g FROM {p}docs),
{p}grams AS (SELECT {c}, unnest({grams}) AS term FROM {p}gtok),
{p}tf AS (SELECT {c}, term, count(*) AS tf FROM {p}grams GROUP BY {c}, term),
{p}nd AS (SELECT count(*) AS n FROM {p}docs),
{p}stats AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM {p}tf GROUP BY term),
{p}top AS (SELECT * FROM {p}stats WHERE df >= {lo_b} AND df <= {hi_b} {limit}),
{p}vocab AS (SELECT term, df, cf, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx,
        ln((1.0 + (SELECT n FROM {p}nd)) / (1.0 + df)) + 1.0 AS idf FROM {p}top)"""


def tfidf_cte(tf: str, vocab: str, name: str) -> str:
    return f"""{name}_w AS (SELECT t.id, t.term, v.idx, (1.0 + ln(t.tf)) * v.idf AS w FROM {tf} t JOIN {vocab} v ON t.term = v.term),
{name} AS (SELECT id, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS value FROM {name}_w)"""
