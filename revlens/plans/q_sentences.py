"""Catalog: trained sentence boundaries (C2, trained form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.operators import boundaries as B
from revlens.plans import duck as D
from revlens.plans.q_corpus import _DOCS_SQL, _sent_out
from revlens.plans.registry import query
from revlens.session import written
from revlens.sources import tables


def _cell(o: str, r: str, c: str, t: str) -> str:
    return f"(CASE WHEN {o} > 0 THEN {o} * ln(CAST({o} AS DOUBLE) * {t} / (CAST({r} AS DOUBLE) * {c})) ELSE 0 END)"


def _llr(a: str, b: str, ab: str, t: str) -> str:
    return (f"2 * ({_cell(ab, a, b, t)} + {_cell(f'({a}-{ab})', a, f'({t}-{b})', t)} + "
            f"{_cell(f'({b}-{ab})', f'({t}-{a})', b, t)} + {_cell(f'({t}-{a}-{b}+{ab})', f'({t}-{a})', f'({t}-{b})', t)})")


# Every word as a row, its neighbour by a window over its line, decisions row by row.
_TOKENS_SQL = f"""
WITH src AS (SELECT row_number() OVER () AS rid, review_id, {D.html_text(D.text('text'))} AS h FROM ({_DOCS_SQL}) s),
ln AS (SELECT rid, generate_subscripts(p, 1) AS line_no, unnest(p) AS line FROM (SELECT rid, string_split(h, chr(10)) AS p FROM src) x),
tk AS (SELECT rid, line_no, generate_subscripts(p, 1) AS tok_no, unnest(p) AS w FROM (
  SELECT rid, line_no, list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS p FROM ln) x),
sg AS (SELECT rid, line_no, tok_no, w, regexp_extract(w, '([.!?]+)[)"''\\]}}]*$', 1) AS run,
         regexp_extract(w, '([.!?]*)[)"''\\]}},;:]*$', 1) = '.' AS dot,
         regexp_replace(regexp_replace(w, '^[("''\\[{{]+', ''), '[)"''\\]}},;:.!?]+$', '') AS body FROM tk),
tok AS (SELECT rid, line_no, tok_no, w, dot, lower(body) AS typ,
          CASE WHEN run = '' THEN 'none' WHEN run = '.' THEN 'dot' WHEN contains(run, '!') OR contains(run, '?') THEN 'bang' ELSE 'ellipsis' END AS term,
          CASE WHEN regexp_matches(body, '^\\p{{Lu}}') THEN 'upper' WHEN regexp_matches(body, '^\\p{{Ll}}') THEN 'lower' ELSE 'other' END AS cs FROM sg),
sq AS (SELECT *, lag(term) OVER o AS pt, lag(typ) OVER o AS ptyp FROM tok WINDOW o AS (PARTITION BY rid, line_no ORDER BY tok_no)),
tot AS (SELECT count(*) AS n, count(*) FILTER (WHERE dot) AS d FROM tok),
ty AS (SELECT typ, count(*) FILTER (WHERE dot) AS k, count(*) AS n FROM tok WHERE regexp_matches(typ, '^\\p{{L}}+(\\.\\p{{L}}+)*$') GROUP BY typ),
abbr AS (SELECT * FROM (SELECT typ, k, ty.n AS n,
    2 * (k * ln({B.PERIOD_AFTER_ABBREVIATION} * tot.n / tot.d) + (ty.n - k) * ln((1 - {B.PERIOD_AFTER_ABBREVIATION}) * tot.n / (tot.n - tot.d)))
    * exp(-length(replace(typ, '.', ''))) * (length(typ) - length(replace(typ, '.', '')) + 1)
    * pow(CAST(length(replace(typ, '.', '')) AS DOUBLE), -(ty.n - k)) AS score
  FROM ty CROSS JOIN tot WHERE k > 0 AND tot.d > 0 AND tot.d < tot.n) x WHERE score >= {B.ABBREVIATION_SCORE})"""

_DECIDED_SQL = _TOKENS_SQL + f""",
kd AS (SELECT sq.*, CASE WHEN regexp_matches(ptyp, '^\\p{{L}}$') THEN 'initial' WHEN regexp_matches(ptyp, '^[0-9]+([.,][0-9]+)*$') THEN 'number'
    WHEN ptyp IN (SELECT typ FROM abbr) THEN 'abbreviation' ELSE 'plain' END AS kind FROM sq),
hb AS (SELECT typ, count(*) AS n, count(*) FILTER (WHERE cs = 'lower') AS lo, count(*) FILTER (WHERE cs = 'upper') AS up,
    count(*) FILTER (WHERE cs = 'upper' AND pt = 'none') AS up_in,
    count(*) FILTER (WHERE cs = 'lower' AND (pt IS NULL OR pt = 'bang' OR (pt = 'dot' AND kind = 'plain'))) AS lo_begin,
    count(*) FILTER (WHERE pt = 'bang' OR (pt = 'dot' AND kind = 'plain')) AS fol FROM kd GROUP BY typ),
en AS (SELECT sum(fol) AS e, sum(n) AS t FROM hb),
st AS (SELECT hb.*, regexp_matches(typ, '^\\p{{L}}+(\\.\\p{{L}}+)*$') AND fol > 0 AND fol * t > n * e AND {_llr('e', 'n', 'fol', 't')} >= {B.STARTER_SCORE} AS starter
  FROM hb CROSS JOIN en),
od AS (SELECT * FROM kd WHERE pt = 'ellipsis' OR (pt = 'dot' AND kind <> 'plain')),
pr AS (SELECT ptyp, typ, count(*) AS m FROM od WHERE pt = 'dot' GROUP BY ptyp, typ),
fs AS (SELECT ptyp, count(*) AS m FROM od WHERE pt = 'dot' GROUP BY ptyp),
co AS (SELECT pr.ptyp, pr.typ FROM pr JOIN fs ON pr.ptyp = fs.ptyp JOIN hb ON hb.typ = pr.typ CROSS JOIN en
  WHERE pr.m > 1 AND regexp_matches(pr.typ, '^\\p{{L}}+(\\.\\p{{L}}+)*$') AND pr.m * t > fs.m * hb.n
    AND {_llr('fs.m', 'hb.n', 'pr.m', 't')} >= {B.COLLOCATION_SCORE}),
jn AS (SELECT od.rid, od.line_no, od.tok_no, od.ptyp, od.pt, od.typ, od.cs,
    CASE WHEN od.pt = 'dot' AND co.typ IS NOT NULL THEN 'collocation'
         WHEN (od.pt = 'ellipsis' OR kind = 'abbreviation') THEN
           CASE WHEN cs = 'upper' AND ((lo > 0 AND up_in = 0) OR starter) THEN NULL WHEN od.pt = 'ellipsis' THEN 'dots' ELSE 'abbreviation' END
         WHEN cs = 'lower' AND (up > 0 OR lo_begin = 0) THEN kind
         WHEN kind = 'initial' AND cs = 'upper' AND lo = 0 THEN 'initial' END AS reason
  FROM od JOIN st ON st.typ = od.typ LEFT JOIN co ON co.ptyp = od.ptyp AND co.typ = od.typ)"""


@query("abbreviations", _TOKENS_SQL + """
SELECT typ, CAST(k AS BIGINT) AS with_period, CAST(n AS BIGINT) AS n, round(score, 6) AS score FROM abbr""")
def abbreviations_q(spark, sf):
    """Abbreviations of the whole corpus with their scores."""
    found = B.abbreviations(written(B.context_counts(tables.documents(spark, sf)), "boundary-contexts"))
    return found.withColumn("score", F.round("score", 6))


@query("sentence_joins", _DECIDED_SQL + """
SELECT ptyp AS prev_typ, pt AS prev_term, typ, cs AS "case", reason, CAST(count(*) AS BIGINT) AS places
FROM jn WHERE reason IS NOT NULL GROUP BY ALL""")
def sentence_joins_q(spark, sf):
    """Contexts whose period or dots end no sentence, why, and how often they occur."""
    contexts = written(B.context_counts(tables.documents(spark, sf)), "boundary-contexts")
    counts = contexts.groupBy(*B.CONTEXT).agg(F.sum("n").alias("places"))
    return B.joined_contexts(contexts).join(counts, B.CONTEXT).select(*B.CONTEXT, "reason", "places")


@query("trained_sentences", _DECIDED_SQL + f""",
br AS (SELECT t.rid, t.line_no, t.tok_no, t.w,
    CASE WHEN t.pt IS NULL THEN 1 WHEN t.pt = 'none' THEN 0 WHEN j.reason IS NOT NULL THEN 0 ELSE 1 END AS starts
  FROM sq t LEFT JOIN jn j ON j.rid = t.rid AND j.line_no = t.line_no AND j.tok_no = t.tok_no),
gr AS (SELECT *, sum(starts) OVER (PARTITION BY rid ORDER BY line_no, tok_no) AS g FROM br),
pc AS (SELECT rid, g, string_agg(w, ' ' ORDER BY line_no, tok_no) AS p FROM gr GROUP BY rid, g),
sn AS (SELECT rid, g, {D.treebank(D.split(D.lower(D.letters('p'))))} AS words FROM pc)
SELECT review_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY g) - 1 AS BIGINT) AS sent_no,
       CAST(len(words) AS BIGINT) AS n_words, array_to_string(words, ' ') AS sentence
FROM sn JOIN src USING (rid) WHERE len(words) > 0""")
def trained_sentences_q(spark, sf):
    """Every review cut at the boundaries learned from all reviews."""
    return _sent_out(B.trained_sentences(tables.documents(spark, sf), "doc_id"))
