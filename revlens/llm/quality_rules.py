"""Quality rules: counts of a text's own words, and how often its lines stand in its host's documents.

Every line with a word is normalised (A-Z lower-cased, its words joined by single spaces) and named by
128 bits of a hash. Of each host (``source``) the distinct documents that hold a line are counted. A line is
above the limits if it stands in more than ``MIN_DOCS`` documents of the host and in more than
``MAX_PERCENT`` percent of them; such lines are removed. A document is depleted, and rejected, if fewer than
``LEFT_PERCENT`` percent of its words are left, or, where lines were removed, fewer than ``MIN_WORDS``.

Before that, the base rules: at least ``MIN_WORDS`` words, and at most ``REPEAT_PERCENT`` percent of them in
windows of ``WINDOW`` words that occur again in the text. Words are compared as they are: windows that agree in a
hash are compared word by word.

Scale: one narrow pass reads the texts and leaves counts and line names, a tenth of the bytes; texts are
not shuffled. Lines are counted per task first. What is joined back are only lines above the limits; a host can
have at most 100 / MAX_PERCENT times the lines of an average document of them. A frequent line is a hot key
of a join of two tables that are read, which adaptive execution splits, never of a collection.

Defined cases: a null text has no word and no line; a null source is a host of its own; documents
are distinct by doc_id, host and text, so that repeated rows count once and each gets the same result, a null
doc_id like any other; ties at a limit stay; an empty table gives an empty result; other columns are
ignored by ``judged`` and passed on by ``kept_texts``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import extended, fresh, slices, table
from revlens.session import written

WINDOW, MIN_WORDS, REPEAT_PERCENT = 8, 20, 30
MIN_DOCS, MAX_PERCENT, LEFT_PERCENT = 20, 1, 50
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
_STATS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
_LINES = "lines array<struct<a: bigint, b: bigint, n: bigint>>"


def _halves(digest: int) -> tuple[int, int]:
    a, b = digest >> 64, digest & (1 << 64) - 1
    return a - (a >> 63 << 64), b - (b >> 63 << 64)


def line_name(line: bytes) -> tuple[int, int]:
    """Two 64-bit halves of the hash of a normalised line."""
    import xxhash

    return _halves(xxhash.xxh3_128_intdigest(b" ".join(line.lower().split())))


def document_name(doc: int | None, host: str, text: bytes) -> tuple[int, int]:
    """Two 64-bit halves of the hash of what tells documents apart."""
    import xxhash

    return _halves(xxhash.xxh3_128_intdigest(f"{doc}\x00{len(host)}\x00{host}\x00".encode("utf-8", "surrogatepass") + text))


def _word_ids(raw: bytes, known: dict[bytes, int], step: int = 1 << 20) -> Iterator[np.ndarray]:
    """Numbers of the words of a text, a megabyte at a time; ``known`` gets the distinct ones."""
    start = 0
    while start < len(raw):
        end = start + step
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield np.array([known.setdefault(w, len(known)) for w in raw[start:end].split()], np.int64)
        start = end


def repeat_words(ids: np.ndarray, text: np.ndarray, count: int, window: int = WINDOW) -> np.ndarray:
    """Of ``count`` texts, given the word numbers of all and the text of each word: words inside windows that
    occur at least twice in their text."""
    n = len(ids) - window + 1
    if n < 2:
        return np.zeros(count, np.int64)
    place = np.flatnonzero(text[:n] == text[window - 1:])
    # equal windows have equal keys; only windows whose key occurs again are compared
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    key = text[place].astype(np.uint64)
    for k in range(window):
        key = (key ^ mixed[place + k]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(32)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(place), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    place = place[again]
    if not len(place):
        return np.zeros(count, np.int64)
    name, wide = text[place].astype(np.int64), np.int64(ids.max() + 1)
    for k in range(window):
        _, name = np.unique(name * wide + ids[place + k], return_inverse=True)
    place = place[np.bincount(name)[name] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + window, -1)
    return np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=count).astype(np.int64)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, host, a, b, five counts, lines): (a, b) names the document, lines are its distinct ones with
    all their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            known: dict[bytes, int] = {}
            ids, owner, rows = [], [], []
            for k, (doc, host, raw) in enumerate(zip(*(part.column(c).to_pylist() for c in ("doc_id", "host", "text")), strict=True)):
                raw = raw or ""
                data = raw.encode("utf-8", "surrogatepass")
                n = 0
                for own in _word_ids(data, known):
                    ids.append(own)
                    n += len(own)
                owner.append(n)
                said = [x for x in data.split(b"\n") if x.strip()]
                lines: dict[tuple[int, int], int] = {}
                for x in said:
                    name = line_name(x)
                    lines[name] = lines.get(name, 0) + len(x.split())
                rows.append((*document_name(doc, host, data), n, len(raw) - sum(map(raw.count, SPACES)),
                             sum(map(raw.count, SYMBOLS)), len(said) - len(set(said)),
                             [{"a": a, "b": b, "n": c} for (a, b), c in lines.items()]))
            text = np.repeat(np.arange(len(part)), owner)
            again = repeat_words(np.concatenate(ids) if ids else np.empty(0, np.int64), text, len(part))
            cols = [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(7)]
            kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("host"), *(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(again), pa.array(cols[6], kind)],
                ["doc_id", "host", "a", "b", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])

    host = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    rows = docs.select("doc_id", host.alias("host"), F.col("text"))
    return rows.mapInArrow(run, extended(rows.select("doc_id", "host"), f"a bigint, b bigint, {_STATS}, {_LINES}"))


def frequent_lines(lines: DataFrame, documents: DataFrame, min_docs: int = MIN_DOCS, max_percent: int = MAX_PERCENT) -> DataFrame:
    """(host, la, lb, n_docs) of the lines (a row for each document and distinct line) above the limits."""
    counts = lines.groupBy("host", "la", "lb").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > min_docs)
    hosts = documents.groupBy("host").agg(F.count(F.lit(1)).alias("of_host"))
    return counts.join(hosts, "host").filter(F.col("n_docs") * 100 > F.col("of_host") * max_percent).drop("of_host")


def line_hits(rows: DataFrame, min_docs: int = MIN_DOCS, max_percent: int = MAX_PERCENT) -> DataFrame:
    """(a, b, la, lb, n): the lines above the limits in every distinct document of ``measured`` rows."""
    own = written(rows.groupBy("a", "b").agg(F.first("host").alias("host"), F.first("lines").alias("lines")), "rules-documents")
    lines = own.select("a", "b", "host", F.explode("lines").alias("l")).select(
        "a", "b", "host", F.col("l.a").alias("la"), F.col("l.b").alias("lb"), "l.n")
    often = written(frequent_lines(lines, own, min_docs, max_percent), "rules-lines")
    return lines.join(often.drop("n_docs"), ["host", "la", "lb"]).select("a", "b", "la", "lb", "n")


def _verdicts(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """``measured`` rows with the words left and the rules' verdict."""
    gone = hits.groupBy("a", "b").agg(F.sum("n").alias("gone"))
    met = rows.drop("lines", "host").join(gone, ["a", "b"], "left").withColumn("gone", F.coalesce("gone", F.lit(0)))
    left = F.col("n_words") - F.col("gone")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    depleted = (F.col("gone") > 0) & ((left * 100 < F.col("n_words") * LEFT_PERCENT) | (left < MIN_WORDS))
    return met.withColumns({"words_left": left, "base_failed": failed, "kept": ~failed & ~depleted})


def judged(docs: DataFrame, min_docs: int = MIN_DOCS, max_percent: int = MAX_PERCENT) -> DataFrame:
    """A row for each row of ``docs``: its counts, the words left, and whether the rules keep it."""
    rows = written(measured(docs), "rules-measured")
    return _verdicts(rows, line_hits(rows, min_docs, max_percent))


def kept_texts(docs: DataFrame, min_docs: int = MIN_DOCS, max_percent: int = MAX_PERCENT) -> DataFrame:
    """The documents that are kept, with the columns they came with and without lines above the limits."""
    rows = written(measured(docs), "rules-measured")
    hits = written(line_hits(rows, min_docs, max_percent), "rules-hits")
    drop = hits.groupBy("a", "b").agg(F.collect_set(F.struct("la", "lb")).alias("names"))  # lines of one document
    verdict = _verdicts(rows, hits).filter("kept").select("a", "b").distinct().join(drop, ["a", "b"], "left")
    own, columns = {c: fresh(f"_{c}", docs) for c in ("a", "b", "names")}, docs.columns
    verdict = verdict.select(*(F.col(c).alias(own[c]) for c in own))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = zip(*(part.column(c).to_pylist() for c in ("doc_id", "source", "text")), strict=True)
            ab = [document_name(doc, "" if source is None else f"s{source}", (raw or "").encode("utf-8", "surrogatepass"))
                  for doc, source, raw in rows]
            cols = list(zip(*ab, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, pa.int64()) for c in cols)],
                                             [*part.schema.names, own["a"], own["b"]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = []
            for raw, drop in zip(part.column("text").to_pylist(), part.column(own["names"]).to_pylist(), strict=True):
                if drop:
                    gone = {(x["la"], x["lb"]) for x in drop}
                    lines = raw.encode("utf-8", "surrogatepass").split(b"\n")
                    raw = b"\n".join(x for x in lines if not x.strip() or line_name(x) not in gone).decode("utf-8", "surrogatepass")
                texts.append(raw)
            out = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(out, columns)

    keyed = docs.mapInArrow(key, extended(docs, f"`{own['a']}` bigint, `{own['b']}` bigint"))
    return keyed.join(verdict, [own["a"], own["b"]]).mapInArrow(cut, docs.schema)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and verdict of every document."""
    got = judged(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "words_left", "base_failed", "kept")


OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT row, i, ws[i:i + {WINDOW - 1}] AS win FROM (SELECT row, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
rep AS (SELECT row, count(DISTINCT i + k) AS n_repeat_words FROM
        (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM win), range({WINDOW}) r(k) WHERE n > 1 GROUP BY row),
l AS (SELECT row, line, list_filter(string_split_regex(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[\x20\x09-\x0D]+'), lambda x: x <> '') AS norm
      FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d)),
dup AS (SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE len(norm) > 0 GROUP BY row),
one AS (SELECT min(row) AS row, doc_id, source, text FROM d GROUP BY doc_id, source, text),
hosts AS (SELECT source, count(*) AS docs FROM one GROUP BY source),
often AS (SELECT x.source, norm FROM (SELECT DISTINCT row, source, norm FROM l JOIN one USING (row) WHERE len(norm) > 0) x
          JOIN hosts ON hosts.source IS NOT DISTINCT FROM x.source GROUP BY x.source, norm
          HAVING count(*) > {MIN_DOCS} AND count(*) * 100 > max(docs) * {MAX_PERCENT}),
gone AS (SELECT l.row, sum(len(l.norm)) AS gone FROM l JOIN d USING (row)
         JOIN often o ON o.norm = l.norm AND o.source IS NOT DISTINCT FROM d.source GROUP BY l.row),
a AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(ws) - coalesce(gone, 0) AS BIGINT) AS words_left
      FROM d JOIN w USING (row) LEFT JOIN rep USING (row) LEFT JOIN dup USING (row) LEFT JOIN gone USING (row)),
b AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {REPEAT_PERCENT} AS base_failed FROM a)
SELECT *, NOT base_failed AND (words_left = n_words OR (words_left * 100 >= n_words * {LEFT_PERCENT} AND words_left >= {MIN_WORDS})) AS kept
FROM b
"""
