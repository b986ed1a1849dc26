"""Line dedup by overlapping three-line windows, in DataFrame functions only.

A text is cut at line breaks. Every three consecutive lines form a window (windows of blank lines
only do not count), named by two independent 64-bit hashes. The first occurrence of a window, by
(doc_id, place), stays; lines covered by any later occurrence are removed, overlapping windows
merging into one stretch. Texts of fewer than three lines have no window and stay as they are.

Scale: windows are summed per task before the shuffle, so a passage that a third of all documents
share is one row per task. Only windows that occur again are written; the occurrences meet them in
a join of a scan with a written table, which adaptive execution splits where a window is frequent.
Covered places are gathered per document, never per window.

Defined cases: null texts stay null and have no lines; blank lines between kept lines stay; a text
all of whose lines repeat becomes empty but its row stays; a null doc_id sorts first; rows that
share a doc_id are ordered by a hash of their text, and rows equal in both are one document with one
result for each row; an empty table gives an empty result; any other columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import documents
from revlens.session import written

LINES = 3


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` has lambdas."""
    return F.transform(F.array(value), use)[0]


def _hashes(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"), (F.trim(line) != "").alias("said"))


def _windows(hashed: Column) -> Column:
    n = F.size(hashed) - (LINES - 1)

    def window(z: Column, i: Column) -> Column:
        own = [z[str(k)] for k in range(LINES)]
        said = own[0]["said"] | own[1]["said"] | own[2]["said"]
        return F.struct(F.xxhash64(*(x["a"] for x in own)).alias("a"), F.xxhash64(F.lit(7), *(x["b"] for x in own)).alias("b"),
                        i.alias("place"), said.alias("said"))

    zipped = F.arrays_zip(*(F.slice(hashed, k + 1, F.greatest(n, F.lit(0))).alias(str(k)) for k in range(LINES)))
    return F.when(n > 0, F.filter(F.transform(zipped, window), lambda w: w["said"]))


def occurrences(docs: DataFrame) -> DataFrame:
    """(a, b, doc_id, own, place): every window of every text; ``own`` tells rows of one doc_id apart."""
    hashed = F.transform(F.split("text", "\n"), _hashes)
    rows = docs.select("doc_id", F.xxhash64("text").alias("own"), F.explode(_bound(hashed, _windows)).alias("w"))
    return rows.select("w.a", "w.b", "doc_id", "own", "w.place")


def repeated_places(docs: DataFrame) -> DataFrame:
    """(doc_id, own, places): where later occurrences of windows begin in each document, ascending."""
    at = F.struct("doc_id", "own", "place")
    first = (occurrences(docs).groupBy("a", "b").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("a", "b", "first"))
    first = written(first, "line-windows")
    late = occurrences(docs).join(first, ["a", "b"]).filter(~at.eqNullSafe(F.col("first")))
    return written(late.groupBy("doc_id", "own").agg(F.sort_array(F.collect_set("place")).alias("places")), "line-places")


def _kept(lines: Column, places: Column) -> Column:
    """Lines outside every covered stretch: the gaps between the windows' ends and the next begins."""
    ends = F.transform(places, lambda p: p + LINES)
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), ends).alias("s"), F.concat(places, F.array(F.size(lines))).alias("e"))
    return F.flatten(F.transform(F.filter(gaps, lambda g: g["e"] > g["s"]),
                                 lambda g: F.slice(lines, g["s"] + 1, g["e"] - g["s"])))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, any others) with cleaned texts, plus n_lines and n_removed."""
    late = repeated_places(docs.select("doc_id", "text")).select(
        F.col("doc_id").alias("_id"), F.col("own").alias("_own"), F.col("places").alias("_places"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    text = F.col("_row.text")
    # the same plan at every size: texts are dealt by document and meet a hash of the few places there
    met = rows.join(late.hint("shuffle_hash"), F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_own")), "left")
    lines = F.split(text, "\n")
    kept = _bound(F.struct(lines.alias("l"), F.col("_places").alias("p")), lambda x: _kept(x["l"], x["p"]))
    out = met.select("_row", F.when(F.col("_places").isNotNull(), kept).alias("_kept"),
                     F.coalesce(F.size(lines), F.lit(0)).alias("_n"))
    changed = F.col("_kept").isNotNull()
    n = F.when(text.isNull(), F.lit(0)).otherwise(F.col("_n")).cast("bigint")
    return out.select(
        *(F.when(changed, F.array_join("_kept", "\n")).otherwise(text).alias("text") if c == "text"
          else F.col(f"_row.`{c}`").alias(c) for c in docs.columns),
        n.alias("n_lines"), F.when(changed, n - F.size("_kept")).otherwise(F.lit(0)).cast("bigint").alias("n_removed"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, n_lines, n_removed) of every document."""
    return dedup_lines(documents(spark, sf_dir))


def clean_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned texts, and n_chars of the texts that changed; the columns they came with."""
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        n = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


OP7_SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, i, ls[i:i+2] AS win FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM d)
      WHERE trim(ls[i]) <> '' OR trim(ls[i+1]) <> '' OR trim(ls[i+2]) <> ''),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM w),
c AS (SELECT doc_id, list(DISTINCT i + j) AS gone FROM f, (VALUES (0), (1), (2)) v(j) WHERE k > 1 GROUP BY doc_id)
SELECT doc_id,
       CASE WHEN gone IS NULL THEN text
            ELSE coalesce(array_to_string(list_filter(ls, lambda x, i: NOT list_contains(gone, i)), chr(10)), '') END AS text,
       CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN c USING (doc_id)
"""
