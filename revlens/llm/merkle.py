"""Merkle manifest of a dataset: nested-interval labels, containment joins, interval difference.

A row's leaf digest is a SHA-256 over all its columns. Leaves of a source stand in the order of
doc_id and have ranks from 0. Every ``FAN`` consecutive nodes form their parent until one is left, the
subroot; the subroots, in the order of their sources, form the root the same way. A node is labelled
with the interval ``[lo, hi)`` of leaf ranks that it covers, so that

* ancestors of a node are the nodes whose interval contains its own. They are attached top-down by
  joins whose keys are the level bucket (``STRIDE`` levels each) and the place in it, with the
  containment of the intervals as the join's condition;
* siblings of a node are its parent's interval less its own: what lies below it in the run is the
  left part of a proof step, what lies above it the right part.

A proof is the list of (left, right) steps from a leaf to the root; folding a leaf along it gives the
root just if the leaf is the one that was signed.

Scale: leaves are written once and ranked by a range partitioning (any source may be as large as all
others together). A bucket holds ``FAN ** STRIDE`` nodes and their inner levels in one row, so a tree
over n leaves takes log(n) / (STRIDE log FAN) shuffles, each of a 243rd of the rows before. Every join
is by (source, bucket), which is unique on both sides: no source is a hot key.

Defined cases: null columns are the sign ``-`` in the digest; a null source is a source of its own
and comes first; a null doc_id comes first in its source; rows of one source and doc_id stand in the
order of their digests, equal rows have equal leaves, and each gives a row with a proof of its own
place; a lone leaf is its source's subroot, a lone subroot the root, and a proof without siblings is
the digest of nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import numbered, table
from revlens.session import written

FAN, STRIDE = 3, 5
#: Columns of a row that its digest covers, in this order.
COVERED = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "struct<lo: bigint, hi: bigint, digest: string>"
_STEPS = "array<struct<left: string, right: string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(row: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*(encoded(row[c]) for c in COVERED)), 256)


def source_key(source: Column) -> Column:
    """A key that is never null and sorts as the source does, null first."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(key, doc_id, leaf, held): the digest as signed, and that of the row as it is held now, whose
    text ``tampered`` (null: untouched) replaces."""
    own = {c: F.col(c) for c in COVERED}
    held = F.lit(None).cast("string") if tampered is None else tampered
    leaf = digest_of(own)
    return docs.select(source_key(F.col("source")).alias("key"), F.col("doc_id"), leaf.alias("leaf"),
                       F.when(held.isNull(), leaf).otherwise(digest_of({**own, "text": held})).alias("held"))


def _parents(nodes: Column) -> Column:
    """Every ``FAN`` consecutive nodes of a level as one node of the next, covering their intervals."""
    def one(run: Column) -> Column:
        return F.struct(run[0]["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi"),
                        F.sha2(F.array_join(F.transform(run, lambda x: x["digest"]), ""), 256).alias("digest"))

    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(FAN))
    return F.transform(starts, lambda at: F.transform(F.array(F.slice(nodes, at, F.lit(FAN))), one)[0])


def _buckets(nodes: DataFrame, name: str) -> DataFrame:
    """One row for each bucket of ``FAN ** STRIDE`` consecutive nodes (key, rank, lo, hi, digest, more): the
    levels l0 to l5 of the tree above them, as far as it goes, and whether it is its key's only one."""
    wide = FAN ** STRIDE
    node = F.struct("lo", "hi", "digest")
    rows = nodes.groupBy("key", F.expr(f"rank div {wide}").alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct(node.alias("node"), "more"))).alias("own"))
    rows = written(rows, f"{name}-runs")
    # a key has one bucket if it has no second one
    second = rows.filter("bucket = 1").select("key", F.lit(0).cast("bigint").alias("bucket"), F.lit(True).alias("second"))
    rows = rows.join(second, ["key", "bucket"], "left").withColumn(
        "lone", (F.col("bucket") == 0) & F.col("second").isNull()).drop("second")
    rows = rows.withColumn("l0", F.transform("own", lambda x: x["node"]))
    for i in range(STRIDE):
        goes = ~F.col("lone") | (F.size(f"l{i}") > 1)
        rows = rows.withColumn(f"l{i + 1}", F.when(F.col(f"l{i}").isNotNull() & goes, _parents(F.col(f"l{i}"))))
    top = F.coalesce(*(F.col(f"l{i}") for i in range(STRIDE, -1, -1)))[0]
    own = rows.withColumn("top", top).withColumn("more", F.transform("own", lambda x: x["more"]))
    return written(own.drop("own"), f"{name}-buckets")


def climb(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Bucket tables of all strides, from the leaves (key, rank, digest, more) to the tops of all keys."""
    rounds, at = [], nodes.withColumn("lo", F.col("rank")).withColumn("hi", F.col("rank") + 1)
    while True:
        own = _buckets(at, f"{name}-{len(rounds)}")
        rounds.append(own)
        rest = own.filter(~F.col("lone"))
        if rest.isEmpty():
            return rounds
        at = rest.select("key", F.col("bucket").alias("rank"), "top.lo", "top.hi", "top.digest", F.lit(None).cast("void").alias("more"))


def tops(rounds: list[DataFrame]) -> DataFrame:
    """(key, digest) of the last node of every key."""
    out = None
    for own in rounds:
        one = own.filter("lone").select("key", F.col("top.digest").alias("digest"))
        out = one if out is None else out.unionByName(one)
    return out


def _steps(at: Column, lo: Column) -> Column:
    """Proof steps within a bucket of the node in place ``at`` of l0 that begins at rank ``lo``: what its
    parent's interval holds below and above its own, level by level."""
    def step(i: int) -> Column:
        level = F.col(f"l{i}")
        start = F.floor(at / FAN ** (i + 1)).cast("int") * FAN + 1
        run = F.slice(F.coalesce(level, F.array().cast(f"array<{_NODE}>")), start, F.lit(FAN))
        side = lambda keep: F.array_join(F.transform(F.filter(run, keep), lambda x: x["digest"]), "")
        return F.when(F.col(f"l{i + 1}").isNotNull(), F.struct(
            side(lambda x: x["hi"] <= lo).alias("left"), side(lambda x: x["lo"] > lo).alias("right")))

    return F.filter(F.array(*(step(i) for i in range(STRIDE))), lambda s: s.isNotNull()).cast(_STEPS)


def descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(key, rank, digest, more, steps, ...) of every leaf: its proof up to what ``above`` (key, steps, any others)
    gives for its key's last node. Ancestors are attached stride by stride, from the top."""
    found, more = None, [c for c in above.columns if c not in ("key", "steps")]
    for depth in range(len(rounds) - 1, -1, -1):
        own = rounds[depth].withColumn("lo", F.col("top.lo")).withColumn("hi", F.col("top.hi"))
        given = own.filter("lone").select("key", "bucket", "lo", "hi").join(above, "key")
        given = given if found is None else given.unionByName(found.select(*given.columns))
        given = given.select(F.col("key").alias("a_key"), F.col("bucket").alias("a_bucket"), F.col("lo").alias("a_lo"),
                             F.col("hi").alias("a_hi"), "steps", *more)
        # same key and level bucket, and the ancestor's interval contains this one
        met = own.join(given, (own.key == given.a_key) & (own.bucket == given.a_bucket)
                       & (own.lo >= given.a_lo) & (own.hi <= given.a_hi))
        leaf = F.transform("l0", lambda x, at: F.struct(
            x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest"),
            F.get("more", at).alias("more"), F.concat(_steps(at, x["lo"]), F.col("steps")).alias("steps")))
        rows = met.select("key", (F.col("bucket") * FAN ** STRIDE).alias("first"), *more, F.posexplode(leaf).alias("at", "leaf"))
        found = rows.select("key", (F.col("first") + F.col("at")).alias("bucket"), "leaf.*", *more)
        if depth:
            found = written(found.drop("more", "digest"), f"merkle-above-{depth}")
    return found.withColumnRenamed("bucket", "rank")


def folded(leaf: Column, steps: Column) -> Column:
    """The digest at the top of a proof whose leaf is ``leaf``."""
    return F.aggregate(steps, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof_digest(steps: Column) -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, steps, held): every row's proof, and its digest as it is held now."""
    rows = written(leaves(docs, tampered), "merkle-leaves")
    ranked = numbered(rows, "key", ["doc_id", "leaf", "held"], "merkle-ranked")
    own = climb(ranked.select("key", "rank", F.col("leaf").alias("digest"), F.struct("doc_id", "held").alias("more")), "merkle")
    sources = written(tops(own), "merkle-subroots")
    order = numbered(sources.select(F.lit("").alias("all"), "key", "digest"), "all", ["key"], "merkle-sources")
    upper = climb(order.select(F.col("all").alias("key"), "rank", "digest", F.struct("key", "digest").alias("more")), "merkle-upper")
    root = tops(upper).select("key", F.col("digest").alias("root"), F.array().cast(_STEPS).alias("steps"))
    above = descend(upper, root).select(F.col("more.key").alias("key"), "steps", F.col("more.digest").alias("subroot"), "root")
    found = descend(own, written(above, "merkle-above"))
    return found.select("more.doc_id", F.col("digest").alias("leaf"), "subroot", "root", "steps", "more.held")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of documents, checked against rows whose line breaks were deleted where 2 divides
    the crc32 of the id."""
    odd_text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    got = manifest(table(spark, sf_dir, "documents").select(*COVERED), odd_text)
    got = got.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"),
                     folded(F.col("held"), F.col("steps")).alias("folded_root"))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = """list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, strlen(s) + 1), lambda i: ord(s[i])::BIGINT)),
         lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))"""

OP11_SQL = f"""
WITH RECURSIVE enc AS (
  SELECT doc_id, source, text, doc_id::VARCHAR AS s,
         coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
         || coalesce(strlen(source)::VARCHAR || ':' || source, '-') || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head
  FROM documents),
rows_ AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
       CASE WHEN ({_CRC} & 1) = 1 THEN replace(text, chr(10), '') ELSE text END AS held, head FROM enc),
d AS (SELECT doc_id, source, leaf, sha256(head || coalesce(strlen(held)::VARCHAR || ':' || held, '-')) AS hleaf,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, held) - 1 AS rank FROM rows_),
up AS (SELECT 0 AS lvl, source, rank, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM d
       UNION ALL
       SELECT lvl + 1, source, rank // 3, sha256(string_agg(digest, '' ORDER BY rank)), (max(n) + 2) // 3
       FROM up WHERE n > 1 GROUP BY lvl, source, rank // 3),
sub AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank,
               count(*) OVER () AS n FROM up WHERE n = 1),
up2 AS (SELECT 0 AS lvl, rank, subroot AS digest, n FROM sub
        UNION ALL
        SELECT lvl + 1, rank // 3, sha256(string_agg(digest, '' ORDER BY rank)), (max(n) + 2) // 3
        FROM up2 WHERE n > 1 GROUP BY lvl, rank // 3),
sib AS (SELECT a.lvl, a.source, a.rank, coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank < a.rank), '') AS l,
               coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank > a.rank), '') AS r
        FROM up a JOIN up b ON a.lvl = b.lvl AND a.source IS NOT DISTINCT FROM b.source AND a.rank // 3 = b.rank // 3
        WHERE a.n > 1 GROUP BY a.lvl, a.source, a.rank),
sib2 AS (SELECT a.lvl, a.rank, coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank < a.rank), '') AS l,
                coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank > a.rank), '') AS r
         FROM up2 a JOIN up2 b ON a.lvl = b.lvl AND a.rank // 3 = b.rank // 3 WHERE a.n > 1 GROUP BY a.lvl, a.rank),
steps AS (SELECT d.doc_id, d.source, d.rank, s.lvl AS k, s.l, s.r FROM d JOIN sib s
            ON d.source IS NOT DISTINCT FROM s.source AND s.rank = d.rank // (3 ** s.lvl)::BIGINT
          UNION ALL
          SELECT d.doc_id, d.source, d.rank, 1000 + s.lvl, s.l, s.r FROM d JOIN sub ON d.source IS NOT DISTINCT FROM sub.source
          JOIN sib2 s ON s.rank = sub.rank // (3 ** s.lvl)::BIGINT),
proofs AS (SELECT source, rank, list({{'l': l, 'r': r}} ORDER BY k) AS path, string_agg(l || r, '' ORDER BY k) AS proof
           FROM steps GROUP BY source, rank)
SELECT *, folded_root = root AS verified FROM (
SELECT d.doc_id, d.leaf, sub.subroot, top.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256,
       list_reduce(list_concat([d.hleaf], list_transform(coalesce(path, []), lambda p: p.l || '|' || p.r)),
                   lambda acc, p: sha256(split_part(p, '|', 1) || acc || split_part(p, '|', 2))) AS folded_root
FROM d JOIN sub ON d.source IS NOT DISTINCT FROM sub.source JOIN up2 top ON top.n = 1
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM d.source AND p.rank = d.rank)
"""
