"""Exact dedup by deterministic block naming, in DataFrame functions only.

White space is deleted and the rest cut into blocks of ``BLOCK`` bytes. Distinct blocks are sorted
into integer names; then names of adjacent pairs are named again, level by level, until a text has
one name. Names differ between levels, a last odd name moves up as it is, and equal names mean equal
texts: no fingerprint decides. Blocks are found again by a 64-bit hash, whose distinct contents are
gathered with it; where a hash has several contents, the contents themselves are joined.

Scale: distinct blocks are reduced per task before their one shuffle, so copies do not travel; the
table of names holds numbers only. All joins are between written tables, whose frequent keys
adaptive execution splits, and groups are aggregates over (name), summed per task first. Levels grow
with the logarithm of the longest text.

Defined cases: null counts as empty, and empty texts are one group; ties in length go to the smaller
doc_id, a null doc_id last; rows that repeat the same doc_id each count in group_size and each give
a row, kept if they equal the row that stays; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import documents
from revlens.session import written

BLOCK = 4096
#: Names of a level lie above those of the levels before: partition and row number take 58 bits at most.
LEVEL_BITS = 58
_KEY = ["doc_id", "n_chars", "own"]


def normalised(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``."""
    for c in " \t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c))
    return text


def _blocks(raw: Column, size: int) -> Column:
    def cut(r: Column) -> Column:
        count = F.greatest(F.lit(1), F.ceil(F.octet_length(r) / size).cast("int"))
        return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(r, i * size + 1, F.lit(size)))

    return F.transform(F.array(raw), cut)[0]  # the bytes are bound once for all blocks


def _same(a: list[Column], b: list[Column]) -> Column:
    out = F.lit(True)
    for x, y in zip(a, b, strict=True):
        out = out & x.eqNullSafe(y)
    return out


def identities(docs: DataFrame, size: int = BLOCK, block_hash=F.xxhash64) -> DataFrame:
    """(doc_id, n_chars, own, sha, name) of every row: texts are equal, white space aside, just if names are."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cut = rows.select("doc_id", F.length("text").alias("n_chars"), F.xxhash64("text").alias("own"),
                      normalised(F.col("text")).alias("norm"))
    cut = cut.select(*_KEY, "norm", _blocks(F.col("norm").cast("binary"), size).alias("blocks"))
    hashes = F.transform("blocks", lambda b: block_hash(b).cast("bigint"))
    texts = written(cut.select(*_KEY, F.sha2("norm", 256).alias("sha"), hashes.alias("hashes")), "dedup-texts")

    # level 0: distinct blocks in order, one integer each
    blocks = cut.select(F.explode("blocks").alias("block")).select(block_hash("block").cast("bigint").alias("h"), "block")
    found = blocks.groupBy("h").agg(F.sort_array(F.collect_set("block")).alias("contents")).sortWithinPartitions("h")
    found = found.select("h", F.size("contents").alias("k"), F.explode("contents").alias("block"))
    names = written(found.select("h", "k", F.when(F.col("k") > 1, F.col("block")).alias("block"),
                                 F.monotonically_increasing_id().alias("name")), "dedup-names")
    one = texts.select(*_KEY, "sha", F.posexplode("hashes").alias("place", "h"), F.size("hashes").alias("n"))
    named = one.join(names.filter("k = 1").select("h", "name"), "h")
    shared = names.filter("k > 1")
    if not shared.isEmpty():  # one hash, several contents: join the contents
        again = cut.select(*_KEY, F.sha2("norm", 256).alias("sha"), F.size("blocks").alias("n"),
                           F.posexplode("blocks").alias("place", "block"))
        again = again.withColumn("h", block_hash("block").cast("bigint")).join(shared.select("h", "block", "name"), ["h", "block"])
        named = named.select(*_KEY, "sha", "place", "n", "name").unionByName(
            again.select(*_KEY, "sha", "place", "n", "name"))
    named = written(named.select(*_KEY, "sha", "place", "n", "name"), "dedup-level")
    done = named.filter("n = 1").select(*_KEY, "sha", "name")

    # pairs of neighbours, until each text has one name
    rest = named.filter("n > 1").select(*_KEY, "place", "name")
    longest, level = texts.agg(F.max(F.size("hashes"))).first()[0] or 1, 0
    while longest > 1:
        longest, level = (longest + 1) // 2, level + 1
        side = F.col("place") % 2
        pairs = rest.groupBy(*_KEY, F.expr("cast(place div 2 as int)").alias("place")).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("a"), F.max(F.when(side == 1, F.col("name"))).alias("b"))
        pairs = written(pairs, "dedup-pairs")
        new = pairs.filter("b is not null").select("a", "b").distinct().sortWithinPartitions("a", "b")
        new = written(new.select("a", "b", (F.monotonically_increasing_id()
                                            + F.lit(level).cast("bigint") * F.lit(1 << LEVEL_BITS)).alias("name")), "dedup-names")
        odd = pairs.filter("b is null").select(*_KEY, "place", F.col("a").alias("name"))
        rest = written(pairs.join(new, ["a", "b"]).select(*_KEY, "place", "name").unionByName(odd), "dedup-level")
    if level:
        tops = rest.select(*(F.col(c).alias(f"t_{c}") for c in _KEY), F.col("name").alias("t_name"))
        long = texts.filter(F.size("hashes") > 1)
        met = long.join(tops, _same([long[c] for c in _KEY], [tops[f"t_{c}"] for c in _KEY]))
        done = done.unionByName(met.select(*_KEY, "sha", F.col("t_name").alias("name")))
    return written(done, "dedup-identities")


def exact_groups(docs: DataFrame, size: int = BLOCK, block_hash=F.xxhash64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    rows = identities(docs, size, block_hash)
    order = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    groups = written(rows.groupBy("name").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("keep")), "dedup-groups")
    return rows.join(groups, "name").select(
        "doc_id", F.col("keep.id").alias("keep_id"), "group_size", order.eqNullSafe(F.col("keep")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact group of every document."""
    return exact_groups(documents(spark, sf_dir))


OP10_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS len,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY len DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
