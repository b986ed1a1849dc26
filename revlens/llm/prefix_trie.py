"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns. A trie of height ``2 ** k`` is cut at half its depth: every
sequence gives a prefix of ``2 ** (k - 1)`` turns, whose name is the cut node that it ends in, and a
rest that belongs to the lower trie under that cut node. Both halves are cut the same way until the
tries have height one, whose only edges are the nodes. The cut of a sequence's span is the triple (top,
cut, end): the names of the nodes where the span begins, where it is cut, and where it ends (null where
the sequence is shorter). All spans of a level are worked on at once, and so are the levels of a page.

Names need no order among the halves: turns are named by a digest, aligned blocks of turns by the
digest of their halves, and a node at depth p by the digest of the node ``p & -p`` above it and the
block between them. 128 bits of SHA-256 stand for a sequence.

Totals are grafted upward. Level by level, the total of the lower trie under a cut node is added to the
trie whose cut node it is; then, from the top, what was added at a cut node is handed to all nodes
between it and the top of its span, halving the span each time, so that no node meets all its
ancestors. Levels grow with the logarithm of the longest conversation.

Scale: turns are numbered by ranges of (conversation, turn), so one conversation may hold any share of
the rows; a page holds at most ``2 ** PAGE`` turn names, and longer conversations are cut by joins on
(conversation, block). Every level has at most half of the rows of the one below it. Aggregates over
nodes are summed per task first. The digest of a node's ends is of one long message and so sequential:
ids are put into chunks in many tasks, and one task streams the chunks of a node without holding them.

Defined cases: null role or text is empty; null turns come first, rows of one turn are ordered by role
and then by their digest, repeated rows are turns of their own; rows of a null conv_id belong to no
conversation and are left out; a conversation may be rebuilt without turns and then ends at the root;
an empty table has no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import numbered, table
from revlens.session import written

#: A page is one row of at most 2 ** PAGE turns.
PAGE = 6
ROOT = bytes(16)
#: Ids of one chunk of a node's ends.
CHUNK = 20_000
#: Rebuilding: a conversation takes the first turns of the first one of its block of BLOCK ids, HEADS - 1 at most.
BLOCK, HEADS = 100, 6


def _named(kind: str, *parts: Column) -> Column:
    whole = F.concat(F.lit(kind).cast("binary"), *(p.cast("binary") for p in parts))
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def _name(kind: bytes, a: bytes, b: bytes) -> bytes:
    return hashlib.sha256(kind + a + b).digest()[:16]


def ordered_turns(talks: DataFrame) -> DataFrame:
    """(conv_id, at, name, n): every turn's place in its conversation, name and code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = talks.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        _named("T", F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("name"), F.length(text).alias("n"))
    got = numbered(written(rows, "trie-rows"), "conv_id", ["turn", "role", "name"], "trie-turns", "at")
    return got.select("conv_id", "at", "name", F.col("n").cast("bigint").alias("n"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Every conversation behind the first h turns of conv_id - conv_id % BLOCK, its own first h left out; h is the
    crc32 of its id modulo HEADS. A conversation without a turn left has one row with a null place."""
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    first = F.col("conv_id") - F.col("conv_id") % BLOCK
    heads = (turns.filter((F.col("conv_id") % BLOCK == 0) & (F.col("at") < HEADS - 1)).groupBy(F.col("conv_id").alias("first"))
             .agg(F.sort_array(F.collect_list(F.struct("at", "name", "n"))).alias("heads")))
    all_ids = turns.filter("at = 0").select("conv_id", h.alias("h"), first.alias("first")).join(heads, "first", "left")
    taken = F.when(F.col("heads").isNull() | (F.col("h") == 0), F.array().cast(dict(heads.dtypes)["heads"])).otherwise(
        F.slice("heads", F.lit(1), F.greatest(F.col("h"), F.lit(1)).cast("int")))
    all_ids = written(all_ids.select("conv_id", taken.alias("heads"), (F.col("h") - F.size(taken)).alias("less")), "trie-heads")
    # own turns move to the front where the first conversation is short or absent
    own = turns.filter(F.col("at") >= h).join(all_ids.filter("less > 0").select("conv_id", "less"), "conv_id", "left").select(
        "conv_id", (F.col("at") - F.coalesce("less", F.lit(0))).alias("at"), "name", "n")
    return all_ids.select("conv_id", F.explode_outer("heads").alias("t")).select("conv_id", "t.at", "t.name", "t.n").unionByName(own)


def pages_of(turns: DataFrame, page: int = PAGE) -> DataFrame:
    """(conv_id, page, turns, on): runs of 2 ** page turns, and whether another page follows."""
    wide = 1 << page
    rows = turns.filter(F.col("at").isNotNull()).groupBy("conv_id", F.expr(f"at div {wide}").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("at", "name", "n"))).alias("turns"))
    rows = written(rows, "trie-runs")
    later = rows.filter("page > 0").select("conv_id", (F.col("page") - 1).alias("page"), F.lit(True).alias("on"))
    return rows.join(later, ["conv_id", "page"], "left").withColumn("on", F.coalesce("on", F.lit(False)))


def _block(page: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = []
            for turns in b.column("turns").to_pylist():
                own = [t["name"] for t in turns]
                for _ in range(page):
                    own = [_name(b"B", x, y) for x, y in zip(own[::2], own[1::2], strict=True)]
                names.append(own[0])
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("page"), pa.array(names, pa.binary())],
                                             ["conv_id", "page", "block"])

    return run


def page_spans(pages: DataFrame, page: int = PAGE) -> tuple[DataFrame, list[DataFrame]]:
    """(conv_id, page, top, end) of the pages of conversations with a full page, and the cuts above pages."""
    full = pages.filter(F.size("turns") == 1 << page).mapInArrow(_block(page), "conv_id bigint, page bigint, block binary")
    blocks, most = [written(full, "trie-blocks")], pages.agg(F.max("page")).first()[0] or 0
    while most >> (len(blocks) - 1):
        side = F.col("page") % 2
        pairs = blocks[-1].groupBy("conv_id", F.expr("page div 2").alias("page")).agg(
            F.max(F.when(side == 0, F.col("block"))).alias("x"), F.max(F.when(side == 1, F.col("block"))).alias("y"))
        blocks.append(written(pairs.filter("x is not null and y is not null").select(
            "conv_id", "page", _named("B", F.col("x"), F.col("y")).alias("block")), "trie-blocks"))
    top, cuts = F.lit(ROOT), []
    long = blocks[0].select("conv_id").distinct().withColumn("page", F.lit(0).cast("bigint"))
    spans = long.join(blocks[-1], ["conv_id", "page"], "left").select(
        "conv_id", "page", top.alias("top"), F.when(F.col("block").isNotNull(), _named("P", top, F.col("block"))).alias("end"))
    for up in range(len(blocks) - 2, -1, -1):
        left = blocks[up].filter("page % 2 = 0").select("conv_id", F.expr("page div 2").alias("page"), "block")
        met = spans.join(left, ["conv_id", "page"], "left").withColumn(
            "cut", F.when(F.col("block").isNotNull(), _named("P", F.col("top"), F.col("block"))))
        met = written(met.select("conv_id", "page", "top", "cut", "end"), "trie-spans")
        cuts.append(met.filter("cut is not null").select(F.lit(page + up + 1).alias("level"), "top", "cut", "end"))
        halves = F.array(F.struct((F.col("page") * 2).alias("page"), F.col("top"), F.col("cut").alias("end")),
                         F.struct((F.col("page") * 2 + 1).alias("page"), F.col("cut").alias("top"), F.col("end")))
        spans = met.select("conv_id", F.explode(halves).alias("s")).select("conv_id", "s.*").filter("top is not null")
    return spans, cuts


_NODES = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
          "saved_tokens bigint, ends_sha256 string")
_SPAN = "level int, top binary, cut binary, end binary, conv_id bigint, depth bigint, n bigint, last boolean"


def _cut(page: int):
    """Cuts the span of a page down to its nodes: a node is a span of one turn, level 0."""
    def halves(names: list[bytes], top: bytes, end: bytes | None, out: list) -> list[tuple[bytes, bytes]]:
        levels, size = [names], len(names)
        for _ in range(page):
            below = levels[-1]
            levels.append([_name(b"B", x, y) for x, y in zip(below[::2], below[1::2], strict=False)])
        nodes = [(b"", b"")] * size
        todo = [(page, 0, top, end)]
        while todo:
            level, at, top, end = todo.pop()
            if level == 0:
                nodes[at] = (top, end)
                continue
            half = 1 << (level - 1)
            if size - at < half:
                todo.append((level - 1, at, top, None))
                continue
            mid = _name(b"P", top, levels[level - 1][at >> (level - 1)])
            todo.append((level - 1, at, top, mid))
            if size - at > half:
                out.append((level, top, mid, end))
                todo.append((level - 1, at + half, mid, end))
        return nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("level", pa.int32()), ("top", pa.binary()), ("cut", pa.binary()), ("end", pa.binary()),
                            ("conv_id", pa.int64()), ("depth", pa.int64()), ("n", pa.int64()), ("last", pa.bool_())])
        for b in batches:
            for start in range(0, len(b), 1024):
                cuts, rows = [], []
                for r in b.slice(start, 1024).to_pylist():
                    names = [t["name"] for t in r["turns"]]
                    nodes, first = halves(names, r["top"] or ROOT, r["end"], cuts), r["page"] << page
                    for k, ((top, end), t) in enumerate(zip(nodes, r["turns"], strict=True)):
                        last = k == len(nodes) - 1 and not r["on"]
                        rows.append((0, top, None, end, r["conv_id"], first + k + 1, t["n"], last))
                rows += [(*c, None, None, None, None) for c in set(cuts)]
                cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node, in order, as comma-joined strings."""
    held: tuple[bytes, list[int]] | None = None

    def give(node: bytes, ids: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()),
                                           pa.array([",".join(map(str, ids))])], ["node", "first", "ids"])

    for b in batches:
        for node, conv in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
            if held and (held[0] != node or len(held[1]) >= CHUNK):
                yield give(*held)
                held = None
            if held is None:
                held = (node, [])
            held[1].append(conv)
    if held:
        yield give(*held)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of each node, which come in order."""
    at, state, done = None, None, []

    def give() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([y for _, y in done])],
                                          ["node", "ends_sha256"])

    for b in batches:
        for node, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if node != at:
                if state is not None:
                    done.append((at, state.hexdigest()))
                at, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(done) >= 1024:
            yield give()
            done = []
    if state is not None:
        done.append((at, state.hexdigest()))
    if done:
        yield give()


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes (node, conv_id) where conversations end."""
    parts = max(1, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = ends.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = dealt.mapInArrow(_chunks, "node binary, first bigint, ids string")
    return chunks.repartition(parts, "node").sortWithinPartitions("node", "first").mapInArrow(
        _streamed, "node binary, ends_sha256 string")


def grafted(nodes: DataFrame, kids: DataFrame, cuts: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """What the tries below add: (node, leaves, saved) for every node with children but the root, and for the root."""
    below, mids = kids.select("node", "leaves", "saved"), []
    for level in range(1, height + 1):
        own = cuts.filter(F.col("level") == level).select(F.col("cut").alias("node"), "top").distinct()
        met = written(below.join(own, "node", "left"), f"trie-graft-{level}")
        mids.append(met.filter("top is not null").select("node", "leaves", "saved"))
        below = met.groupBy(F.coalesce("top", "node").alias("node")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    added = None
    for level in range(height, 0, -1):
        more = mids[level - 1]
        if added is not None:
            # a span of 2 ** level turns that ends in a node: both halves get what was added at its end
            own = cuts.filter((F.col("level") == level) & F.col("end").isNotNull()).select(F.col("end").alias("node"), "cut").distinct()
            more = more.unionByName(added.join(own, "node").select(F.explode(F.array("node", "cut")).alias("node"), "leaves", "saved"))
        added = written(more.groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), f"trie-added-{level}")
    if added is None:
        added = below.filter(F.lit(False))
    return added, below.filter(F.col("node") == F.lit(ROOT))


def prefix_trie(turns: DataFrame, page: int = PAGE) -> DataFrame:
    """Every node of the trie of conversations (conv_id, at, name, n): see op12_prefix_trie for its columns."""
    turns = written(turns, "trie-rebuilt")
    ids = turns.groupBy("conv_id").agg(F.count("at").alias("k"))
    all_of = written(ids, "trie-ids")
    total = all_of.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"), F.count_if(F.col("k") == 0).alias("bare")).first()
    pages = pages_of(turns, page)
    tops, above = page_spans(pages, page)
    rows = pages.join(tops, ["conv_id", "page"], "left").select("conv_id", "page", "turns", "on", "top", "end")
    spans = written(rows.mapInArrow(_cut(page), _SPAN), "trie-cut")

    last = F.count_if("last")
    nodes = spans.filter("level = 0").groupBy(F.col("end").alias("node"), F.col("top").alias("parent"), "depth", "n").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), last.alias("n_ends"))
    nodes = written(nodes.withColumn("leaves", (F.col("n_ends") == F.col("n_convs")).cast("bigint"))
                    .withColumn("saved", (F.col("n_convs") - 1) * F.col("n")), "trie-nodes")
    kids = written(nodes.groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "trie-kids")
    cuts = spans.filter("level > 0").select("level", "top", "cut", "end")
    for more in above:
        cuts = cuts.unionByName(more)
    cuts = written(cuts.distinct().repartition("level", "cut").sortWithinPartitions("level"), "trie-cuts")
    height = cuts.agg(F.max("level")).first()[0] or 0
    added, at_root = grafted(nodes, kids, cuts, height)

    bare = all_of.filter("k = 0").select(F.lit(ROOT).alias("node"), "conv_id")
    ends = end_digests(spans.filter("last").select(F.col("end").alias("node"), "conv_id").unionByName(bare))
    ends = written(ends, "trie-ends")
    empty = hashlib.sha256(b"").hexdigest()
    # the root is one row, whose facts are numbers
    at_root, its_kids = at_root.first(), kids.filter(F.col("node") == F.lit(ROOT)).first()
    its_ends = ends.filter(F.col("node") == F.lit(ROOT)).first()
    facts = (total["first"], 0, None, total["n"], its_kids["n_children"] if its_kids else 0,
             (at_root["leaves"] if at_root else 0) + int(total["bare"] == total["n"]), at_root["saved"] if at_root else 0,
             its_ends["ends_sha256"] if its_ends else empty)
    root = turns.sparkSession.createDataFrame([facts] if total["n"] else [], _NODES)
    under = added.select("node", F.col("leaves").alias("l"), F.col("saved").alias("s"))
    full = (nodes.join(under, "node", "left").join(kids.select("node", "n_children"), "node", "left").join(ends, "node", "left"))
    # children of the root need no join: their parent's conversation is the first of all
    up = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("p_conv"))
    full = full.withColumn("parent", F.when(F.col("parent") != F.lit(ROOT), F.col("parent"))).join(up, "parent", "left").select(
        "conv_id", "depth", F.coalesce("p_conv", F.lit(total["first"]).cast("bigint")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
    return root.unionByName(full)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    return prefix_trie(rebuilt(ordered_turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))))


_CRC = """list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, strlen(s) + 1), lambda i: ord(s[i])::BIGINT)),
         lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))"""

OP12_SQL = f"""
WITH c AS (SELECT conv_id, conv_id::VARCHAR AS s, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
                  ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, ts, xor({_CRC}, 4294967295) % 6 AS h FROM c),
b AS (SELECT x.conv_id, list_concat(coalesce(y.ts[1:x.h], []), x.ts[x.h + 1:]) AS seq
      FROM h x LEFT JOIN c y ON y.conv_id = x.conv_id - x.conv_id % 100),
p AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM b),
n AS (SELECT seq[1:d] AS pre, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = d) AS ends FROM p GROUP BY pre, d),
kids AS (SELECT pre[1:d - 1] AS pre, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
x AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf,
             CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * length(n.pre[n.d].t) END AS saved
      FROM n LEFT JOIN kids ON kids.d = n.d AND kids.pre = n.pre),
up AS (SELECT pre, leaf, saved, unnest(range(0, d + 1)) AS k FROM x),
tot AS (SELECT pre[1:k] AS pre, k AS d, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY 1, 2)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, x.n_convs, CAST(x.n_children AS BIGINT) AS n_children,
       CAST(tot.n_leaves AS BIGINT) AS n_leaves, CAST(tot.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(x.ends, '')) AS ends_sha256
FROM x JOIN tot ON tot.d = x.d AND tot.pre = x.pre LEFT JOIN x q ON q.d = x.d - 1 AND q.pre = x.pre[1:x.d - 1]
"""
