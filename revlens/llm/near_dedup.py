"""MinHash near-dedup with fast similarity sketches.

A document's set holds the hashes of its distinct word shingles. The sketch has ``T`` coordinates.
In round i every element is placed by a hash of the round into one bin with a value; a bin keeps
the smallest value of the first round that reached it. Rounds 0 to T-1 choose the bin at random,
rounds T to 2T-1 fill bin i-T, so every coordinate is filled after 2T rounds at the latest, and most
sets need few; agreeing coordinates estimate the similarity with the usual concentration.

``BANDS`` bands of ``ROWS`` coordinates bring documents together: a pair at similarity 0.8 meets in
some band but for one case in two million, a closer one more surely. What meets is verified on the
full sets.

Rows with equal sets are one class and are never compared. In a bucket (classes that agree in a
band) every class is first compared with the bucket's smallest class only, and the links found are
joined into components. Buckets that still hold several components are finished exactly: the
classes outside the bucket's largest component are compared with all of the bucket in other
components. Two classes whose distances to the bucket's smallest class differ by more than the link
distance can't be linked (the Jaccard distance is a metric), and a pair shares at most what either
class shares with any class left, also part by part of a hash; pairs that these bounds rule out are
never formed. A group of near
copies thus costs its size times the bands, not its square.

Scale: classes and buckets are aggregates, summed per task; joins are between written tables, so
that adaptive execution splits frequent keys; components take a logarithmic number of rounds of
joins; sets are gathered only for classes that meet others. Nothing but counts reaches the driver.

Defined cases: null texts and texts without a word have the empty set, link with nothing and are
their own component; a text of fewer words than a shingle has one shingle; rows that share a doc_id
keep their own texts and rows; a null doc_id is its own component unless its class has another id;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import documents, slices
from revlens.session import written

WORDS, PERCENT = 4, 80
ROWS, BANDS = 6, 48
T = ROWS * BANDS
#: Parts by which the shingles of two sets are compared before the sets are, and what a part counts to.
PARTS, LEVELS = 256, 8
#: Words of more bytes are hashed one by one.
LONG_WORD = 256
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(0xFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word of ``raw``: its bytes are mixed in, eight at a time, after its length; words of over
    LONG_WORD bytes are hashed one by one. Words of up to eight bytes never collide with their like."""
    import xxhash

    size = end - begin
    out = _mix(size.astype(np.uint64) * np.uint64(_BASE) + np.uint64(1))
    eight = np.ndarray(len(raw), "<u8", raw + bytes(8), strides=(1,))
    live, at = np.flatnonzero(size <= LONG_WORD), 0
    while len(live):
        chunk, left = eight[begin[live] + at], size[live] - at
        few = left < 8
        chunk[few] &= (np.uint64(1) << (left[few].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
        out[live] = _mix(out[live] ^ chunk)
        at += 8
        live = live[left > 8]
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(raw[begin[k]:end[k]])
    return out


def shingle_sets(many: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    raws = [(t or "").encode("utf-8", "surrogatepass").lower() for t in many]
    raw = b"\n".join([*raws, b""])
    flat = np.frombuffer(raw, np.uint8)
    starts = np.cumsum([0, *(len(r) + 1 for r in raws)])
    blank = np.ones(len(flat) + 1, bool)
    blank[1:] = _BLANK[flat]
    begin = np.flatnonzero(blank[:-1] & ~blank[1:])
    end = np.flatnonzero(~blank[1:-1] & blank[2:]) + 1 if len(flat) else begin
    word = word_hashes(raw, begin, end)
    shingle = word[:max(0, len(word) - words + 1)].copy()
    for j in range(1, words):
        shingle = _mix(shingle * np.uint64(_BASE) + word[j:len(word) - words + 1 + j])
    cut = np.searchsorted(begin, starts)
    out = []
    for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False):
        if b - a >= words:
            out.append(np.unique(shingle[a:b - words + 1]))
        elif b > a:
            few = word[a:a + 1] + np.uint64(b - a)
            for j in range(a + 1, b):
                few = _mix(few * np.uint64(_BASE) + word[j:j + 1])
            out.append(few)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], t: int = T) -> np.ndarray:
    """One row of t coordinates per set, which must not be empty."""
    out = np.full((len(sets), t), _EMPTY)
    if not sets:
        return out
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets)
    for i in range(2 * t):
        h = _mix(x + np.uint64((i + 1) * _BASE & 0xFFFFFFFFFFFFFFFF))
        value = np.uint64(i << 32) | (h & _LOW)
        bins = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        np.minimum.at(out.reshape(-1), of * t + bins, value)
        open_ = (out == _EMPTY).any(1)
        if not open_.any():
            break
        keep = open_[of]
        if not keep.all():
            of, x = of[keep], x[keep]
    return out


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band of ``rows`` coordinates."""
    parts = sketch.reshape(len(sketch), sketch.shape[1] // rows, rows)
    out = np.zeros(parts.shape[:2], np.uint64)
    for j in range(rows):
        out = _mix(out * np.uint64(_BASE) + parts[:, :, j])
    return out


def sketch_table(docs: DataFrame, words: int = WORDS, rows: int = ROWS, n_bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, bands) of every row; k1 and k2 name the set, null if it is empty.
    A column ``own`` of ``docs`` comes along."""
    import xxhash

    more = [c for c in docs.columns if c == "own"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 20):
            sets = shingle_sets(part.column("text").to_pylist(), words)
            size = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(size)
            own = bands(sketches([sets[i] for i in full], rows * n_bands), rows).view(np.int64)
            names = np.zeros((len(sets), 2), np.int64)
            for i in full:
                names[i] = np.frombuffer(xxhash.xxh3_128_digest(sets[i].tobytes()), np.int64)
            ends = np.zeros(len(sets) + 1, np.int32)
            np.cumsum(np.where(size > 0, n_bands, 0), out=ends[1:])
            none = size == 0
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size), pa.array(names[:, 0], mask=none), pa.array(names[:, 1], mask=none),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(own.reshape(-1))), *(part.column(c) for c in more)],
                ["doc_id", "n_shingles", "k1", "k2", "bands", *more])

    return docs.select(F.col("doc_id").cast("bigint"), "text", *more).mapInArrow(
        run, "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>" + ", own bigint" * len(more))


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, set) of the wanted classes (node, first, k1, k2): their sorted hashes."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 20):
            sets = shingle_sets(part.column("text").to_pylist(), words)
            names = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]).reshape(-1, 2)
            same = (names[:, 0] == part.column("k1").to_numpy()) & (names[:, 1] == part.column("k2").to_numpy())
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("node"), lists], ["node", "set"]) \
                .filter(pa.array(same))  # another text may share the id

    met = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("first"))).select("node", "k1", "k2", "text")
    return met.mapInArrow(run, "node bigint, set array<bigint>").dropDuplicates(["node"])


def _shared_parts(rows: DataFrame) -> DataFrame:
    """(node, n, shared, parts, over) of (node, set, own): the size of the set, of the set without its
    own shingles, and of the latter by a hash in PARTS parts. A part's number is written as that many
    set bits out of LEVELS, so that the common bits of two sets count the smaller number of every
    part; ``over`` counts what a part has beyond. Two sets share at most their common bits and the
    smaller ``over``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "set", 1 << 20):
            n, words, shared, over = [], [], [], []
            for x, y in zip(part.column("set"), part.column("own"), strict=True):
                x = x.values.to_numpy().view(np.uint64)
                n.append(len(x))
                if y.is_valid:
                    x = np.setdiff1d(x, y.values.to_numpy().view(np.uint64), assume_unique=True)
                count = np.bincount((x % np.uint64(PARTS)).astype(np.int64), minlength=PARTS)
                words.append(np.packbits(np.arange(LEVELS) < count[:, None]).view(np.int64))
                shared.append(len(x))
                over.append(int(np.maximum(count - LEVELS, 0).sum()))
            ends = np.arange(len(n) + 1, dtype=np.int32) * (PARTS * LEVELS // 64)
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), *(pa.array(v, pa.int64()) for v in (n, shared, over)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(words)))],
                ["node", "n", "shared", "over", "parts"])

    return rows.select("node", "set", "own").mapInArrow(
        run, "node bigint, n bigint, shared bigint, over bigint, parts array<bigint>")


def _similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, both, either) of node pairs: sizes of intersection and union of the full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "x"):
            both, either = [], []
            for x, y in zip(part.column("x"), part.column("y"), strict=True):
                x, y = (z.values.to_numpy().view(np.uint64) for z in (x, y))
                at = np.searchsorted(y, x)
                n = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                both.append(n)
                either.append(len(x) + len(y) - n)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(both, pa.int64()),
                                              pa.array(either, pa.int64())], ["a", "b", "both", "either"])

    first = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    return pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "x", "y") \
        .mapInArrow(run, "a bigint, b bigint, both bigint, either bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): the smallest node that it reaches. Each round
    offers every node, and the root it has, the smallest root among its neighbours, then halves paths."""
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("root")), "roots")
    while True:
        seen = both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("offer")), "b")
        offers = seen.groupBy("a").agg(F.min("offer").alias("offer"))
        met = written(roots.join(offers, roots["node"] == offers["a"])
                      .select("node", "root", F.least("root", "offer").alias("offer")), "offers")
        better = met.groupBy(F.col("root").alias("node")).agg(F.min("offer").alias("lift"))
        lifted = written(met.join(better, "node", "left").select(
            "node", F.col("root").alias("was"), F.least("offer", F.coalesce("lift", "offer")).alias("root")), "lifted")
        up = lifted.select(F.col("node").alias("root"), F.col("root").alias("top"))
        new = written(lifted.join(up, "root").select("node", "was", F.col("top").alias("root")), "roots")
        if new.filter("was <> root").isEmpty():
            return new.select("node", "root")
        roots = new.select("node", "root")


def _linked(percent: int) -> Column:
    return F.col("both") * 100 >= F.col("either") * percent


def _classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, rows: int = ROWS,
             n_bands: int = BANDS) -> tuple[DataFrame, DataFrame]:
    """The sketch table of ``docs``, and (k1, k2, first, root) of every class: its smallest id and its component."""
    table = written(sketch_table(docs, words, rows, n_bands), "near-sketches")
    full = table.filter("k1 is not null")

    # classes of equal sets; their numbers are frozen by writing
    classes = full.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    # a class takes its bands from the rows of its smallest id; equal sets have equal bands
    one = full.select("k1", "k2", "doc_id", "bands").join(
        classes.select("k1", "k2", "first", "node"), ["k1", "k2"]).filter(F.col("doc_id").eqNullSafe(F.col("first")))
    members = one.select("node", F.posexplode("bands").alias("band", "hash"))
    buckets = written(members.groupBy("band", "hash").agg(F.min("node").alias("pivot"), F.max("node").alias("top"))
                      .filter("pivot < top").select("band", "hash", "pivot"), "near-buckets")
    met = written(members.join(buckets, ["band", "hash"]).select("band", "hash", "node", "pivot").distinct(), "near-members")

    wanted = met.select("node").distinct().join(classes, "node").select("node", "first", "k1", "k2")
    sets = written(_sets_of(docs, wanted, words), "near-sets")
    star = met.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    star = written(_similarities(star, sets), "near-star")
    links = star.filter(_linked(percent)).select("a", "b")
    roots = components(links)

    # buckets with several components left: the classes outside the largest, against the others
    placed = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = placed.groupBy("band", "hash", "root").agg(F.count(F.lit(1)).alias("n"))
    open_ = sizes.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("parts"), F.max_by("root", "n").alias("major")) \
        .filter("parts > 1").select("band", "hash", "major")
    far = star.select(F.col("a").alias("node"), F.col("b").alias("pivot"), (1 - F.col("both") / F.col("either")).alias("far"))
    rest = placed.join(open_, ["band", "hash"]).join(far, ["node", "pivot"], "left")
    rest = written(rest.select("band", "hash", "node", "root", "major", F.coalesce("far", F.lit(0.0)).alias("far"),
                               (F.col("node") == F.col("pivot")).alias("is_pivot")).filter("not is_pivot"), "near-rest")
    # what a class can share with any class that is left: all but its own shingles, counted by part
    left = written(sets.join(rest.select("node").distinct(), "node"), "near-left")
    own = left.select("node", F.explode("set").alias("shingle")).groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).filter("n = 1").groupBy("node").agg(
        F.collect_list("shingle").alias("own"))
    bound = written(_shared_parts(left.join(own, "node", "left")), "near-bounds")
    rest = rest.join(bound, "node").filter(F.col("shared") * 100 >= F.col("n") * percent)

    reach = 1 - percent / 100
    cell = F.floor(F.col("far") / reach)

    def side(tag: str, *more: Column) -> list[Column]:
        return ["band", "hash", *(F.col(c).alias(tag + c) for c in ("node", "root", "major", "far", "n", "shared", "over", "parts")), *more]

    minor = rest.filter("root <> major").select(*side("x_", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell")))
    every = rest.select(*side("y_", cell.alias("cell")))
    need = (F.col("x_n") + F.col("y_n")) * percent
    most = F.least("x_shared", "y_shared") * (100 + percent)
    by_part = F.least("x_over", "y_over")
    for i in range(PARTS * LEVELS // 64):
        by_part = by_part + F.bit_count(F.col("x_parts")[i].bitwiseAND(F.col("y_parts")[i]))
    more = minor.join(every, ["band", "hash", "cell"]).filter(
        (F.col("x_root") != F.col("y_root")) & (F.abs(F.col("x_far") - F.col("y_far")) <= reach + 1e-9)
        & (most >= need)
        # both outside the largest component: once is enough
        & ((F.col("y_root") == F.col("y_major")) | (F.col("x_node") < F.col("y_node")))
        & (by_part * (100 + percent) >= need))
    more = more.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
    more = written(_similarities(more, sets).filter(_linked(percent)).select("a", "b"), "near-more")
    if not more.isEmpty():
        roots = components(links.union(more))

    named = classes.join(roots, "node", "left").select("k1", "k2", "first", F.coalesce("root", "node").alias("root"))
    return table, written(named, "near-roots")


def near_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, rows: int = ROWS,
                n_bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of (doc_id, text)."""
    table, named = _classes(docs.select("doc_id", "text"), words, percent, rows, n_bands)
    full = table.filter("k1 is not null")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(named.join(least, "root").select("k1", "k2", "component_id"), "near-named")
    grouped = full.select("doc_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2"]).select(
        "doc_id", "n_shingles", "component_id")
    alone = table.filter("k1 is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return near_groups(documents(spark, sf_dir))


def drop_near_copies(docs: DataFrame, words: int = 5) -> DataFrame:
    """One row of each group, with the columns it came with: the one with the smallest id (null last),
    then the smallest hash of its text; of rows equal in both, one. Texts without a word all stay."""
    table, named = _classes(docs.select("doc_id", "text", F.xxhash64("text").alias("own")), words)
    full = table.filter("k1 is not null").select("doc_id", "own", "k1", "k2")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")
    least = full.groupBy("k1", "k2").agg(F.min(key).alias("least")).join(named, ["k1", "k2"])
    least = written(least.select("k1", "k2", "root", "least"), "near-least")
    stays = least.groupBy("root").agg(F.min("least").alias("stays"))
    stays = written(least.join(stays, "root").select("k1", "k2", "stays"), "near-stays")
    gone = full.join(stays, ["k1", "k2"]).filter(~key.eqNullSafe(F.col("stays")))
    gone = written(gone.select(F.col("doc_id").alias("_id"), F.col("own").alias("_own")).distinct(), "near-gone")

    def same(other: DataFrame) -> Column:
        return F.col("_row.doc_id").eqNullSafe(other["_id"]) & (F.xxhash64(F.col("_row.text")) == other["_own"])

    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    rows = rows.join(gone, same(gone), "left_anti")
    again = full.groupBy(F.col("doc_id").alias("_id"), F.col("own").alias("_own")).agg(F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").select("_id", "_own")
    again = written(again, "near-again")
    if again.isEmpty():
        return rows.select("_row.*")
    once = rows.join(again, same(again)).groupBy("_id", "_own").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return rows.join(again, same(again), "left_anti").union(once.select("_row")).select("_row.*")
