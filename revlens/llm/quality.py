"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

A text is cut into tokens (runs of letters, runs of digits, runs of one other sign; case kept).
Features are the hashes, modulo ``2 ** BITS``, of all tokens and of all pairs of neighbouring
tokens; a token that repeats the one before it counts for one common "repeated" feature. A feature
weighs the logarithm of one plus its count, and a text's vector has length one.

Training: the leader update per coordinate (FTRL-proximal with l1 and l2) over a sample of at most
``FIT_ROWS`` labelled rows (the first in the order of a hash of the id; a documented bound, the only
one here), ``EPOCHS`` times in that order in one task, whose memory the bound limits. The learned
weights (``2 ** BITS`` numbers whatever the input) are broadcast; scoring is a sparse dot product per
text in a narrow pass over every document.

Defined cases: a null or empty text has no feature and gets the score of the bias alone; rows with a
null label or null id are not learned from; of several labels of an id the largest counts, of several
texts of an id the one with the smallest hash; without
any training row every score is 0.5; repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import code_points, documents, extended, fresh, slices, table, texts

BITS, FIT_ROWS, EPOCHS = 18, 20_000, 5
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.02, 0.02
THRESHOLD = 0.3
_ODD = np.uint64(0x9E3779B97F4A7C15)
_REPEATED = np.uint64(0x5851F42D4C957F2D)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of a code point: 0 space, 1 letter, 2 digit, else the code point itself."""
    kinds = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x30000):
        s = chr(c)
        kinds[c] = 1 if s.isalpha() else 2 if s.isdigit() else 0 if s.isspace() else c
    return kinds


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def features(many: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature, weight) of all texts, by text and feature; each text has length one."""
    flat, starts = code_points(many)
    kind = _classes()[flat]
    change = np.empty(len(flat), bool)
    change[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    begin = np.flatnonzero(change & (kind != 0))
    if not len(begin):
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0)
    change[0] = False
    ends = np.append(np.flatnonzero(change), len(flat))
    end = ends[np.searchsorted(ends, begin, side="right")]
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _powers(len(flat), _BASE), out=sums[1:])
    token = _mix((sums[end] - sums[begin]) * _powers(len(flat), _INVERSE)[begin])
    text = np.searchsorted(starts, begin, side="right") - 1
    pair = _mix(token[:-1] * _ODD + token[1:])
    pair[token[:-1] == token[1:]] = _REPEATED
    inside = text[1:] == text[:-1]
    key = np.concatenate([text << bits | (token >> np.uint64(64 - bits)).astype(np.int64),
                          text[1:][inside] << bits | (pair[inside] >> np.uint64(64 - bits)).astype(np.int64)])
    key, count = np.unique(key, return_counts=True)
    text, weight = key >> bits, np.log1p(count)
    norm = np.sqrt(np.bincount(text, weight * weight, len(many)))
    return text, key & ((1 << bits) - 1), weight / norm[text]


class Leader:
    """FTRL-proximal state: sums of adjusted gradients and of squared gradients per coordinate.
    The last coordinate is the bias, which is not regularised."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1, l2 = np.full(len(z), L1), np.full(len(z), L2)
        l1[-1] = l2[-1] = 0.0
        w = (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        """One row; the last of ``at`` is the bias with value one."""
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def train(rows: DataFrame, bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (``2 ** bits`` and a bias) from a bounded table (place, label, text) of one text per place; copies of
    a row are learned from once."""
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # at most as many places as rows are learned from
        for part in slices(batches, limit=1 << 20):
            fresh_ = [p not in seen and not seen.add(p) for p in part.column("place").to_pylist()]
            part = part.filter(pa.array(fresh_, pa.bool_()))
            if not len(part):
                continue
            text, at, x = features(texts(part), bits)
            cut = np.searchsorted(text, np.arange(len(part) + 1))
            at, x = at.astype(np.int32), x.astype(np.float32)
            pack = [[y[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)] for y in (at, x)]
            yield pa.RecordBatch.from_arrays(
                [part.column("place"), part.column("label"), *(pa.array(y, pa.binary()) for y in pack)],
                ["place", "label", "at", "x"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for b in batches:
            for place, label, at, x in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if place != last:  # a copy from another task
                    held.append((label, np.append(np.frombuffer(at, np.int32), np.int32(1 << bits)),
                                 np.append(np.frombuffer(x, np.float32), np.float32(1))))
                last = place
        leader = Leader(1 << bits)
        for _ in range(epochs):
            for label, at, x in held:
                leader.learn(at, x, label)
        yield pa.RecordBatch.from_arrays(
            [pa.array([leader.weights(slice(None)).astype(np.float32).tobytes()], pa.binary())], ["w"])
        held.clear()
        pa.default_memory_pool().release_unused()

    one = (rows.mapInArrow(vectors, "place bigint, label int, at binary, x binary")
           .repartition(1).sortWithinPartitions("place", "label").mapInArrow(fit, "w binary"))
    got = [r.w for r in one.collect()]  # one row of fixed size
    return np.frombuffer(got[0], np.float32) if got else np.zeros((1 << bits) + 1, np.float32)


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Weights learned from labelled rows (doc_id, quality) for which ``learn`` (of doc_id) holds."""
    own = (labels.filter(learn & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("label"))
           .withColumn("place", F.xxhash64("doc_id")))
    # the number of ids gives a limit of the hash first, so that few more rows than wanted leave the tasks
    least, span = -(1 << 63), 1 << 64
    share = min(1.0, (fit_rows + 8 * fit_rows ** 0.5 + 8) / max(1, own.count()))
    own = own.filter(F.col("place") <= F.lit(min(least + int(span * share), (1 << 63) - 1))).orderBy("place", "doc_id").limit(fit_rows)
    # of rows that share an id the text with the smallest hash, chosen by numbers alone; at most fit_rows rows of five numbers
    met = docs.select("doc_id", "text", F.xxhash64("text").alias("own")).join(F.broadcast(own), "doc_id")
    some = met.groupBy("doc_id").agg(F.min("own").alias("own"))
    return train(met.join(F.broadcast(some), ["doc_id", "own"]).select("place", "label", "text"))


def score_quality(df: DataFrame, weights: np.ndarray, bits: int = BITS, out: str = "score") -> DataFrame:
    """``df`` (with a text column and any others; an own score is replaced) plus score, 0 to 1."""
    df = df.drop(out)
    held = df.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value.astype(np.float64)
        for part in slices(batches, limit=1 << 20):
            text, at, x = features(texts(part), bits)
            raw = np.bincount(text, x * w[at], len(part)) + w[-1]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(1 / (1 + np.exp(-np.clip(raw, -35, 35))))], [*part.schema.names, out])

    return df.mapInArrow(run, extended(df, f"`{out}` double"))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a model of the labelled rows that are not held out."""
    docs = documents(spark, sf_dir)
    weights = fit_quality(docs, table(spark, sf_dir, "labels"), ~held_out())
    return score_quality(docs, weights).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with the columns they came with."""
    weights = fit_quality(docs, labels, ~held_out())
    score = fresh("score", docs)
    return score_quality(docs, weights, out=score).filter(F.col(score) >= THRESHOLD).select(*docs.columns)
