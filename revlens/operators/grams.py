"""N-grams of words, and of the characters of words, counted in Arrow batches (D1-D10 over many reviews).

Lists of words come as (keys, w) with w the word lists of a review. A batch's words are numbered, and an n-gram is a pair of
the (n-1)-gram that it begins with and its last word, so that n-grams of all orders are told apart by whole numbers
and are made as strings once for each distinct one, or, where a vocabulary is known, never. Character n-grams lie within
a word, so they are cut once for each distinct word and counted as often as the word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.ngrams import char_wb_ngrams, vectorizer_tokens
from revlens.session import importable

#: Words that a task takes at once, those whose characters it takes, and ranges of buckets whose counts meet.
TOKENS, CHAR_TOKENS, RANGES = 1 << 19, 1 << 17, 64


def word_lists(docs: DataFrame, keys: tuple[str, ...] = (), words_col: str = "words", analyzer: str = "word") -> DataFrame:
    """(keys, w): the word lists of each review, which ``keys`` name; without keys one list a row."""
    importable(docs.sparkSession)
    if analyzer not in ("word", "char_wb"):
        raise ValueError(analyzer)
    w = vectorizer_tokens(F.col(words_col)) if analyzer == "word" else F.filter(F.transform(words_col, lambda x: F.lower(x)), lambda x: x.isNotNull())
    w = w.alias("w")
    if not keys:
        return docs.select(F.array(w).alias("w"))
    return docs.select(*keys, w).groupBy(*keys).agg(F.collect_list("w").alias("w"))


class _Words:
    """Words of some reviews: their numbers, the words, the row of each and how many words its list has from there on."""

    def __init__(self, lists: pa.Array):
        inner = pc.list_flatten(lists)
        per = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        size = pc.list_value_length(inner).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(inner).dictionary_encode()
        self.rows, self.words = len(lists), flat.dictionary.cast(pa.string())
        self.code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.left = np.repeat(np.cumsum(size), size) - np.arange(len(self.code))
        self.row = np.repeat(np.repeat(np.arange(self.rows), per), size)

    def parted(self) -> _Words:
        if pc.any(pc.match_substring(self.words, " ")).as_py():
            raise ValueError("a word holds a space, which parts the words of an n-gram")
        return self

    def hashes(self) -> np.ndarray:
        own = np.array([zlib.crc32(w.encode()) for w in self.words.to_pylist()], np.uint64)
        return _mix(own + np.uint64(1))[self.code]


def _slices(batch: pa.RecordBatch, tokens: int = 0) -> Iterator[tuple[pa.RecordBatch, _Words]]:
    """The batch in parts of about ``tokens`` words (TOKENS)."""
    lists = batch.column("w")
    per = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    size = pc.list_value_length(pc.list_flatten(lists)).fill_null(0).to_numpy(zero_copy_only=False)
    words = np.bincount(np.repeat(np.arange(len(lists)), per), size, len(lists))
    part = (np.cumsum(words) - words) // (tokens or TOKENS)
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else [0]
    for a, z in zip(edges, edges[1:], strict=False):
        own = batch.slice(a, z - a)
        yield own, _Words(own.column("w"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _buckets(h: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(h) % np.uint64(buckets)).astype(np.int64)


def _longer(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of what they begin with and of their last words."""
    return h * np.uint64(0x9E3779B97F4A7C15) + last


def bucket_counts(lists: DataFrame, lo: int, hi: int, buckets: int, once: bool = False) -> DataFrame:
    """(bucket, n): occurrences of the n-grams of each bucket, or, with ``once``, rows that hold one of an order of them."""
    width = -(-buckets // RANGES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, x in _slices(batch):
                h = last = x.parted().hashes()
                at = np.arange(len(h))
                for n in range(1, hi + 1):
                    if n > 1:
                        keep = x.left[at] >= n
                        at = at[keep]
                        h = _longer(h[keep], last[at + n - 1])
                    if n >= lo:
                        own = _buckets(h, buckets)
                        np.add.at(found, np.unique(own * x.rows + x.row[at]) // x.rows if once else own, 1)
        there = np.flatnonzero(found)
        edges = np.searchsorted(there, np.arange(RANGES + 1) * width)
        for part, (a, z) in enumerate(zip(edges, edges[1:], strict=False)):
            if z > a:
                own = there[a:z]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([(own - part * width).astype(np.int32).tobytes()], pa.binary()),
                                                  pa.array([found[own].tobytes()], pa.binary())], ["part", "bucket", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, own, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = sums.setdefault(part, np.zeros(width, np.int64))
                total[np.frombuffer(own, np.int32)] += np.frombuffer(n, np.int64)
        for part, total in sums.items():
            there = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(there + part * width, pa.int32()), pa.array(total[there])], ["bucket", "n"])

    return lists.mapInArrow(count, "part int, bucket binary, n binary").repartition("part").mapInArrow(add, "bucket int, n long")


def bucket_marks(some: DataFrame, buckets: int) -> np.ndarray:
    """Which of all buckets are among ``some`` (bucket)."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column("bucket").to_numpy(zero_copy_only=False).tobytes()], pa.binary())], ["own"])

    out = np.zeros(buckets, bool)
    for r in some.select("bucket").mapInArrow(pack, "own binary").collect():  # four bytes a bucket
        out[np.frombuffer(r["own"], np.int32)] = True
    return out


def gram_counts(lists: DataFrame, lo: int, hi: int, reviews: bool, marks: np.ndarray | None = None) -> DataFrame:
    """(term, cf), or (term, df, cf) with ``reviews``, of every n-gram of the rows. ``marks``: only those in marked buckets that
    also begin with n-grams of marked buckets, as those of which all are counted that occur often enough do."""
    held = lists.sparkSession.sparkContext.broadcast(None if marks is None else np.packbits(marks))
    buckets = 0 if marks is None else len(marks)
    names = ["term", "df", "cf"] if reviews else ["term", "cf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = None if held.value is None else np.unpackbits(held.value, count=buckets).view(bool)
        for batch in batches:
            for _, x in _slices(batch):
                h = last = x.hashes() if marked is not None else None
                if hi > 1:
                    x.parted()
                at, key, terms = np.arange(len(x.code)), x.code, None
                for n in range(1, hi + 1):
                    if n > 1:
                        keep = x.left[at] >= n
                        at = at[keep]
                        key = ids[keep] * len(x.words) + x.code[at + n - 1]
                        h = h if marked is None else _longer(h[keep], last[at + n - 1])
                    if marked is not None and n >= lo:
                        keep = marked[_buckets(h, buckets)]
                        at, key, h = at[keep], key[keep], h[keep]
                    if not len(at):
                        break
                    found, ids = np.unique(key, return_inverse=True)
                    own = x.words.take(pa.array(found % len(x.words)))
                    terms = own if terms is None else pc.binary_join_element_wise(terms.take(pa.array(found // len(x.words))), own, " ")
                    if n >= lo:
                        counts = [pa.array(np.bincount(ids, minlength=len(found)))]
                        if reviews:
                            counts.insert(0, pa.array(np.bincount(np.unique(ids * x.rows + x.row[at]) // x.rows, minlength=len(found))))
                        yield pa.RecordBatch.from_arrays([terms.cast(pa.string()), *counts], names)

    sums = [F.sum(c).alias(c) for c in names[1:]]
    return lists.mapInArrow(run, "term string, " + ", ".join(f"{c} long" for c in names[1:])).groupBy("term").agg(*sums)


class Known:
    """A vocabulary as a tree: at each order the n-grams that terms begin with, by the node of the (n-1)-gram and the last
    word, and the number of the term that ends there (-1: none)."""

    def __init__(self, terms: list[str], idx: np.ndarray, lo: int, hi: int):
        split = [t.split(" ") for t in terms]
        size = np.array([len(s) for s in split], np.int64)
        keep = np.flatnonzero((size >= lo) & (size <= hi))
        self.words = pa.array(sorted({w for k in keep.tolist() for w in split[k]}), pa.string())
        number = {w: k for k, w in enumerate(self.words.to_pylist())}
        self.levels, node = [], np.zeros(len(terms), np.int64)
        for n in range(1, hi + 1):
            keep = keep[size[keep] >= n]
            if not len(keep):
                break
            key = node[keep] * len(number) + np.array([number[split[k][n - 1]] for k in keep.tolist()], np.int64)
            found, node[keep] = np.unique(key, return_inverse=True)
            ends = np.full(len(found), -1, np.int64)
            last = keep[size[keep] == n]
            ends[node[last]] = idx[last]
            self.levels.append((found, ends))

    def met(self, x: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, idx, tf) of the terms in ``x``."""
        x.parted()
        number = pc.index_in(x.words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        code = number[x.code] if len(x.code) else x.code
        at, node, found = np.flatnonzero(code >= 0), 0, []
        for n, (keys, ends) in enumerate(self.levels, 1):
            if n > 1:
                keep = x.left[at] >= n
                at, node = at[keep], node[keep]
                keep = code[at + n - 1] >= 0
                at, node = at[keep], node[keep]
            key = node * len(self.words) + code[at + n - 1]
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            keep = keys[place] == key
            at, node = at[keep], place[keep]
            term = ends[node]
            found.append((x.row[at[term >= 0]], term[term >= 0]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        row, idx = (np.concatenate(c) for c in zip(*found, strict=True))
        width = int(idx.max()) + 1 if len(idx) else 1
        pairs, tf = np.unique(row * width + idx, return_counts=True)
        return pairs // width, pairs % width, tf


def char_grams(word: str, lo: int, hi: int) -> list[str]:
    """``char_wb_ngrams`` of one word: n-grams inside the padded word, which is its own first one if it isn't longer."""
    z = f" {word} "
    out = [z[k:k + lo] for k in range(max(len(z) - lo + 1, 1))]
    for n in range(lo + 1, hi + 1):
        out += [z[k:k + n] for k in range(len(z) - n + 1)]
    return out


class KnownChars:
    """A vocabulary of character n-grams."""

    def __init__(self, terms: list[str], idx: np.ndarray, lo: int, hi: int):
        self.number, self.range = dict(zip(terms, idx.tolist(), strict=True)), (lo, hi)

    def met(self, x: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, idx, tf) of the terms in ``x``."""
        own = [[k for g in char_grams(w, *self.range) if (k := self.number.get(g)) is not None] for w in x.words.to_pylist()]
        size = np.array([len(k) for k in own], np.int64)
        first, flat = np.cumsum(size) - size, np.array([k for some in own for k in some], np.int64)
        pairs, n = np.unique(x.row * max(1, len(size)) + x.code, return_counts=True)  # a review's words once each
        row, word = pairs // max(1, len(size)), pairs % max(1, len(size))
        each = size[word]
        at = np.repeat(first[word] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        width = int(flat.max()) + 1 if len(flat) else 1
        keys, back = np.unique(np.repeat(row, each) * width + flat[at], return_inverse=True)
        return keys // width, keys % width, np.bincount(back, np.repeat(n, each), len(keys)).astype(np.int64)


def char_totals(docs: DataFrame, lo: int, hi: int, words_col: str = "words") -> DataFrame:
    """(term, cf): occurrences of every character n-gram, from those of every word."""
    words = gram_counts(word_lists(docs, (), words_col, "char_wb"), 1, 1, False).withColumnRenamed("cf", "n")
    return words.select(F.explode(char_wb_ngrams(F.array("term"), lo, hi)).alias("term"), "n").groupBy("term").agg(F.sum("n").alias("cf"))


def known_grams(lists: DataFrame, vocab: DataFrame, lo: int, hi: int, analyzer: str = "word") -> DataFrame:
    """(keys, idx, tf): counts of the terms of ``vocab`` (term, idx), which is sent to every task, in each row of (keys, w)."""
    own = vocab.select("term", "idx").toArrow()
    kinds, tokens = (Known, TOKENS) if analyzer == "word" else (KnownChars, CHAR_TOKENS)
    held = lists.sparkSession.sparkContext.broadcast(
        kinds(own.column("term").to_pylist(), own.column("idx").to_numpy().astype(np.int64), lo, hi))
    keys = [c for c in lists.columns if c != "w"]
    kind = vocab.schema["idx"].dataType
    schema = T.StructType([*(lists.schema[c] for c in keys), T.StructField("_idx", T.ArrayType(kind)), T.StructField("_tf", T.ArrayType(T.LongType()))])
    number = pa.int32() if isinstance(kind, T.IntegerType) else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _slices(batch, tokens):
                row, idx, tf = held.value.met(x)  # rows ascend
                there, first = np.unique(row, return_index=True)
                ends = pa.array(np.r_[first, len(row)], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(v, t)) for v, t in ((idx, number), (tf, pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(rows.column(c).take(pa.array(there)) for c in keys), *lists], [*keys, "_idx", "_tf"])

    # a review's numbers are exchanged together, and partitioned on its id as the reviews were
    out = lists.mapInArrow(run, schema).repartition(keys[0])
    return out.select(*keys, F.explode(F.arrays_zip("_idx", "_tf")).alias("e")).select(*keys, F.col("e._idx").alias("idx"), F.col("e._tf").alias("tf"))
