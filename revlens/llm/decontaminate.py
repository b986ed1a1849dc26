"""Benchmark decontamination with one Aho-Corasick automaton.

Every benchmark item gives its windows of ten consecutive normalised words (one window if it has
fewer words). All windows go into one automaton; a document's normalised words, joined by single
spaces, are scanned once, and each occurrence covers document words, whose offsets in the original
text are kept.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after folding A-Z, that is ASCII letters, digits and
everything beyond ASCII.

Scale: documents are scanned where they lie, nothing is shuffled. Benchmark items are dealt into blocks
of about ``block_bytes`` of text (by hash of the item, counted first) and written to the shared folder;
a worker reads a block and builds its automaton once, and keeps it while there is one block. With more
blocks a task holds ``HELD_BYTES`` of texts and takes them past one block after another in one
step, so a larger benchmark costs more passes and never more memory, and nothing of it passes the driver.
An item longer than a block stands alone in memory, as any single text does.

Defined cases: a null or wordless text has no words, no window and no hit; equal windows of several
items count for each of them; repeated rows each give a row; an empty benchmark hits nothing; other
columns are ignored. A null item id is reported as the text ``null`` and is an item of its own.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import SLICE_BYTES, documents, extended, fresh, pieces, shared_uri, slices, table, text_bytes, texts

WINDOW = 10
BLOCK_BYTES = 4 << 20
#: Text bytes that a task takes past all blocks at once, where there are several.
HELD_BYTES = 32 << 20
#: Byte table: A-Z to a-z, every other ASCII byte outside words to a space; bytes of non-ASCII letters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Where each word of ``words(text)`` lies in the original, in code points, end exclusive."""
    return [m.span() for m in _WORD.finditer(text)]


def windows(text: str, size: int) -> set[tuple[bytes, ...]]:
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def _automaton(items: list[tuple[str, str]], size: int):
    """(the automaton, items of each window, words of each window)."""
    import ahocorasick

    owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, text in items:
        for w in windows(text, size):
            owners[w].add(item)
    machine, who, length = ahocorasick.Automaton(), [], []
    for w, own in owners.items():
        machine.add_word(f" {b' '.join(w).decode('latin-1')} ", len(who))
        who.append(sorted(own))
        length.append(len(w))
    if who:
        machine.make_automaton()
    return machine, who, np.array(length, np.int64)


def _hits(machine, who, length, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(words of the text, covered word ranges, items that occur)."""
    w = words(text)
    if not w or not who:
        return len(w), [], set()
    line = b" " + b" ".join(w) + b" "
    found = list(machine.iter(line.decode("latin-1")))
    if not found:
        return len(w), [], set()
    ends = np.array([e for e, _ in found])
    kinds = np.array([k for _, k in found])
    last = np.searchsorted(np.flatnonzero(np.frombuffer(line, np.uint8) == 32), ends)  # spaces before the end
    spans = sorted(zip((last - length[kinds]).tolist(), last.tolist(), strict=True))
    merged: list[tuple[int, int]] = []
    for a, b in spans:
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return len(w), merged, set().union(*(who[k] for k in set(kinds.tolist())))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, with_offsets: bool = True,
                       names: tuple[str, str, str] = ("n_words", "hit_words", "hit_items")) -> DataFrame:
    """``docs`` (doc_id, text, any others) plus n_words, hit_words (merged word ranges, end exclusive),
    hit_items (sorted ids) and, if asked for, hit_offsets (the ranges in code points of the original).
    Columns of ``docs`` with these names are replaced; ``names`` gives others to the first three."""
    items = benchmark.select(F.coalesce(F.concat(F.lit("i"), F.col("item_id").cast("string")), F.lit("n")).alias("item"),
                             F.coalesce("text", F.lit("")).alias("text"))
    blocks = pieces(text_bytes(items), block_bytes)
    folder = shared_uri(docs.sparkSession, "benchmark-blocks")
    items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")).repartition(blocks, "block") \
        .write.mode("append").partitionBy("block").parquet(folder)
    out = _pass(docs.drop(*(n for n in names if n in docs.columns)), folder, blocks, window, names)
    if with_offsets:
        out = out.drop("hit_offsets")
        out = out.mapInArrow(lambda batches: _offsets(batches, names[1]), extended(out, f"hit_offsets {_RANGES}"))
    return out


_RANGES = "array<struct<start:bigint,end:bigint>>"
_PA_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _replace(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    names = [*batch.schema.names, *(n for n in new if n not in batch.schema.names)]
    return pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names)


def _merge(many: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x, y in sorted(r for own in many for r in own):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def _ranges(many: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in x] for x in many], _PA_RANGES)


@lru_cache(maxsize=1)
def _block(folder: str, block: int, window: int):
    """The automaton of one written block."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    items: list[tuple[str, str]] = []
    for info in store.get_file_info(fs.FileSelector(f"{base}/block={block}", allow_not_found=True)):
        if info.path.endswith(".parquet"):
            with store.open_input_file(info.path) as file:
                got = pq.ParquetFile(file, pre_buffer=False).read(["item", "text"], use_threads=False)
            items += zip(got.column("item").to_pylist(), got.column("text").to_pylist(), strict=True)
    return _automaton(items, window)


def _pass(df: DataFrame, folder: str, blocks: int, window: int, names: tuple[str, str, str]) -> DataFrame:
    n_words, hit_words, hit_items = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def past() -> Iterator[pa.RecordBatch]:
            found = [[[] for _ in range(len(b))] for b in held]
            for block in range(blocks):
                parts = _block(folder, block, window)
                for b, own in zip(held, found, strict=True):
                    for k, t in enumerate(texts(b)):
                        own[k].append(_hits(*parts, t))
            for b, own in zip(held, found, strict=True):
                items = [sorted("null" if i == "n" else i[1:] for i in set().union(*(s for _, _, s in x))) for x in own]
                yield _replace(b, {
                    n_words: pa.array([x[0][0] for x in own], pa.int64()),
                    hit_words: _ranges([_merge([r for _, r, _ in x]) for x in own]),
                    hit_items: pa.array(items, pa.list_(pa.string()))})

        size = 0
        for batch in slices(batches):
            held.append(batch)
            size += SLICE_BYTES
            if blocks == 1 or size >= HELD_BYTES:
                yield from past()
                held, size = [], 0
        if held:
            yield from past()

    return df.mapInArrow(run, extended(df, f"`{n_words}` bigint, `{hit_words}` {_RANGES}, `{hit_items}` array<string>"))


def _offsets(batches: Iterator[pa.RecordBatch], hit_words: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for text, hits in zip(texts(batch), batch.column(hit_words).to_pylist(), strict=True):
            at = word_offsets(text) if hits else []
            out.append([(at[r["start"]][0], at[r["end"] - 1][1]) for r in hits or []])
        yield _replace(batch, {"hit_offsets": _ranges(out)})


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and occurring items of every document."""
    found = find_contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), with_offsets=False)
    n_hit = F.aggregate("hit_words", F.lit(0).cast("bigint"), lambda s, r: s + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.col("hit_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, with the columns they came with."""
    names = tuple(fresh(n, docs) for n in ("n_words", "hit_words", "hit_items"))
    found = find_contamination(docs, benchmark, with_offsets=False, names=names)
    return found.filter(F.size(names[1]) == 0).select(*docs.columns)
