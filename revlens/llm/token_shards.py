"""Token ids in wavelet-matrix shards.

Every text is encoded with the tokenizers library and ended by one end id. Documents are dealt in
ascending id order to ranges, and a task cuts its range into shards of about ``SHARD_BYTES`` of text (one
document at least), whatever the lengths and however often an id occurs. Each shard is one file: the
documents' ids and lengths and a wavelet matrix over the shard's tokens, one bit plane per bit of the
largest id with a directory of set bits. Access to a token, its rank, its count and its k-th occurrence
in a range are answered from the planes of that one file; ``decode`` undoes all planes at once. The list
of shards is a table; where a shard's tokens begin is a running sum over it.

File: ``RWM2``, the length of a JSON header (4 bytes), the header, then zstd sections in the order
doc ids, null flags, document lengths, planes (packed bits, first token in the lowest bit), and per
plane the set bits before every ``RANK_STEP``-th token.

A text's pieces are split as the file's byte-level pre-tokeniser does (over arrays of character
classes); each distinct piece is encoded by the library's model and remembered in a table of bounded
size per worker. With another pre-tokeniser, or where a text holds the spelling of a special token,
whole texts go to the library.

Writers write under a private name and move the file into place, so a task that is run again leaves
the same single file. Files lie in the shared checkpoint folder.

Defined cases: a null text counts as empty and holds the end id alone; a null id sorts first;
repeated ids keep all rows, ordered by the first ``LEAD`` characters and then a hash of their text; an empty table writes no shard; other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import code_points, documents, pieces, put_file, shared_uri, slices, text_bytes, texts
from revlens.operators.ranking import running_before
from revlens.session import written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SHARD_BYTES, END_ID = 16 << 20, 0
MAGIC, RANK_STEP = b"RWM2", 512
#: Pieces in a worker's table, and the code points a piece in it has at most.
HELD_PIECES, HELD_LENGTH = 1_000_000, 64
#: Characters of a text by which rows of one id are ordered.
LEAD = 32


class WaveletMatrix:
    """Bit planes of a sequence, highest bit first; each plane orders the next: zeros first, then ones."""

    def __init__(self, planes: list[np.ndarray], n: int, ranks: list[np.ndarray] | None = None):
        self.planes, self.n, self._ranks = planes, n, ranks

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        planes, order = [], values
        for b in range(bits - 1, -1, -1):
            ones = (order >> order.dtype.type(b) & order.dtype.type(1)).astype(bool)
            planes.append(np.packbits(ones, bitorder="little"))
            order = np.concatenate([order[~ones], order[ones]])
        return cls(planes, len(values))

    def _bits(self, plane: int) -> np.ndarray:
        return np.unpackbits(self.planes[plane], count=self.n, bitorder="little").view(bool)

    def decode(self) -> np.ndarray:
        """The whole sequence, from the last plane up."""
        out = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in range(len(self.planes) - 1, -1, -1):
            ones = self._bits(k)
            zeros = self.n - int(np.count_nonzero(ones))
            upper = np.empty_like(out)
            upper[~ones] = out[:zeros]
            upper[ones] = out[zeros:] | out.dtype.type(1 << len(self.planes) - 1 - k)
            out = upper
        return out

    @property
    def ranks(self) -> list[np.ndarray]:
        """Per plane the set bits before each step of RANK_STEP bits."""
        if self._ranks is None:
            step = RANK_STEP // 8
            self._ranks = []
            for p in self.planes:
                own = np.bitwise_count(np.pad(p, (0, -len(p) % step))).reshape(-1, step).sum(1, dtype=np.int64)
                self._ranks.append(np.concatenate([[0], np.cumsum(own)]))
        return self._ranks

    def _rank1(self, plane: int, i: int) -> int:
        """Set bits among the first i."""
        block = i // RANK_STEP
        at, left = block * RANK_STEP // 8, i % RANK_STEP
        raw = self.planes[plane][at:at + (left + 7) // 8]
        inside = int(np.bitwise_count(raw).sum())
        if left % 8:
            inside -= (int(raw[-1]) >> left % 8).bit_count()
        return int(self.ranks[plane][block]) + inside

    def _zeros(self, plane: int) -> int:
        return self.n - int(self.ranks[plane][-1])

    def _bit(self, plane: int, i: int) -> int:
        return int(self.planes[plane][i >> 3]) >> (i & 7) & 1

    def access(self, i: int) -> int:
        """Token at place i."""
        value = 0
        for k in range(len(self.planes)):
            bit = self._bit(k, i)
            value = value << 1 | bit
            ones = self._rank1(k, i)
            i = self._zeros(k) + ones if bit else i - ones
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences of [start, end) lie below the last plane."""
        if token >> len(self.planes):
            return 0, 0
        for k in range(len(self.planes)):
            a, b = self._rank1(k, start), self._rank1(k, end)
            if token >> len(self.planes) - 1 - k & 1:
                start, end = self._zeros(k) + a, self._zeros(k) + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of the token in [start, end)."""
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence, from 0; -1 if there are fewer."""
        a, b = self._range(token, 0, self.n)
        if k < 0 or a + k >= b:
            return -1
        i = a + k
        for plane in range(len(self.planes) - 1, -1, -1):
            if token >> len(self.planes) - 1 - plane & 1:
                i = self._select(plane, 1, i - self._zeros(plane))
            else:
                i = self._select(plane, 0, i)
        return i

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th bit of that value."""
        ranks = self.ranks[plane]
        seen = ranks if bit else np.minimum(np.arange(len(ranks)) * RANK_STEP, self.n) - ranks
        block = int(np.searchsorted(seen, k, side="right")) - 1
        at = block * RANK_STEP // 8
        inside = np.unpackbits(self.planes[plane][at:at + RANK_STEP // 8], bitorder="little")
        return block * RANK_STEP + int(np.flatnonzero(inside == bit)[k - int(seen[block])])


class Shard:
    """One file: documents and their tokens."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, lengths: np.ndarray, tokens: WaveletMatrix):
        self.ids, self.null, self.lengths, self.tokens = ids, null, lengths, tokens
        self.starts = np.concatenate([[0], np.cumsum(lengths)])

    def to_bytes(self) -> bytes:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        sections = [pack(x.tobytes()) for x in (self.ids, self.null, self.lengths, *self.tokens.planes, *self.tokens.ranks)]
        head = json.dumps({"docs": len(self.ids), "tokens": self.tokens.n, "planes": len(self.tokens.planes),
                           "sections": [len(s) for s in sections]}).encode()
        return b"".join([MAGIC, struct.pack("<I", len(head)), head, *sections])

    @classmethod
    def from_bytes(cls, raw: bytes) -> Shard:
        import zstandard

        if raw[:4] != MAGIC:
            raise ValueError("not a token shard")
        at = 8 + struct.unpack_from("<I", raw, 4)[0]
        head = json.loads(raw[8:at])
        unpack, parts = zstandard.ZstdDecompressor().decompress, []
        for n in head["sections"]:
            parts.append(unpack(raw[at:at + n]))
            at += n
        n = head["planes"]
        tokens = WaveletMatrix([np.frombuffer(p, np.uint8) for p in parts[3:3 + n]], head["tokens"],
                               [np.frombuffer(p, np.int64) for p in parts[3 + n:]])
        return cls(np.frombuffer(parts[0], np.int64), np.frombuffer(parts[1], bool), np.frombuffer(parts[2], np.int64), tokens)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Character class in the byte-level split: 1 letter, 2 number, 3 white space, 4 other."""
    import regex

    out = np.full(0x110000, 4, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            for c in m.group():
                out[ord(c)] = kind
    return out


# FIXED VALUES: endings that the byte-level split keeps with their apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def split_points(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of all texts begin in ``code_points``; the line break after a text is one too."""
    kind = _classes()[flat]
    kind[starts[1:] - 1] = 0  # the line break between two texts is a class of its own
    run = np.empty(len(kind) + 1, bool)
    run[0] = run[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=run[1:-1])
    begin = run[:-1].copy()
    begin[starts[1:] - 1] = True
    blank = np.zeros(len(kind) + 1, bool)  # the character before is a plain space of the same text
    blank[1:] = (flat == 32) & (kind == 3)
    solid = (kind == 1) | (kind == 2) | (kind == 4)
    begin &= ~(solid & blank[:-1])
    before = (kind[:-1] == 3) & solid[1:]  # the last white space before a solid run begins a piece
    begin[:-1] |= before
    marks = np.flatnonzero((flat == 39) & run[:-1] & run[1:] & ~blank[:-1])
    for p in marks.tolist():
        tail = "".join(map(chr, flat[p + 1:p + 3].tolist()))
        end = next((e for e in _ENDINGS if tail.startswith(e)), None)
        if end:
            begin[p + 1] = False
            begin[p + 1 + len(end)] = True
    return np.flatnonzero(begin)


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2 ** 64, from a table that grows in steps."""
    return _power_table(base, 1 << max(20, n.bit_length()))[:n]


@lru_cache(maxsize=4)
def _power_table(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


# FIXED VALUES: bases of the two polynomial hashes that compare pieces within a slice.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _hashes(flat: np.ndarray, begin: np.ndarray, base: int) -> np.ndarray:
    """64-bit hash of each piece from running sums."""
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _powers(base, len(flat)), out=sums[1:])
    end = np.append(begin[1:], len(flat))
    x = (sums[end] - sums[begin]) * _powers(pow(base, -1, 1 << 64), len(flat))[begin]
    return x ^ (x >> np.uint64(29))


class PieceTable:
    """Ids of pieces by the two hashes of a piece, in sorted arrays: a large part and a fresh one that
    is merged into it as it grows. A full table starts afresh."""

    def __init__(self, kind):
        self.store = np.zeros(1 << 16, kind)  # place 0 is the end id's
        self.used = 1
        none = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.large = self.fresh = none

    def __len__(self) -> int:
        return len(self.large[0]) + len(self.fresh[0])

    def find(self, first: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the store, number of ids) of each piece; -1 where it is unknown."""
        place = np.full(len(first), -1, np.int64)
        size = np.zeros(len(first), np.int64)
        for k1, k2, at, n in (self.large, self.fresh):
            if len(k1):
                i = np.minimum(np.searchsorted(k1, first), len(k1) - 1)
                hit = (k1[i] == first) & (k2[i] == check)
                place[hit], size[hit] = at[i[hit]], n[i[hit]]
        return place, size

    def put(self, ids: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """Store ids; their places and numbers."""
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        end = self.used + int(size.sum())
        if end > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(max(end, len(self.store)), self.store.dtype)])
        self.store[self.used:end] = np.fromiter(chain.from_iterable(ids), self.store.dtype, end - self.used)
        place = self.used + np.cumsum(size) - size
        self.used = end
        return place, size

    def name(self, *new: np.ndarray) -> None:
        """Remember pieces (first hash, second hash, place, number of ids)."""
        self.fresh = self._merged(self.fresh, new)
        if len(self.fresh[0]) * 4 > len(self.large[0]):
            self.large, self.fresh = self._merged(self.large, self.fresh), tuple(x[:0] for x in self.fresh)

    @staticmethod
    def _merged(old, new):
        both = [np.concatenate(x) for x in zip(old, new, strict=True)]
        by = np.argsort(both[0], kind="stable")
        return tuple(x[by] for x in both)


class Encoder:
    """The library's encoding, with a table of pieces."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(vocabulary)
        spec = json.loads(vocabulary)
        split = spec.get("pre_tokenizer") or {}
        self.by_piece = (split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
                         and split.get("use_regex", True) and not spec.get("normalizer"))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.width = max(1, int(self.lib.get_vocab_size() - 1).bit_length())
        self.kind = np.uint16 if self.width <= 16 else np.uint32
        self.table = PieceTable(self.kind)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte values that stand for themselves
        rest = [b for b in range(256) if b not in plain]
        self.byte_letter = {b: b for b in plain} | {b: 256 + k for k, b in enumerate(rest)}

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece: the library's model on the piece's bytes."""
        letters = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.byte_letter)
        return tuple([t.id for t in self.lib.model.tokenize(letters)])

    def encode(self, many: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, each with the end id; how many each text has)."""
        if not self.by_piece or any(s in t for t in many for s in self.special):
            ids = [[*e.ids, end_id] for e in self.lib.encode_batch_fast(many, add_special_tokens=False)]
            n = np.array([len(x) for x in ids], np.int64)
            return np.fromiter(chain.from_iterable(ids), self.kind, int(n.sum())), n
        flat, starts = code_points(many)
        begin = split_points(flat, starts)
        ends = np.append(begin[1:], len(flat))
        first, check = (_hashes(flat, begin, b) for b in _BASES)
        long = np.flatnonzero(ends - begin > HELD_LENGTH)  # long pieces stand for themselves
        first[long], check[long] = np.arange(len(long)), 0
        _, sample, which = np.unique(first, return_index=True, return_inverse=True)
        if not np.array_equal(check[sample][which], check):  # two pieces share a hash: tell them apart by both
            _, sample, which = np.unique(np.stack([first, check], 1), axis=0, return_index=True, return_inverse=True)
            which = which.ravel()
        table = self.table
        if len(table) > HELD_PIECES:
            table = self.table = PieceTable(self.kind)
        place, size = table.find(first[sample], check[sample])
        alone = ends[sample] - begin[sample] > HELD_LENGTH
        new = np.flatnonzero((place < 0) | alone)
        if len(new):
            line = "\n".join([*many, ""])
            at = sample[new]
            place[new], size[new] = table.put([self.piece(line[a:b]) for a, b in
                                               zip(begin[at].tolist(), ends[at].tolist(), strict=True)])
            named = new[~alone[new]]
            table.name(first[sample[named]], check[sample[named]], place[named], size[named])
        place, n = place[which], size[which]
        last = np.searchsorted(begin, starts[1:] - 1)  # the line break after each text: its end id
        table.store[0] = end_id
        place[last], n[last] = 0, 1
        done = np.cumsum(n)
        out = table.store[np.repeat(place - done + n, n) + np.arange(int(done[-1]) if len(done) else 0)]
        return out, np.diff(done[last], prepend=0)


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def shard_table(df: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write (doc_id, text) into shard files of ``folder`` (a URI); table (place, part, name, docs, tokens) of them,
    whose order is that of (place, part)."""
    spark = df.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        held = spark.sparkContext.broadcast(f.read())
    rows = df.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    # rows of one id, equal ones too, are dealt to as many ranges as they need
    keys = [F.asc_nulls_first("doc_id"), F.substring("text", 1, LEAD), F.xxhash64("text"), F.col("tie")]
    dealt = (rows.withColumn("tie", F.monotonically_increasing_id())
             .repartitionByRange(pieces(text_bytes(rows), shard_bytes), *keys).sortWithinPartitions(*keys).drop("tie"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place, done = _encoder(held.value), TaskContext.get().partitionId(), []
        ids, null, lengths, tokens = [], [], [], []

        def close() -> None:
            n, flat = np.concatenate(lengths), np.concatenate(tokens)
            tokens.clear()
            shard = Shard(np.concatenate(ids), np.concatenate(null), n, WaveletMatrix.build(flat, encoder.width))
            name = f"part-{place:08d}-{len(done):05d}.rwm"
            put_file(folder, name, shard.to_bytes())
            done.append((place, len(done), name, len(n), len(flat)))
            for own in (ids, null, lengths):
                own.clear()

        size = 0
        for part in slices(batches, limit=1 << 20):
            bytes_ = int(pa.compute.sum(pa.compute.binary_length(part.column("text"))).as_py() or 0)
            if lengths and size + bytes_ > shard_bytes:
                close()
                size = 0
            own = part.column("doc_id")
            ids.append(own.fill_null(0).to_numpy(zero_copy_only=False))
            null.append(own.is_null().to_numpy(zero_copy_only=False))
            flat, n = encoder.encode(texts(part), end_id)
            lengths.append(n)
            tokens.append(flat)
            size += bytes_
        if lengths:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(
            (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["place", "part", "name", "docs", "tokens"])

    return written(dealt.mapInArrow(write, "place int, part int, name string, docs bigint, tokens bigint"), "shards")


def write_shards(df: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                 shard_bytes: int = SHARD_BYTES) -> list[tuple[str, int, int]]:
    """``shard_table`` as a list of (name, documents, tokens) in order, for a few shards."""
    done = shard_table(df, folder, vocabulary, end_id, shard_bytes).collect()
    return [(r.name, r.docs, r.tokens) for r in sorted(done)]


def read_shards(spark: SparkSession, folder: str, shards: DataFrame | list[tuple[str, int, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of ``shard_table`` or ``write_shards``."""
    if isinstance(shards, list):
        shards = spark.createDataFrame([(k, 0, *x) for k, x in enumerate(shards)], "place int, part int, name string, docs bigint, tokens bigint")
    count = shards.count()
    first = running_before(shards, ["place", "part"], weight_col="tokens", out="first")
    listed = first.select("name", "first").repartition(max(1, count), "name")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{name}") as f:
                    shard = Shard.from_bytes(f.read())
                flat, at = shard.tokens.decode(), shard.starts.tolist()
                crc = [zlib.crc32(flat[a:b].astype("<u4")) for a, b in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.ids, mask=shard.null), pa.array(shard.starts[:-1] + first), pa.array(shard.lengths),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the shard files."""
    folder = shared_uri(spark, "token-shards")
    return read_shards(spark, folder, shard_table(documents(spark, sf_dir), folder))
