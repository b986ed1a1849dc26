"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

For every prefix of a string the BPE encoding of that prefix has exactly one last token. An
automaton over the vocabulary yields the tokens that end at each position; the one that is
compatible with the last token of the prefix before it is the entry of the table. Two tokens are
compatible if BPE on their joined text gives just these two back. Walking the table from the end
recovers the ids backwards, so a text costs time in proportion to its length.

No merge crosses a place that no vocabulary entry spans. Texts are therefore cut there (before a
run of word marks, and around characters that occur in no longer entry), and the pieces between
cuts are encoded once and remembered in a table of bounded size per Python worker.

The model file is read once by the driver and broadcast (its size does not depend on the data).
Supported models: BPE, identity normalisation, dummy prefix, no white-space removal, byte
fallback; another model raises ValueError.

Defined cases: a null text counts as empty and has no ids; repeated rows each give a row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from revlens.llm.common import documents, slices, texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
#: Entries and lengths that the per-worker tables hold at most.
HELD_PIECES, HELD_LENGTH, HELD_PAIRS = 100_000, 48, 250_000


class PieceCoder:
    """Encoder and decoder of one model, given as the bytes of its file."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        self.lib = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        if lib.normalize("  ﬁ ") != MARK * 3 + "ﬁ" + MARK:
            raise ValueError("only identity normalisation with a dummy prefix is supported")
        n = lib.vocab_size()
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) or lib.is_byte(i) for i in range(n)]
        self.text = [lib.id_to_piece(i) for i in range(n)]
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(lib.is_byte(i) for i in self.bytes):
            raise ValueError("only models with byte fallback are supported")
        self.score = {self.text[i]: lib.get_score(i) for i in range(n) if not special[i]}
        self.id_of = {self.text[i]: i for i in range(n) if not special[i]}
        if len(set(self.score.values())) < sum(len(t) > 1 for t in self.score):
            raise ValueError("only BPE models with distinct merge ranks are supported")
        joined = {c for t in self.score if len(t) > 1 for c in t}
        for c in sorted(joined - self.score.keys()):  # takes part in merges without an id of its own
            self.id_of[c] = len(self.text)
            self.text.append(c)
        self.size = [len(t) for t in self.text]
        machine = ahocorasick.Automaton()
        for t, i in self.id_of.items():
            machine.add_word(t, i)
        machine.make_automaton()
        self.matches = machine.iter
        self.cut = self.cutter(joined).findall
        self.pairs: dict[int, bool] = {}
        self.rank = {t: -s for t, s in self.score.items()}
        found = [self.merge(t) for t in self.text]
        self.alone = [x[-1] == t for x, t in zip(found, self.text, strict=True)]
        #: Rank of the merge that made a token, and its two parts; -1 for a single character.
        self.made = [self.rank[t] if len(t) > 1 and x else -1 for t, x in zip(self.text, self.alone, strict=True)]
        self.halves = [self.split(t) if m >= 0 else None for t, m in zip(self.text, self.made, strict=True)]
        self.held: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}  # the table before this one; what is used moves on
        self.said = [str(i) for i in range(n)]

    def cutter(self, joined: set[str]) -> re.Pattern:
        """Pattern of the pieces between cuts. A cut lies around a character of no longer entry, before
        a run of marks, and before signs that no entry holds right after a word character."""
        if any(MARK in t.lstrip(MARK) for t in self.score):
            return re.compile(f"[{''.join(map(re.escape, sorted(joined)))}]+|.", re.DOTALL)
        word = {c for c in joined if c.isalpha()}
        signs = joined - word - {MARK}
        bound = {b for t in self.score for a, b in zip(t, t[1:], strict=False) if a in word and b in signs}
        mark, word_, sign, bound_ = (f"[{''.join(map(re.escape, sorted(x)))}]" if x else "(?:(?!))"
                                     for x in ({MARK}, word, signs, bound))
        return re.compile(f"(?={mark}|{sign}|{word_}){mark}*{sign}*{word_}*(?:{bound_}{sign}*{word_}*)*|.", re.DOTALL)

    def split(self, text: str) -> tuple[int, int]:
        """The two tokens whose merge makes a token last."""
        left, right = self.merge(text, 2)
        return self.id_of[left], self.id_of[right]

    def merge(self, text: str, least: int = 1) -> list[str]:
        """BPE by its definition: join the best-scored neighbours, leftmost first, until none is left
        or only ``least`` parts are."""
        parts, score = list(text), self.score
        while len(parts) > least:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= HELD_PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = self.alone[a] and self.alone[b] and self.stays(a, b)
        return got

    def stays(self, a: int, b: int) -> bool:
        """Whether no merge across the border of two tokens came before the merges that made them:
        undo the latest merge of either side, step by step, and look at the border each time.
        Of equal ranks the left place merges first."""
        text, rank, halves, limit = self.text, self.rank, self.halves, float("inf")
        while True:
            across = rank.get(text[a] + text[b])
            if across is not None and across < limit:
                return False
            of_a, of_b = self.made[a], self.made[b]
            if of_a > of_b:
                limit, a = of_a, halves[a][1]
            elif of_b >= 0:
                limit, b = of_b + 1, halves[b][0]
            else:
                return True

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of a piece between two cuts, by the prefix table."""
        last = [-1] * (len(piece) + 1)
        size, alone, pairs, compatible = self.size, self.alone, self.pairs, self.compatible
        for end, token in self.matches(piece):
            end += 1
            if last[end] < 0:
                start = end - size[token]
                if start == 0:
                    if alone[token]:
                        last[end] = token
                else:
                    before = last[start]
                    if before >= 0:
                        ok = pairs.get(before << 32 | token)
                        if ok or ok is None and compatible(before, token):
                            last[end] = token
        ids: list[int] = []
        end = len(piece)
        while end:
            token = last[end]
            if token < 0:  # a character of no entry at all, always a piece by itself
                ids += [self.bytes[b] for b in reversed(piece[end - 1].encode("utf-8", "surrogatepass"))]
                end -= 1
            elif token >= len(self.said):
                ids += [self.bytes[b] for b in reversed(self.text[token].encode())]
                end -= 1
            else:
                ids.append(token)
                end -= size[token]
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        held = self.held
        cuts = self.cut(MARK + text.replace(" ", MARK))
        found = list(map(held.get, cuts))
        if None in found:
            for k, piece in enumerate(cuts):
                if found[k] is None:
                    found[k] = ids = held.get(piece) or self.older.get(piece) or self.encode_piece(piece)
                    if len(piece) <= HELD_LENGTH:
                        if len(held) >= HELD_PIECES:
                            self.older, self.held = held, (held := {})
                        held[piece] = ids
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> str:
        return self.lib.decode(ids)


@lru_cache(maxsize=2)
def _coder(model: bytes) -> PieceCoder:
    return PieceCoder(model)


def code_texts(df: DataFrame, columns: Callable[[PieceCoder, list[str]], list[pa.Array]], schema: str,
               model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, what ``columns`` makes of the texts by the coder) for every row."""
    with open(model, "rb") as f:
        held = df.sparkSession.sparkContext.broadcast(f.read())
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(held.value)
        names = [x.split()[0] for x in schema.split(", ")]
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), *columns(coder, texts(part))], ["id", *names])
        pa.default_memory_pool().release_unused()

    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def encode_texts(df: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every row."""
    def columns(coder: PieceCoder, many: list[str]) -> list[pa.Array]:
        ids = [coder.encode(t) for t in many]
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
        return [pa.array(np.diff(ends).astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                pa.array([coder.decode(x) if x else "" for x in ids], pa.string())]

    return code_texts(df, columns, "n_tokens bigint, ids array<int>, decoded string", model)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8")).hexdigest()

    def columns(coder: PieceCoder, many: list[str]) -> list[pa.Array]:
        n, ids_sha, text_sha, said = [], [], [], coder.said
        for t in many:
            ids = coder.encode(t)
            n.append(len(ids))
            ids_sha.append(sha(",".join([said[i] for i in ids])))
            text_sha.append(sha(coder.decode(ids) if ids else ""))
        return [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]

    return code_texts(documents(spark, sf_dir), columns, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
