"""Secret scan through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over the trigrams that any match
must contain. Every slice of documents gets an inverted index (trigram -> documents of the slice);
the rule's query is answered by intersecting and uniting postings, and only the candidate
documents are run through the regular expression. A rule without a mandatory trigram (a plain
character class, for instance) scans every document. The index folds A-Z to a-z, so a query never
misses a match, whatever the rule's case.

The index lives and dies with its slice, so nothing is shuffled: one narrow pass at any size.

Defined cases: a null text counts as empty and gives no span; empty tables give empty results;
repeated rows and ties each give their own row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as sre_parse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from revlens.llm.common import documents, slices, texts


@dataclass(frozen=True)
class Rule:
    """``group`` must have at least ``least`` characters, else the match is dropped."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0


# FIXED VALUES: the base rules of the contract, in listed order.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.IGNORECASE | re.ASCII, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 0, 24),
)
# FIXED VALUES: further public token formats; their spans are added to the base ones.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)

#: Alternatives that a concatenation may multiply out to before it is cut.
EXACT_LIMIT = 16


# --- Boolean trigram queries: True (no condition), int (a trigram), ("and"|"or", parts) ---------

def _gram(b: bytes) -> int:
    return b[0] << 16 | b[1] << 8 | b[2]


def _join(op: str, parts: list):
    neutral = op == "and"
    if op == "or" and (not parts or any(p is True for p in parts)):
        return True
    parts = list(dict.fromkeys(p for p in parts if not (neutral and p is True)))
    return True if not parts else parts[0] if len(parts) == 1 else (op, tuple(parts))


def _of_strings(strings: set[str]):
    """Any one of the strings occurs: its trigrams all do."""
    every = []
    for s in strings:
        raw = s.encode().lower()
        every.append(_join("and", [_gram(raw[i:i + 3]) for i in range(len(raw) - 2)]))
    return _join("or", every)


def _walk(items) -> tuple[set[str] | None, object]:
    """(all strings the sequence can match, if few; a query that any match satisfies)."""
    run: set[str] = {""}
    whole, conditions = True, []
    for op, arg in items:
        exact, query = _node(op, arg)
        if exact is not None and len(run) * len(exact) <= EXACT_LIMIT:
            run = {a + b for a, b in product(run, exact)}
            continue
        conditions += [_of_strings(run), query if exact is None else _of_strings(exact)]
        run, whole = {""}, False
    if whole:
        return run, _of_strings(run)
    return None, _join("and", [*conditions, _of_strings(run)])


def _node(op, arg) -> tuple[set[str] | None, object]:
    if op is sre.LITERAL:
        return {chr(arg)}, True
    if op is sre.SUBPATTERN:
        return _walk(arg[3])
    if op is sre.BRANCH:
        found = [_walk(x) for x in arg[1]]
        if all(e is not None for e, _ in found) and sum(len(e) for e, _ in found) <= EXACT_LIMIT:
            return set().union(*(e for e, _ in found)), _join("or", [q for _, q in found])
        return None, _join("or", [q for _, q in found])
    if op is sre.IN:
        if all(o is sre.LITERAL for o, _ in arg) and len(arg) <= EXACT_LIMIT:
            return {chr(c) for _, c in arg}, True
        return None, True
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, body = arg
        exact, query = _walk(body)
        if exact is not None and (low, high) == (0, 1):
            return exact | {""}, True
        return None, query if low else True
    return None, True


def trigram_query(pattern: str):
    """The Boolean trigram query of a regular expression; True if none is mandatory."""
    return _walk(sre_parse.parse(pattern))[1]


def _grams(query) -> set[int]:
    if query is True:
        return set()
    return {query} if isinstance(query, int) else set().union(*map(_grams, query[1]))


def _answer(query, postings: dict[int, np.ndarray]) -> np.ndarray:
    if isinstance(query, int):
        return postings.get(query, np.empty(0, np.int64))
    found = [_answer(q, postings) for q in query[1]]
    out = found[0]
    for more in found[1:]:
        out = np.intersect1d(out, more, assume_unique=True) if query[0] == "and" else np.union1d(out, more)
    return out


class Scanner:
    """Rules compiled once per task."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.patterns = [re.compile(r.pattern, r.flags) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.wanted = np.zeros(1 << 24, bool)
        self.wanted[sorted(set().union(*map(_grams, self.queries)))] = True

    def postings(self, raws: list[bytes]) -> dict[int, np.ndarray]:
        """Trigram -> ascending numbers of the texts holding it, for the trigrams that rules ask for."""
        ends = np.cumsum([len(r) + 3 for r in raws])  # three separators: no trigram spans two texts
        flat = np.frombuffer(b"\0\0\0".join([*raws, b""]).lower(), np.uint8).astype(np.uint32)
        if len(flat) < 3:
            return {}
        grams = flat[:-2] << 16 | flat[1:-1] << 8 | flat[2:]
        at = np.flatnonzero(self.wanted[grams])
        pairs = np.unique(grams[at].astype(np.int64) << 32 | np.searchsorted(ends, at, side="right"))
        if not len(pairs):
            return {}
        held, starts = np.unique(pairs >> 32, return_index=True)
        return {int(g): p & 0xFFFFFFFF for g, p in zip(held, np.split(pairs, starts[1:]), strict=True)}

    def scan(self, many: list[str]) -> list[list[tuple[int, int, int]]]:
        """Spans (start, rule number, end) of each text, sorted."""
        postings = self.postings([t.encode("utf-8", "surrogatepass") for t in many])
        found: list[list[tuple[int, int, int]]] = [[] for _ in many]
        for k, (rule, pattern, query) in enumerate(zip(self.rules, self.patterns, self.queries, strict=True)):
            for i in range(len(many)) if query is True else _answer(query, postings):
                found[i] += [(m.start(), k, m.end()) for m in pattern.finditer(many[i])
                             if m.end(rule.group) - m.start(rule.group) >= rule.least]
        return [sorted(x) for x in found]


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) for every row of ``df``: code points, end exclusive,
    by start and then in the rules' order."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for part in slices(batches):
            out = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in x] for x in scanner.scan(texts(part))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, span)], ["id", "spans"])

    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {kind}, spans array<struct<kind string, start bigint, end bigint>>") \
        .withColumnRenamed("id", id_col)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the spans of every document: counts of the base kinds, a hash of the base spans, all spans."""
    found = scan_secrets(documents(spark, sf_dir))
    base = [r.kind for r in BASE_RULES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [x or [] for x in batch.column(1).to_pylist()]
            said = [[f"{s['kind']}:{s['start']}:{s['end']}" for s in x] for x in spans]
            own = [[y for y, s in zip(a, x, strict=True) if s["kind"] in base] for a, x in zip(said, spans, strict=True)]
            counts = [pa.array([sum(s["kind"] == k for s in x) for x in spans], pa.int64()) for k in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts,
                 pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in own], pa.string()),
                 pa.array([",".join(x) for x in said], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return found.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
                                 "base_sha256 string, spans string")
