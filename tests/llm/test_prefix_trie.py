import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from revlens.llm import prefix_trie as T


def plain_trie(seqs):
    """seqs: conv_id -> list of (role, text)."""
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        mine = 1 if not kids.get(p) else 0
        leaves[p] = leaves.get(p, 0) + mine
        saved[p] = saved.get(p, 0) + ((len(nodes[p]) - 1) * len(p[-1][1]) if p else 0)
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
            leaves[p[:-1]] = leaves.get(p[:-1], 0) + leaves[p]
            saved[p[:-1]] = saved.get(p[:-1], 0) + saved[p]
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p)))).encode()).hexdigest())
                  for p, m in nodes.items())


def plain_rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h, first = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        out[c] = own.get(first, [])[:h] + v[h:]
    return out


@pytest.fixture(scope="module")
def talks_of(spark):
    return lambda rows: spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def run(talks, page=T.PAGE):
    return sorted(tuple(r) for r in T.prefix_trie(T.rebuilt(T.ordered_turns(talks)), page).collect())


def some_talks(rng, ids, longest):
    rows = []
    for c in ids:
        for t in range(rng.choice([1, 2, 3, 5, 8, longest])):
            rows.append((c, t, rng.choice(["u", "u", None]), rng.choice(["x", "x", "yé", "", None, "𝒳z"]) if t < 7 or rng.random() < 0.1 else "x"))
    return rows


@pytest.mark.parametrize("page", [1, 2, T.PAGE])
def test_against_brute_force(spark, talks_of, page):
    rng = random.Random(page)
    rows = some_talks(rng, [*range(0, 40), *range(100, 130), *range(-5, 3), 305, 7000, 7001], 33 if page < T.PAGE else 140)
    rng.shuffle(rows)
    talks = talks_of([r for r in rows if r[0] != 100]).withColumns({"at": F.lit(1), "name": F.lit("n"), "n": F.lit(None).cast("int")})
    assert run(talks.repartition(6), page) == plain_trie(plain_rebuilt([r for r in rows if r[0] != 100]))


@pytest.mark.parametrize("size", [4, 63, 64, 65, 128, 129])
def test_whole_pages(spark, talks_of, size):
    rows = [(c, t, "u", f"{t % 5}" if c < 203 or t < size // 2 else "o") for c in (200, 201, 202, 203) for t in range(size)]
    assert run(talks_of(rows)) == plain_trie(plain_rebuilt(rows))


def test_null_ids_turns_ties_repeats_and_bare_conversations(spark, talks_of):
    rows = [(None, 0, "u", "lost"), (1, None, "u", "first"), (1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, "t", "a"), (301, 0, "u", "gone"),
            (302, 0, None, None), (200, 0, "u", "a" * 100_000), (200, 1, "a", "z"), (201, 0, "u", "q"), (202, 0, "u", "q")]
    got = run(talks_of(rows))
    assert got == plain_trie(plain_rebuilt(rows))
    bare = [c for c, s in plain_rebuilt(rows).items() if not s]
    assert bare and next(r for r in got if r[1] == 0)[7] == hashlib.sha256(",".join(map(str, sorted(bare))).encode()).hexdigest()


def test_only_bare_conversations_and_none(spark, talks_of):
    ids = [c for c in range(301, 399) if zlib.crc32(str(c).encode()) % 6 >= 1][:4]
    rows = [(c, 0, "u", "t") for c in ids]
    assert run(talks_of(rows)) == plain_trie(plain_rebuilt(rows))
    assert run(talks_of([])) == []


def test_hot_conversation_and_hot_turn(spark, talks_of):
    rows = [(7, t, "u", f"{t % 3}") for t in range(900)]
    rows += [(c, t, "s", "same" if t == 0 else f"{c}") for c in range(1000, 1150) for t in range(3)]
    assert run(talks_of(rows)) == plain_trie(plain_rebuilt(rows))


def test_chunks_of_a_node_are_streamed(spark, monkeypatch):
    rows = [(b"n" * 16, c) for c in range(-20, 3000, 7)] + [(b"m" * 16, 5)]
    ends = spark.createDataFrame(rows, "node binary, conv_id bigint")
    got = {bytes(r[0]): r[1] for r in T.end_digests(ends.repartition(4)).collect()}
    want = {k: hashlib.sha256(",".join(map(str, sorted(c for n, c in rows if n == k))).encode()).hexdigest() for k in {n for n, _ in rows}}
    assert got == want
