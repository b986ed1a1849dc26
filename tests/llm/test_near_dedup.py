import random

import numpy as np
import pytest

from revlens.llm import near_dedup as N

SF = "/root/testdata/sf0.01"


def plain_set(text, words):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def plain_groups(rows, words=4, percent=80):
    sets = [plain_set(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j > i}:
            if len(s & sets[j]) * 100 >= len(s | sets[j]) * percent:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d, d == (least.get(find(i)) if s else d))
                   for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for m, shared in ((1, 1), (40, 36), (500, 300)):
        agree = []
        for _ in range(60):
            a = rng.integers(0, 1 << 63, m).astype(np.uint64)
            b = np.concatenate([a[:shared], rng.integers(0, 1 << 63, m - shared).astype(np.uint64)])
            k = N.sketches([a, b])
            assert (k != N._EMPTY).all()
            agree.append((k[0] == k[1]).mean())
        assert abs(np.mean(agree) - shared / (2 * m - shared)) < 0.02


def families(rng):
    """Near copies of several bases at all similarities, chains, and a passage that many share."""
    rows, vocab = [], [f"w{i}" for i in range(400)]
    passage = rng.choices(vocab, k=30)
    for f in range(6):
        base = rng.choices(vocab, k=rng.choice([3, 5, 30, 80]))
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append(" ".join(w) + rng.choice(["", " ", "\n"]))
        for k in range(15):  # a chain of texts that each share most with the one before
            rows.append(" ".join(vocab[10 * f + k:10 * f + k + 60]))
    rows += [" ".join(passage + rng.choices(vocab, k=rng.randint(0, 40))) for _ in range(60)]
    rows += ["", "...", "a b", "A b", "a b c", None, " \t"] + [" ".join(passage).upper()] * 5
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words", [4, 5])
def test_groups_against_brute_force(spark, docs_of, words):
    rows = families(random.Random(words))
    got = collected(N.near_groups(docs_of([(*r, None, "s", 1) for r in rows]), words))
    assert got == plain_groups(rows, words)


def test_edge_rows(spark, docs_of):
    rows = [(5, "a b c d e"), (5, "x y z q r"), (3, "a B c d e"), (None, "a b c d e"), (None, None), (7, "x y z q r"),
            (7, "x y z q r"), (8, ""), (9, "p q")]
    docs = docs_of([(*r, None, "s", 1) for r in rows])
    assert collected(N.near_groups(docs)) == plain_groups(rows)
    kept = N.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert N.near_groups(docs_of([])).count() == 0


def test_op2_on_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert collected(N.op2_near_dedup(spark, SF)) == plain_groups(rows)


def test_a_large_family_is_not_compared_pair_by_pair(spark, docs_of, monkeypatch):
    """Copies with random edits, many of them just below the bound to each other."""
    rng, vocab = random.Random(9), [f"w{i}" for i in range(3000)]
    base = rng.choices(vocab, k=160)
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    formed, plain = [], N._similarities

    def counted(pairs, sets):
        pairs = N.written(pairs, "test-pairs")
        formed.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(N, "_similarities", counted)
    got = collected(N.near_groups(docs_of([(*r, None, "s", 1) for r in rows])))
    assert got == plain_groups(rows)
    assert len({r[2] for r in got}) > 20  # many stay outside the largest component
    assert sum(formed) < 20 * len(rows)  # all pairs would be 200 times the rows


def test_parts_bound_what_two_sets_share(spark):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.choice(3000, size).astype(np.uint64)) for size in (3, 40, 400, 2500, 3000)]
    rows = spark.createDataFrame([(i, [int(x) for x in s], [int(x) for x in s[:i]] or None) for i, s in enumerate(sets)],
                                 "node bigint, set array<bigint>, own array<bigint>")
    got = {r.node: r for r in N._shared_parts(rows).collect()}
    for i, s in enumerate(sets):
        assert (got[i].n, got[i].shared) == (len(s), len(s) - i)
        for j, t in enumerate(sets):
            bits = sum((x & y & (1 << 64) - 1).bit_count() for x, y in zip(got[i].parts, got[j].parts, strict=True))
            assert bits + min(got[i].over, got[j].over) >= len(np.intersect1d(s[i:], t[j:]))
