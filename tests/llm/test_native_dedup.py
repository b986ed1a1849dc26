import hashlib
import random

import pytest
from pyspark.sql import functions as F

from revlens.llm import exact_dedup as X
from revlens.llm import line_dedup as L

WHITE = {ord(c): None for c in " \t\n\x0b\x0c\r"}


def plain_groups(rows):
    norm = [(i, t or "", (t or "").translate(WHITE)) for i, t in rows]
    keep, size = {}, {}
    for i, t, n in norm:
        k = (-len(t), i is None, i)
        keep[n] = min(keep.get(n, k), k, key=lambda x: (x[0], x[1], x[2] or 0))
        size[n] = size.get(n, 0) + 1
    return sorted(((i, keep[n][2], size[n], (-len(t), i is None, i) == keep[n], hashlib.sha256(n.encode()).hexdigest())
                   for i, t, n in norm), key=str)


def some_texts(rng, count):
    base = ["".join(rng.choices("abé \n", k=rng.choice([0, 1, 5, 16, 17, 33, 100]))) for _ in range(12)]
    return [(rng.choice([i, i, i, None, 1]), rng.choice([b, b + " ", "\t" + b, b + "x", "ab" * rng.randint(0, 40)]))
            for i in range(count) for b in [rng.choice(base)]] + [(900, None), (901, ""), (902, " \r\x0b")]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_against_brute_force(spark, docs_of, weak):
    rng = random.Random(4)
    rows = some_texts(rng, 60)
    rows += rows[:3]
    block_hash = (lambda b: F.xxhash64(b) % 3) if weak else F.xxhash64
    got = X.exact_groups(docs_of([(*r, None, "s", 1) for r in rows]), size=16, block_hash=block_hash)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_groups(rows)


def test_exact_groups_at_the_production_size_and_empty(spark, docs_of):
    long = "wörd " * 9000
    rows = [(1, long), (2, long + "\n"), (3, long.replace(" ", "")), (4, long + "."), (5, "x" * X.BLOCK), (6, "x" * X.BLOCK)]
    got = X.exact_groups(docs_of([(*r, None, "s", 1) for r in rows])).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_groups(rows)
    assert X.exact_groups(docs_of([])).count() == 0


def plain_lines(rows):
    first, late, out = {}, {}, []
    for i, t in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0)):
        ls = t.split("\n")
        for k in range(len(ls) - 2):
            w = tuple(ls[k:k + 3])
            if any(x.strip(" ") for x in w) and first.setdefault(w, (i, k)) != (i, k):
                late.setdefault(i, set()).update({k, k + 1, k + 2})
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
        else:
            ls, gone = t.split("\n"), late.get(i, set())
            out.append((i, "\n".join(x for k, x in enumerate(ls) if k not in gone), len(ls), len(gone)))
    return sorted(out, key=str)


def test_lines_against_brute_force(spark, docs_of):
    rng = random.Random(6)
    rows = [(i, "\n".join(rng.choices(["a", "b", "", " ", "c d"], k=rng.randint(1, 14)))) for i in range(40)]
    rows += [(50, None), (51, ""), (None, "a\nb\nc d\na"), (52, "\n".join(["z"] * 400)), (53, "\n" * 9)]
    df = docs_of([(*r, None, "s", 1) for r in rows]).withColumn("places", F.lit(1)).withColumn("w", F.lit("x"))
    out = L.dedup_lines(df)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()), key=str) == plain_lines(rows)
    cleaned = L.clean_lines(df)
    assert cleaned.columns == df.columns and cleaned.filter("places <> 1 or w <> 'x'").count() == 0
    assert L.dedup_lines(docs_of([])).count() == 0


def test_repeated_rows_are_one_document(spark, docs_of):
    rows = [(1, "a\nb\nc\nd", None, "s", 1)] * 2 + [(2, "a\nb\nc\ne", None, "s", 1)]
    out = sorted((r.doc_id, r.text) for r in L.dedup_lines(docs_of(rows)).collect())
    assert out == [(1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (2, "e")]


def test_no_python_on_the_main_path(spark, docs_of):
    docs = docs_of([(1, "a\nb\nc", None, "s", 1)])
    for df in (L.dedup_lines(docs), X.exact_groups(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
