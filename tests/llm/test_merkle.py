import hashlib
import random
import zlib

from pyspark.sql import functions as F

from revlens.llm import merkle as M
from revlens.llm.common import numbered


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf_of(r, text):
    i, own, lang, source, n = r
    return h(enc(i), enc(source), enc(lang), enc(n), enc(text))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k:k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, at):
    out = []
    for own in levels[:-1]:
        run = at // 3 * 3
        out.append(("".join(own[run:at]), "".join(own[at + 1:run + 3])))
        at //= 3
    return out


def plain(rows):
    by = {}
    for r in rows:
        i, text = r[0], r[1]
        cut = text is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        by.setdefault(r[3], []).append((i is not None, i or 0, leaf_of(r, text), leaf_of(r, text.replace("\n", "") if cut else text)))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s])]) for s in sources}
    upper = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for at, (known, i, leaf, held) in enumerate(sorted(by[s])):
            steps = path(trees[s], at) + path(upper, k)
            top = held
            for left, right in steps:
                top = h(left, top, right)
            out.append((i if known else None, leaf, trees[s][-1][0], upper[-1][0], h(*(x for st in steps for x in st)), top, top == upper[-1][0]))
    return sorted(out, key=str)


def run(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in M.op11_merkle(spark, str(tmp_path)).collect()), key=str)


def test_trees_of_all_heights_and_odd_rows(spark, docs_of, tmp_path):
    rng = random.Random(11)
    rows = [(i, rng.choice([f"a\nb{i}", "same\ntext", "", None, "ünï\n\n"]), rng.choice(["en", None]), s, rng.choice([3, None]))
            for s, n in (("a", 1), ("b", 3), ("é", 4), ("hot", 800), (None, 28), ("", 243), ("z", 2)) for i in range(n)]
    rows += rows[5:9] * 2 + [(None, "x\ny", None, "hot", 1), (None, None, None, None, None), (-7, "n\n", "en", "b", 2)]
    rng.shuffle(rows)
    docs = docs_of(rows).withColumns({"leaf": F.lit("clash"), "rank": F.lit(1), "key": F.lit("k"), "steps": F.lit(None).cast("string")})
    assert run(spark, tmp_path, docs.repartition(5)) == plain(rows)


def test_one_leaf_one_source_and_none(spark, docs_of, tmp_path):
    one = [(4, "t\nu", "en", "s", 3)]
    assert run(spark, tmp_path / "a", docs_of(one)) == plain(one)
    assert M.proof_digest is not None and plain(one)[0][4] == hashlib.sha256(b"").hexdigest()
    assert run(spark, tmp_path / "b", docs_of([])) == []


def test_only_changed_rows_fail(spark, docs_of, tmp_path):
    rows = [(i, "l\nm" if i % 2 else "lm", "en", f"s{i % 3}", 3) for i in range(60)]
    got = run(spark, tmp_path, docs_of(rows))
    assert {r[0]: r[6] for r in got} == {r[0]: not ("\n" in r[1] and zlib.crc32(str(r[0]).encode()) % 2 == 0) for r in rows}


def test_numbered_over_tasks_that_share_a_group(spark):
    rows = [("hot", i % 50) for i in range(3000)] + [("a", 1), ("a", None), ("z", 5), ("b", 3), ("b", 3)]
    got = numbered(spark.createDataFrame(rows, "g string, v int").repartition(7), "g", ["v"], "test-numbered").collect()
    by = {}
    for g, v, k in got:
        by.setdefault(g, []).append((k, v))
    for own in by.values():
        own.sort()
        assert [k for k, _ in own] == list(range(len(own)))
        values = [(v is not None, v or 0) for _, v in own]
        assert values == sorted(values)
    assert sum(map(len, by.values())) == len(rows)


def test_leaves_meet_no_python_row_by_row(spark, docs_of):
    plan = M.leaves(docs_of([(1, "x", "en", "s", 1)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
