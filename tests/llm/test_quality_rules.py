import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from revlens.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def norm(line):
    return " ".join(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(line))


def plain(rows, min_docs, max_percent):
    one = dict.fromkeys((i, s, t or "") for i, t, _, s, _ in rows)
    docs, seen = Counter(s for _, s, _ in one), Counter()
    for _, s, t in one:
        seen.update({(s, norm(x)) for x in t.split("\n") if words(x)})
    often = {k for k, n in seen.items() if n > min_docs and n * 100 > docs[k[0]] * max_percent}
    out = []
    for i, t, _, s, _ in rows:
        t = t or ""
        ws, said = words(t), [x for x in t.split("\n") if words(x)]
        wins = Counter(tuple(ws[k:k + 8]) for k in range(len(ws) - 7))
        rep = {k + j for k in range(len(ws) - 7) if wins[tuple(ws[k:k + 8])] > 1 for j in range(8)}
        left = len(ws) - sum(len(words(x)) for x in said if (s, norm(x)) in often)
        failed = len(ws) < 20 or 100 * len(rep) > 30 * len(ws)
        kept = not failed and (left == len(ws) or (left * 2 >= len(ws) and left >= 20))
        out.append((i, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(said) - len(set(said)), len(rep), left, failed, kept))
    return sorted(out, key=str), often


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "words_left", "base_failed", "kept"]


def some_rows(rng):
    lines = ["Home | About us | Contact", "home  |  about US\t| contact", "Alle Rechte vorbehalten ÄÖ", "", "   ", "#1 *a* $3 <b>", "\x85x y z"]
    rows = []
    for i in range(240):
        own = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 8, 30]))) for _ in range(rng.randint(0, 4))]
        text = "\n".join(rng.sample(lines, rng.randint(0, 3)) + own + (own[:1] if rng.random() < 0.2 else []))
        rows.append((rng.choice([i, i, None, 3]), rng.choice([text, text, text, None, ""]), "en", rng.choice(["hot", "hot", "b", None]), 1))
    return rows + rows[:40] + [(900, "a b c d e f g h " * 40, "en", "b", 1), (901, "x " * 60_000 + "end", "en", "b", 1)]


def test_against_brute_force(spark, docs_of):
    rng = random.Random(13)
    rows = some_rows(rng)
    for limits in [(5, 1), (20, 10), (0, 0)]:
        docs = docs_of(rows).withColumns({"host": F.lit("clash"), "a": F.lit(1), "n": F.lit(2), "lines": F.lit("l")}).repartition(4)
        got = sorted((tuple(r[c] for c in COLUMNS) for r in Q.judged(docs, *limits).collect()), key=str)
        want, often = plain(rows, *limits)
        assert got == want
        assert often


def test_kept_texts_lose_frequent_lines_and_keep_columns(spark, docs_of):
    body = " ".join(f"v{k}" for k in range(30))
    rows = [(i, f"Menu one two\n\n{body} {i}\nmenu  ONE two", "en", "h", 5) for i in range(12)] + [(50, "Menu one two", "en", "h", 1), (51, body, "en", "g", 1)]
    docs = docs_of(rows).withColumn("_a", F.lit("own"))
    got = {r.doc_id: r for r in Q.kept_texts(docs, 3, 1).collect()}
    assert sorted(got) == [*range(12), 51]
    assert got[3].text == f"\n{body} 3" and got[3]._a == "own" and got[51].text == body
    assert Q.kept_texts(docs, 3, 1).columns == docs.columns


def test_windows_that_share_a_key_are_compared(monkeypatch):
    rng = np.random.default_rng(5)
    for _ in range(30):
        text = np.sort(rng.integers(0, 4, 60))
        ids = rng.integers(0, 2, 60)
        want = np.zeros(4, np.int64)
        for t in range(4):
            own = ids[text == t].tolist()
            wins = Counter(tuple(own[k:k + 3]) for k in range(len(own) - 2))
            want[t] = len({k + j for k in range(len(own) - 2) if wins[tuple(own[k:k + 3])] > 1 for j in range(3)})
        assert Q.repeat_words(ids, text, 4, window=3).tolist() == want.tolist()


def test_words_of_a_text_over_many_blocks():
    raw = "ä bb  ccc\n" * 5000
    known = {}
    assert sum(len(x) for x in Q._word_ids(raw.encode(), known, step=1000)) == 15000 and len(known) == 3


def test_empty_table(spark, docs_of):
    assert Q.judged(docs_of([])).count() == 0 and Q.kept_texts(docs_of([])).count() == 0
