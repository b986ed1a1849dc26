import hashlib
import random
import re

from revlens.llm import decontaminate as D
from revlens.llm import secret_scan as S

SF = "/root/testdata/sf0.01"


def test_trigram_queries():
    assert S.trigram_query(r"[0-9a-f]+") is True
    assert S.trigram_query(r"(ab|cdef)") is True
    assert S.trigram_query("AKIA[A-Z0-9]+") == ("and", (S._gram(b"aki"), S._gram(b"kia")))
    q = S.trigram_query(S.BASE_RULES[0].pattern)
    assert q[0] == "or" and {S._gram(b"sec"), S._gram(b"ikey"[:3])} & S._grams(q)


def plain_spans(text, rules):
    return sorted((m.start(), k, m.end()) for k, r in enumerate(rules)
                  for m in re.finditer(r.pattern, text, r.flags) if len(m.group(r.group)) >= r.least)


def test_scanner_equals_plain_scan_on_random_texts():
    rules, rng = S.BASE_RULES + S.MORE_RULES, random.Random(3)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ": ", '"', "'", " ", "AKIA", "abc123",
             "A" * 17, "0f" * 13, "ghp_" + "a" * 36, "é", "ſecret", "\n", "x", "sk_live_" + "9" * 16,
             "-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + ".c", "xoxb-" + "1" * 12]
    many = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(600)] + ["", "ab", "secret=x" * 500]
    got = S.Scanner(rules).scan(many)
    assert got == [plain_spans(t, rules) for t in many]
    assert sum(map(len, got)) > 300


def test_op5_rows_and_empty(spark, docs_of):
    rows = [(1, None, None, "s", 1), (1, None, None, "s", 1), (2, "token = abcdef é password:12345", "en", None, None),
            (None, "AKIA" + "B" * 16, "en", "s", 1)]
    out = {(r.doc_id, r.n): r.spans for r in S.scan_secrets(docs_of(rows)).selectExpr(
        "doc_id", "size(spans) n", "transform(spans, s -> concat_ws(':', s.kind, s.start, s.end)) spans").collect()}
    assert out == {(1, 0): [], (2, 1): ["assign:0:14"], (None, 1): ["access:0:20"]}
    assert S.scan_secrets(docs_of([])).count() == 0


def test_op5_on_the_table(spark):
    got = {r.doc_id: r for r in S.op5_secret_scan(spark, SF).collect()}
    rules = S.BASE_RULES + S.MORE_RULES
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = plain_spans(d.text or "", rules)
        base = ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in want if k < 3)
        assert got[d.doc_id].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert got[d.doc_id].spans == ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in want)


def plain_hits(text, items, size=10):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))

    w, hit, seen = split(text or ""), set(), set()
    for item, t in items:
        x = split(t or "")
        for k in {tuple(x[i:i + size]) for i in range(max(1, len(x) - size + 1))} if x else ():
            for i in range(len(w) - len(k) + 1):
                if tuple(w[i:i + len(k)]) == k:
                    hit |= set(range(i, i + len(k)))
                    seen.add(str(item))
    return len(w), len(hit), sorted(seen)


def test_decontaminate_against_brute_force(spark, docs_of):
    rng = random.Random(5)
    vocab = ["a", "b", "É", "c9"]
    items = [(i, " ".join(rng.choices(vocab, k=n))) for i, n in enumerate([0, 1, 3, 4, 10, 11, 13, 25])] + [(9, None)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(0, 60))) for _ in range(60)]
    texts += [f"B, {items[6][1]}! {items[7][1]}", None, "", "...", items[5][1].upper(), "ab" * 9]
    docs = docs_of([(i, t, None, "x", 0) for i, t in enumerate(texts)])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for size, block in ((10, D.BLOCK_BYTES), (10, 20), (3, 40)):
        out = D.find_contamination(docs, bench, window=size, block_bytes=block).collect()
        assert len(out) == len(texts)
        for r in out:
            n, hit, seen = plain_hits(r.text, items, size)
            assert (r.n_words, sum(x.end - x.start for x in r.hit_words), r.hit_items) == (n, hit, seen)
            for w, o in zip(r.hit_words, r.hit_offsets, strict=True):
                assert len(D.words(r.text[o.start:o.end])) == w.end - w.start
    assert D.find_contamination(docs, bench.limit(0)).filter("size(hit_words) > 0").count() == 0
    assert D.drop_contaminated(docs, bench).columns == docs.columns


def test_op6_on_the_table(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = D.op6_decontaminate(spark, SF).collect()
    assert len(out) == len(docs)
    grams = {}
    for i, t in items:
        w = [x.decode() for x in D.words(t)]
        for k in range(max(1, len(w) - 9)):
            grams.setdefault(" ".join(w[k:k + 10]), set()).add(str(i))
    for r in out:
        line = " " + " ".join(x.decode() for x in D.words(docs[r.doc_id])) + " "
        seen = sorted(set().union(*(o for g, o in grams.items() if f" {g} " in line)))
        assert r.items_sha256 == hashlib.sha256(",".join(seen).encode()).hexdigest()
        assert r.contaminated == bool(seen)
