import hashlib
import random

import pytest
import sentencepiece

from revlens.llm import piece_bpe as B

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def coder():
    with open(B.MODEL, "rb") as f:
        return B.PieceCoder(f.read())


def test_prefix_table_equals_the_library_on_random_texts(coder):
    rng, entries = random.Random(1), sorted(coder.score)
    many = ["", " ", "\x00", "a" * 3000, " " * 700, "▁ ▁"]
    for _ in range(4000):
        many.append("".join(rng.choice([
            rng.choice(entries), rng.choice(entries).replace("▁", " "), chr(rng.randint(32, 126)), " " * rng.randint(1, 20),
            chr(rng.choice([0x4E00, 0x1F600, 0xE9, 10, 9, 0, 0x3000])), rng.choice("abcdefgh") * rng.randint(1, 30)])
            for _ in range(rng.randint(1, 8))))
    assert [coder.encode(t) for t in many] == coder.lib.encode(many)


def test_pair_test_equals_bpe_on_the_pair(coder):
    rng = random.Random(2)
    ids = [i for i, ok in enumerate(coder.alone) if ok]
    for _ in range(5000):
        a, b = rng.choice(ids), rng.choice(ids)
        assert coder.stays(a, b) == (coder.merge(coder.text[a] + coder.text[b]) == [coder.text[a], coder.text[b]])


def test_op4_on_the_table(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=B.MODEL)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = B.op4_sentencepiece(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = lib.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_edge_rows(spark, docs_of):
    rows = [(1, None, None, "s", 1), (1, None, None, "s", 1), (2, "", "en", None, None), (None, "hi  there", "en", "s", 1)]
    out = sorted(((r.n_tokens, r.decoded) for r in B.encode_texts(docs_of(rows)).collect()), key=str)
    assert out[:3] == [(0, ""), (0, ""), (0, "")] and out[3][1] == "hi  there"
    assert B.encode_texts(docs_of([])).count() == 0
