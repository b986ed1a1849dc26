import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from revlens.llm import token_shards as T
from revlens.llm.common import shared_uri

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def encoder():
    with open(T.VOCABULARY, encoding="utf-8") as f:
        return T.Encoder(f.read())


def test_pieces_equal_the_library_on_random_texts(encoder):
    rng = random.Random(1)
    pool = ["'s", "'t", "'re", "'ve", "'ll", "'d", "'m", "'", "''", " ", "  ", "\n", "\t", "a", "B", "word", "1", "23", "é",
            "½", "中", "!", "..", "　", "\x1c", "\x85", "'S", " '", "ß", "_", "😀", "\n\n", "<|endoftext|>"]
    many = ["".join(rng.choices(pool, [1] * 32 + [0.02], k=rng.randint(0, 12))) for _ in range(20_000)] + ["", "x" * 5000]
    got = []
    for i in range(0, len(many), 300):
        flat, n = encoder.encode(many[i:i + 300], 7)
        got += [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]
    assert got == [[*e.ids, 7] for e in encoder.lib.encode_batch(many, add_special_tokens=False)]


@pytest.mark.parametrize("n", [0, 1, 7, 513, 5000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 40, n).astype(np.uint16)
    w = T.WaveletMatrix.build(values, 7)
    assert np.array_equal(w.decode(), values)
    for i in range(0, n, max(1, n // 50)):
        assert w.access(i) == values[i]
    for token in (0, 3, 39, 41, 127, 128):
        at = np.flatnonzero(values == token)
        assert w.count(token) == len(at)
        assert w.count(token, n // 3, n // 2) == (values[n // 3:n // 2] == token).sum()
        for k in range(0, len(at), max(1, len(at) // 9)):
            assert w.select(token, k) == at[k]
        assert w.select(token, len(at)) == -1


def expect(docs):
    lib, start, out = Tokenizer.from_file(T.VOCABULARY), 0, []
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def test_op3_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, T.op3_token_shards(spark, SF).collect())) == expect(docs)


def test_many_shards_and_edge_rows(spark, docs_of):
    rows = [(3, "b c", None, None, 1), (3, "a", None, None, 1), (None, None, "x", "s", 1), (1, "", "en", "s", None),
            (2, "it's 12 — ok", None, None, 1), (2, "it's 12 — ok", None, None, 1)]
    folder = shared_uri(spark, "test-shards")
    names = T.write_shards(docs_of(rows), folder, shard_bytes=8)
    assert len(names) > 1
    got = sorted(map(tuple, T.read_shards(spark, folder, names).collect()), key=lambda r: r[1])
    assert got == expect([r[:2] for r in rows])
    assert T.write_shards(docs_of([]), shared_uri(spark, "test-shards")) == []
    assert T.read_shards(spark, folder, []).count() == 0
