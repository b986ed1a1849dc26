"""Passes read arrays that lie in files, which are there only while models are fitted."""
import os

import numpy as np
import pyarrow as pa

from revlens.operators import linear as N
from revlens.session import scratch_paths


def _blocks(spark, n=120, width=9):
    rng = np.random.default_rng(5)
    feat = [(i, int(f), float(rng.random())) for i in range(n) if i % 11 for f in rng.choice(width, 4, replace=False)]
    docs = [(i, int(rng.random() < 0.4 + 0.1 * (i % 3)), i % 3) for i in range(n)]
    return N.packed([(spark.createDataFrame(feat, "id int, idx int, value double"), spark.createDataFrame(docs, "id int, label int, fold int"))] * 2, 16)


SPECS = [N.Spec("a", 2.0, fold=1), N.Spec("b", 0.5, 1, pos=2.0), N.Spec("c", 1.0, loss="squared_hinge")]


def test_the_table_is_read_once_whatever_the_passes(spark):
    blocks = _blocks(spark)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b
    models = N.fit_many(blocks.mapInArrow(counted, blocks.schema), SPECS, [9, 9])
    assert max(m.passes for m in models) > 3 and read.value == blocks.count()


def test_files_give_the_models_of_the_table_and_go(spark, monkeypatch):
    blocks = _blocks(spark)
    got = N.fit_many(blocks, SPECS, [9, 9], tol=1e-8)
    left = [p for p in scratch_paths(spark) if "linear-arrays" in p and os.path.exists(p.removeprefix("file:"))]
    monkeypatch.setattr(N, "file_folder", lambda *_: None)
    for a, b in zip(got, N.fit_many(blocks, SPECS, [9, 9], tol=1e-8), strict=True):
        assert np.abs(a.w - b.w).max() < 1e-7 and abs(a.b - b.b) < 1e-7 and a.spec == b.spec
    assert not left


def test_sums_meet_in_several_parts(spark, monkeypatch):
    blocks = _blocks(spark)
    got = N.fit_many(blocks, SPECS[:2], [9, 9])
    monkeypatch.setattr(N, "MET", 4)
    for a, b in zip(got, N.fit_many(blocks, SPECS[:2], [9, 9]), strict=True):
        assert np.abs(a.w - b.w).max() < 1e-7
    assert N.fit_many(blocks.filter("feats = 7"), SPECS[:1], [9])[0].w.tolist() == [0.0] * 9


def test_a_block_is_the_same_from_its_bytes():
    size = np.array([0, 2, 3, 0])
    arrays = {"label": np.array([1.0, 0, np.nan, 1]), "fold": np.array([0, 1, 2, -1], np.int32), "col": np.array([4, 1, 0, 3, 3], np.int32),
              "row": np.repeat(np.arange(4, dtype=np.int32), size), "value": np.arange(5.0)}
    a = N._Block(pa.RecordBatch.from_pydict({"feats": [2], **{k: [x.tobytes()] for k, x in arrays.items()}}), 0)
    b = N._Block.read(a.plain(), 2, 4, 5)
    for name in ("label", "fold", "size", "value", "at", "start"):
        assert np.array_equal(getattr(a, name), getattr(b, name), equal_nan=name == "label")
    assert b.table == 2 and np.array_equal(a.products(np.eye(5)), b.products(np.eye(5)))
