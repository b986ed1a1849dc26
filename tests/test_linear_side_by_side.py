"""Models fitted side by side are those fitted alone."""
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from revlens.operators import linear as N


def _docs(spark, n=60):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    return spark.createDataFrame([(i, i % 2, rnd.choices(words, [1 / (k + 1) for k in range(40)], k=rnd.randrange(1, 30))) for i in range(n)],
                                 "id long, label int, words array<string>").repartition(4, "id")


def test_one_pass_for_many_models(spark):
    """A block's coefficients are gathered once for all models of its table."""
    docs = _docs(spark)
    feat = docs.select("id", F.explode("words").alias("w")).groupBy("id", "w").count().select(
        "id", F.expr("cast(substring(w, 2) as int)").alias("idx"), F.col("count").alias("value"))
    lab = docs.select("id", F.col("label"), (F.col("id") % 3).alias("fold"))
    specs = [N.Spec("a", 1.0, fold=0), N.Spec("b", 5.0, fold=-1, pos=2.0), N.Spec("c", 0.5, fold=1, loss="squared_hinge")]
    together = N.fit_many(N.packed([(feat, lab)], 16), specs, [40], 4)
    for spec, m in zip(specs, together, strict=True):
        alone = N.fit_many(N.packed([(feat, lab)], 16), [spec], [40], 4)[0]
        assert abs(alone.w - m.w).max() < 1e-5 and abs(alone.b - m.b) < 1e-5


def test_products_of_a_block_with_empty_rows():
    rng = np.random.default_rng(4)
    size = np.array([0, 3, 0, 5, 1, 0])
    row, col, value = np.repeat(np.arange(6), size), rng.integers(0, 7, 9), rng.random(9)
    arrays = {"label": np.zeros(6), "fold": np.zeros(6, np.int32), "col": col.astype(np.int32), "row": row.astype(np.int32), "value": value}
    batch = pa.RecordBatch.from_pydict({"feats": [0], **{k: [x.tobytes()] for k, x in arrays.items()}})
    dense, w = np.zeros((6, 7)), rng.random((7, 3))
    np.add.at(dense, (row, col), value)
    assert np.abs(N._Block(batch, 0).products(w) - (dense @ w).T).max() < 1e-12
