import random

import numpy as np

from revlens.llm import langid as G


def test_all_training_rows_calibrate(spark):
    """More ids of a language than the former sample of 2,000; sharpness and limits are those of all rows in memory."""
    rng = random.Random(9)
    rows = [(i, "en", "".join(rng.choices("abcde ", k=rng.randrange(1, 30)))) for i in range(2600)]
    rows += [(5000 + i, "fr", "".join(rng.choices("cdefgh ", k=rng.randrange(1, 30)))) for i in range(300)]
    rows += rows[:40] + [(9000, "fr", None), (9001, None, "abc"), (9002, "en", "12 34"), (None, "fr", "fgh")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(5)
    models = G.fit_languages(docs)
    used = [(x, t) for _, x, t in rows if x is not None and t is not None]
    h, lettered = models.entropies([t for _, t in used])
    sharpness, limit = models.fitted(h[lettered], [x for (x, _), ok in zip(used, lettered, strict=True) if ok])
    assert models.sharpness == sharpness
    assert np.abs(models.limit - limit).max() < 1e-9
    assert len([1 for x, _ in used if x == "en"]) > 2000
