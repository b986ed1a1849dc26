import random

import numpy as np

from revlens.llm import langid as G


def test_every_gram_counts_in_any_number_of_blocks(spark, monkeypatch):
    """More than 200,000 distinct n-grams in one language, against the models of all counts in memory."""
    rng = random.Random(5)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    rows = [(i, "zh", "".join(rng.choices(letters, k=5000))) for i in range(60)]
    rows += [(100 + i, "en", "".join(rng.choices("abcde ", k=400))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    counts = {x: np.unique(G.grams([t for _, own, t in rows if own == x])[1], return_counts=True) for x in ("en", "zh")}
    assert len(counts["zh"][0]) > 250_000
    some = [rows[3][2][:300], rows[70][2], "abc " + letters[0], "xyz", "".join(rng.choices(letters, k=300))]
    want, _ = G.Models(counts).entropies(some)
    for size in (G.BLOCK_BYTES, 4 << 20):
        monkeypatch.setattr(G, "BLOCK_BYTES", size)
        models = G.fit_languages(docs)
        assert (len(models.blocks) > 1) == (size == 4 << 20)
        assert np.abs(models.entropies(some)[0] - want).max() < 1e-4
    got = G.identify(docs, models).select("lang", "lang_pred").distinct().collect()
    assert sorted(tuple(r) for r in got) == [("en", "en"), ("zh", "zh")]
