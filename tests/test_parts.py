"""What grows with the reviews is dealt to parts of a bounded size."""
import random

from pyspark.sql import functions as F

from revlens.operators import embed as EM
from revlens.operators import features as FT
from revlens.plans import q_learn as Q


def test_parts_of_reviews_grow_with_their_text(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    docs = spark.createDataFrame([(i, "w" * 99) for i in range(20 * cores)], "id int, text string")
    assert FT.review_parts(docs) is None
    monkeypatch.setattr(FT, "PART_CHARS", 990)
    assert FT.review_parts(docs) == 2 * cores
    assert FT.by_review(docs, "id").rdd.getNumPartitions() == 2 * cores
    words = docs.select("id", F.array(F.col("text"), F.lit(None).cast("string")).alias("words"))
    assert FT.cleaned(words).rdd.getNumPartitions() == -(-101 * 20 * cores // 990)
    assert FT.review_parts(docs.filter("id < 0")) is None


def test_sums_of_vectors_by_parts(spark, monkeypatch):
    """A table of vectors that isn't broadcast: a sum for each review and part is exchanged, with the same means."""
    rng = random.Random(5)
    names = [f"w{k}" for k in range(30)]
    tokens = spark.createDataFrame([(f"r{i}", rng.choices([*names, "unknown", None], k=rng.randrange(0, 40))) for i in range(25)],
                                   "id string, words array<string>")
    vectors = spark.createDataFrame([(w, [rng.random() for _ in range(3)]) for w in [*names, "w1", "w1", None]], "word string, vector array<double>")
    rows = lambda: {r["id"]: (r["n_known"], r["vector"]) for r in EM.mean_word_vector(tokens, vectors, 3).collect()}
    want = rows()
    for setting, value in (("BROADCAST_BYTES", 0), ("PART_BYTES", 400), ("GROUP_ROWS", 60), ("SUM_ROWS", 7)):
        monkeypatch.setattr(EM, setting, value)
    got = rows()
    assert got.keys() == want.keys()
    for k, (n, v) in want.items():
        assert got[k][0] == n and max(abs(a - b) for a, b in zip(got[k][1], v, strict=True)) < 1e-12
    sums = EM._part_sums(EM._counted(tokens, "id", "words"), vectors, 3, "id", 4)
    per = sums.groupBy("id").count().agg(F.max("count")).first()[0]
    assert 1 < per <= 4


def test_word2vec_takes_no_more_parts_than_tasks(spark, monkeypatch):
    asked = []

    class Recorder:
        def __init__(self, **kw):
            asked.append(kw["numPartitions"])

        def fit(self, sentences):
            return self

    monkeypatch.setattr(EM, "Word2Vec", Recorder)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    sentences = spark.createDataFrame([(["a", "b"],)], "words array<string>")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "500")
        EM.train_word2vec(sentences)
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        EM.train_word2vec(sentences)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    EM.train_word2vec(sentences, num_partitions=77)
    assert asked == [spark.sparkContext.defaultParallelism, 1, 77]


def test_fold_scores_in_the_same_passes(spark):
    """Every C and fold at once gives the scores of the fits one by one."""
    from pyspark.ml.linalg import Vectors

    from revlens.operators import linear as N
    rng = random.Random(2)
    rows = [(i, float(rng.random() < 0.3 + 0.4 * (i % 2)), i % 3, Vectors.dense([rng.random(), i % 2, rng.random()])) for i in range(60)]
    folded = spark.createDataFrame(rows, ["id", "label", "fold", "features"]).withColumn("fold", F.col("fold").cast("int"))
    specs = [N.Spec(f"lr_c{C:g}|{f}", C, 0, f) for C in (1.0, 30.0) for f in range(3)]
    got = {(r["id"], r["model"]): (r["fold"], r["label"], r["p"]) for r in Q._fold_scores(N.packed_vectors([folded]), specs, [3])[0].collect()}
    assert len(got) == 120
    for C in (1.0, 30.0):
        for r in Q._cv_scores(folded, 3, f"lr_c{C:g}", Q._lr_scores(C)).collect():
            fold, label, p = got[r["id"], r["model"]]
            assert (fold, label) == (r["fold"], r["label"]) and abs(p - r["p"]) < 1e-3
