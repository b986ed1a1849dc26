"""Word vectors, document vectors and centroid features.

Word-vector tables are (word, vector ARRAY<DOUBLE>). Lookups are equi-joins on word over words
counted per review; the table is measured and broadcast if small, else frequent words are salted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.operators.centroids import Centroids, fit_centroids, nearest_centroid  # noqa: F401
from revlens.operators.ranking import row_number0
from revlens.operators.sampling import keep_probabilities, thin
from revlens.session import importable, written


def attach_vectors(word_freq: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Pair words with rows of an embedding table: the word of frequency rank r (count desc,
    word asc; 0-based) takes vector vec_id = r. Returns (word, vec_id, vector, label)."""
    ranked = row_number0(word_freq.select("word", F.col("n").cast("long").alias("n")),
                         [F.col("n").desc(), F.col("word")], out="vec_id")
    return ranked.join(embeddings.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
                                         "label"), "vec_id").select("word", "vec_id", "vector", "label")


def train_word2vec(sentences: DataFrame, words_col: str = "words", vector_size: int = 300,
                   min_count: int = 40, window: int = 10, max_iter: int = 10, seed: int = 42,
                   num_partitions: int | None = None, sample: float | None = None, keys: tuple[str, ...] = ()):
    """Skip-gram (MLlib, hierarchical softmax). ``sample`` thins frequent words first, once for all iterations;
    ``keys`` name a sentence for its draws. Every part sends all vectors that it changed in every iteration, so there are
    no more parts than tasks that run side by side."""
    if sample:
        counts = sentences.select(F.explode(words_col).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        sentences = thin(sentences, keep_probabilities(counts, sample, at_least=2 * min_count), list(keys), words_col)
    spark = sentences.sparkSession
    n = num_partitions or min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    w2v = Word2Vec(vectorSize=vector_size, minCount=min_count, windowSize=window, maxIter=max_iter,
                   seed=seed, inputCol=words_col, outputCol="_vec", numPartitions=max(1, n))
    return w2v.fit(sentences)


def model_vectors(model) -> DataFrame:
    """(word, vector ARRAY<DOUBLE>) of a fitted Word2VecModel."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def most_similar(vectors: DataFrame, word: str, topn: int = 10) -> DataFrame:
    """Cosine top-n against one word's vector (the word itself excluded). The query
    vector is one row, fetched once and inlined as a literal."""
    q = vectors.filter(F.col("word") == word).select("vector").first()
    if q is None:
        return vectors.limit(0).select("word", F.lit(0.0).alias("similarity"))
    qv = F.array(*[F.lit(float(x)) for x in q[0]])
    return (vectors.filter(F.col("word") != word)
            .select("word", cosine(F.col("vector"), qv).alias("similarity"))
            .orderBy(F.col("similarity").desc(), F.col("word")).limit(topn))


#: Centroids of the word vectors.
CENTROIDS = 2000
#: A word table is broadcast below this many bytes, measured before the join.
BROADCAST_BYTES = 64 << 20
#: Bytes of a part of a larger table of vectors, words of reviews that meet it in a task, and vectors added up at once.
PART_BYTES, GROUP_ROWS, SUM_ROWS = 32 << 20, 1_000_000, 1 << 15
#: Parts that a word's rows are dealt to where the table is too large to broadcast.
SALTS = 16


def _met(words: DataFrame, table: DataFrame, id_col: str, row_bytes: Column) -> DataFrame:
    """``words`` (id, word, n) with the columns of ``table`` (word, ...), which is measured first: a
    small one is broadcast; else the rows of a word are dealt to SALTS parts, so that no frequent
    word lands in one task. Both ways give the same rows."""
    if (table.agg(F.sum(row_bytes)).first()[0] or 0) <= BROADCAST_BYTES:
        return words.join(F.broadcast(table), "word")
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = words.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int"))
    return own.join(salted, ["word", "_salt"]).drop("_salt")


def _counted(tokens: DataFrame, id_col: str, words_col: str) -> DataFrame:
    """(id, word, n): a review's words once each, summed before anything is joined."""
    return tokens.select(id_col, F.explode(words_col).alias("word")).groupBy(id_col, "word").agg(
        F.count(F.lit(1)).alias("n"))


def _part_sums(words: DataFrame, vectors: DataFrame, dim: int, id_col: str, parts: int) -> DataFrame:
    """(id, total, known): sums of a review's word vectors, one row for each part of the words that it has words of.
    Words are dealt to ``parts`` by their hash and reviews to groups of GROUP_ROWS words, and each pair of them meets in one
    task, so that sums are exchanged and not the vector of every word of every review."""
    salts = max(1, -(-words.count() // (parts * GROUP_ROWS)))
    part = F.pmod(F.xxhash64("word"), F.lit(parts)).cast("int").alias("part")
    left = words.filter(F.col("word").isNotNull() & F.col(id_col).isNotNull()).select(
        part, F.pmod(F.xxhash64(F.lit("salt"), id_col), F.lit(salts)).cast("int").alias("salt"), F.col(id_col).alias("id"), "word", "n")
    right = vectors.filter("word is not null").select(
        part, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "word", F.col("vector").cast("array<double>").alias("vector"))

    def run(own: pa.Table, table: pa.Table) -> pa.Table:
        ids = own.column("id").combine_chunks().dictionary_encode()
        known, total = np.zeros(len(ids.dictionary), np.int64), np.zeros((len(ids.dictionary), dim))
        if len(own) and len(table):
            names = table.column("word").combine_chunks().dictionary_encode()
            code = names.indices.to_numpy(zero_copy_only=False)
            of_word, times = np.zeros((len(names.dictionary), dim)), np.bincount(code, minlength=len(names.dictionary))
            np.add.at(of_word, code, table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
            at = pa.compute.index_in(own.column("word").combine_chunks(), names.dictionary).fill_null(-1).to_numpy(zero_copy_only=False)
            row, n = ids.indices.to_numpy(zero_copy_only=False), own.column("n").to_numpy()
            order = np.argsort(row, kind="stable")
            order = order[at[order] >= 0]
            for k in range(0, len(order), SUM_ROWS):
                some = order[k:k + SUM_ROWS]
                first = np.flatnonzero(np.r_[True, row[some][1:] != row[some][:-1]])
                total[row[some][first]] += np.add.reduceat(of_word[at[some]] * n[some, None], first)
                known[row[some][first]] += np.add.reduceat(times[at[some]] * n[some], first)
        there = known > 0
        sums = pa.ListArray.from_arrays(pa.array(np.arange(there.sum() + 1) * dim, pa.int32()), pa.array(total[there].ravel()))
        return pa.table([ids.dictionary.filter(pa.array(there)), sums, pa.array(known[there])], names=["id", "total", "known"])

    importable(words.sparkSession)
    met = left.groupBy("part", "salt").cogroup(right.groupBy("part", "salt"))
    return met.applyInArrow(run, f"id {words.schema[id_col].dataType.simpleString()}, total array<double>, known long").withColumnRenamed("id", id_col)


def mean_word_vector(tokens: DataFrame, vectors: DataFrame, dim: int, id_col: str = "id",
                     words_col: str = "words") -> DataFrame:
    """Mean of the in-vocabulary word vectors of each review (repeats count); a review
    with no known word gets the zero vector. Element-wise weighted mean via MLlib's Summarizer; a table that is too
    large to broadcast is met in parts, see ``_part_sums``."""
    size = vectors.agg(F.sum(F.octet_length("word") + 8 * dim + 16)).first()[0] or 0
    counted = _counted(tokens, id_col, words_col)
    if size <= BROADCAST_BYTES:
        hits = counted.join(F.broadcast(vectors.select("word", array_to_vector("vector").alias("v"))), "word")
        means = hits.groupBy(id_col).agg(Summarizer.mean(F.col("v"), F.col("n").cast("double")).alias("m"),
                                         F.sum("n").alias("n_known"))
    else:
        sums = _part_sums(written(counted, "review-words"), vectors, dim, id_col, max(1, -(-size // PART_BYTES)))
        means = sums.groupBy(id_col).agg(Summarizer.sum(array_to_vector("total")).alias("t"), F.sum("known").alias("n_known")).select(
            id_col, array_to_vector(F.transform(vector_to_array("t"), lambda x: x / F.col("n_known"))).alias("m"), "n_known")
    zero = F.array_repeat(F.lit(0.0), dim)
    return (tokens.select(id_col).join(means, id_col, "left")
            .select(id_col, F.coalesce(F.col("n_known"), F.lit(0)).cast("long").alias("n_known"),
                    F.when(F.col("m").isNull(), zero).otherwise(vector_to_array("m")).alias("vector")))


def label_centroids(vectors: DataFrame) -> DataFrame:
    """(centroid, center): mean vector per label, numbered in label order; a table of k rows."""
    from pyspark.sql import Window
    means = vectors.groupBy("label").agg(vector_to_array(Summarizer.mean(array_to_vector("vector"))).alias("center"))
    return means.select((F.row_number().over(Window.orderBy("label")) - 1).cast("int").alias("centroid"), "center")


def centroid_histogram(tokens: DataFrame, word_centroid: DataFrame, id_col: str = "id",
                       words_col: str = "words") -> DataFrame:
    """(id, centroid, share) — share of a review's in-vocabulary words per centroid;
    shares of a review sum to 1; a review with no known word has no rows (the zero row)."""
    hits = _met(_counted(tokens, id_col, words_col), word_centroid.select("word", "centroid"), id_col,
                F.octet_length("word") + 16)
    per = hits.groupBy(id_col, "centroid").agg(F.sum("n").alias("c"))
    from pyspark.sql import Window
    tot = F.sum("c").over(Window.partitionBy(id_col))  # rows per review <= number of centroids
    return per.select(id_col, "centroid", (F.col("c") / tot).alias("share"))


def one_center_cost(vectors: DataFrame) -> float:
    """Summed squared distance of all vectors to their mean."""
    r = vectors.agg(Summarizer.variance(array_to_vector("vector")).alias("v"), F.count(F.lit(1)).alias("n")).first()
    return float(sum(r["v"].toArray())) * (r["n"] - 1) if r["n"] else 0.0


def kmeans_centroids(vectors: DataFrame, k: int, n_init: int = 5, max_iter: int = 20, seed: int = 42) -> Centroids:
    """K-means on the word vectors; n_init sets of seeds, the fit with the lowest cost is kept. Fewer
    vectors than ``k`` give as many centroids."""
    return fit_centroids(vectors, max(2, min(k, vectors.count())), n_init, max_iter, seed)
