"""Catalog: word vectors, document vectors and centroids.

Word vectors come from the ``embeddings`` table: the review vocabulary (letters cleaner,
all documents) ranked by count desc, word asc; the word of rank r takes vec_id = r.
Centroids for the exact keys are the per-label means of the whole embeddings table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions import profiles as P
from revlens.operators import corpus as C
from revlens.operators import embed as EM
from revlens.operators.centroids import fit_minibatch
from revlens.operators.sampling import keep_probabilities, thin
from revlens.plans import duck as D
from revlens.plans.q_corpus import _LABELED_SQL, _UNION_SQL, _UNLAB_SQL, _union_corpus
from revlens.plans.registry import query
from revlens.session import scratch_path, written
from revlens.sources import tables
from revlens.sources import vector_store as VS


def word_freq(spark, sf):
    d = tables.documents(spark, sf)
    return (d.select(F.explode(P.profile_tokens("letters", "text")).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def word_vectors(spark, sf):
    return written(EM.attach_vectors(word_freq(spark, sf), tables.embeddings(spark, sf)), "word-vectors")


def dim_of(spark, sf):
    return tables.embeddings(spark, sf).select(F.max(F.size("embedding"))).first()[0]


def centers(spark, sf):
    e = tables.embeddings(spark, sf).select("label", F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    return EM.label_centroids(e)


def labeled_tokens(spark, sf):
    from revlens.operators.features import by_review
    return by_review(tables.labeled(spark, sf), "doc_id").select(F.col("doc_id").alias("id"),
                                            P.profile_tokens("letters", "text").alias("words"))


VEC_CTES = f"""wf AS (SELECT w AS word, count(*) AS n FROM (SELECT unnest({D.profile_tokens('letters', 'text')}) AS w FROM documents) t GROUP BY w),
ranked AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS vec_id FROM wf),
vec AS (SELECT r.word, r.vec_id, e.label, list_transform(e.embedding, lambda x: CAST(x AS DOUBLE)) AS vector
        FROM ranked r JOIN embeddings e ON r.vec_id = e.vec_id),
ltok AS (SELECT d.doc_id AS id, {D.profile_tokens('letters', 'd.text')} AS words FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
edim AS (SELECT e.label, CAST(generate_subscripts(e.embedding, 1) - 1 AS INTEGER) AS dim, CAST(unnest(e.embedding) AS DOUBLE) AS x FROM embeddings e),
cent AS (SELECT label AS centroid, list(m ORDER BY dim) AS c FROM (SELECT label, dim, avg(x) AS m FROM edim GROUP BY label, dim) a GROUP BY label),
dist AS (SELECT v.word, c.centroid,
                list_sum(list_transform(range(1, len(v.vector) + 1), lambda i: (v.vector[i] - c.c[i]) * (v.vector[i] - c.c[i]))) AS d
         FROM vec v CROSS JOIN cent c),
w2c AS (SELECT word, centroid FROM (SELECT word, centroid, row_number() OVER (PARTITION BY word ORDER BY d, centroid) AS rk FROM dist) x WHERE rk = 1)"""


@query("embedding_vocab", "WITH " + VEC_CTES + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM vec) AS vocab_size, word, dim, round(x, 6) AS value FROM (
  SELECT word, CAST(generate_subscripts(vector, 1) - 1 AS BIGINT) AS dim, unnest(vector) AS x FROM vec WHERE vec_id = 0) t
WHERE dim < 20""")
def embedding_vocab_q(spark, sf):
    """Vocabulary size and the first 20 dimensions of the most frequent word's vector."""
    v = word_vectors(spark, sf)
    n = v.count()
    return (v.filter(F.col("vec_id") == 0).select("word", F.posexplode(F.slice("vector", 1, 20)).alias("dim", "x"))
            .select(F.lit(n).cast("long").alias("vocab_size"), "word", F.col("dim").cast("long").alias("dim"),
                    F.round("x", 6).alias("value")))


#: Words looked up in the store: the most frequent ones.
LOOKED_UP = 20


@query("vector_store", "WITH " + VEC_CTES + f"""
SELECT word, dim, round(x, 6) AS value, (SELECT count(*) FROM vec) AS stored FROM (
  SELECT word, CAST(generate_subscripts(vector, 1) - 1 AS BIGINT) AS dim, unnest(vector) AS x FROM vec WHERE vec_id < {LOOKED_UP}) t""")
def vector_store_q(spark, sf):
    """A7, vectors only: every word vector is stored by the hash of its word, and the 20 most frequent words are looked
    up in the files of their buckets; with them the number of words that come back from the whole store."""
    v = word_vectors(spark, sf)
    path = VS.store_vectors(v, scratch_path(spark, "vector-store"))
    words = [r["word"] for r in v.filter(F.col("vec_id") < LOOKED_UP).select("word").collect()]
    stored = VS.load_vectors(spark, path).count()
    return (VS.lookup_vectors(spark, path, words).select("word", F.posexplode("vector").alias("dim", "x"))
            .select("word", F.col("dim").cast("long").alias("dim"), F.round("x", 6).alias("value"), F.lit(stored).cast("long").alias("stored")))


@query("most_similar", "WITH " + VEC_CTES + """,
q AS (SELECT word, vector FROM vec WHERE vec_id = 0)
SELECT v.word, round(list_cosine_similarity(v.vector, q.vector), 6) AS similarity
FROM vec v CROSS JOIN q WHERE v.word <> q.word
ORDER BY list_cosine_similarity(v.vector, q.vector) DESC, v.word LIMIT 10""")
def most_similar_q(spark, sf):
    """Ten nearest words (cosine) to the most frequent word."""
    v = word_vectors(spark, sf)
    top = v.filter(F.col("vec_id") == 0).select("word").first()
    out = EM.most_similar(v, top[0] if top else "", 10)
    return out.select("word", F.round("similarity", 6).alias("similarity"))


@query("mean_word_vector", "WITH " + VEC_CTES + """,
hits AS (SELECT t.id, v.vector FROM (SELECT id, unnest(words) AS word FROM ltok) t JOIN vec v ON t.word = v.word),
nk AS (SELECT id, count(*) AS n_known FROM hits GROUP BY id),
m AS (SELECT id, dim, avg(x) AS value FROM (
        SELECT id, CAST(generate_subscripts(vector, 1) - 1 AS BIGINT) AS dim, unnest(vector) AS x FROM hits) a GROUP BY id, dim),
grid AS (SELECT id, CAST(unnest(range(0, (SELECT max(len(embedding)) FROM embeddings))) AS BIGINT) AS dim FROM ltok)
SELECT g.id AS doc_id, CAST(coalesce(nk.n_known, 0) AS BIGINT) AS n_known, g.dim, round(coalesce(m.value, 0.0), 6) AS value
FROM grid g LEFT JOIN nk ON g.id = nk.id LEFT JOIN m ON g.id = m.id AND g.dim = m.dim""")
def mean_word_vector_q(spark, sf):
    """Mean of in-vocabulary word vectors per labeled review, zero vector if none."""
    mv = EM.mean_word_vector(labeled_tokens(spark, sf), word_vectors(spark, sf), dim_of(spark, sf))
    return (mv.select(F.col("id").alias("doc_id"), "n_known", F.posexplode("vector").alias("dim", "x"))
            .select("doc_id", "n_known", F.col("dim").cast("long").alias("dim"), F.round("x", 6).alias("value")))


def word_centroid(spark, sf):
    return EM.nearest_centroid(word_vectors(spark, sf), centers(spark, sf)).select("word", "centroid")


@query("word_to_centroid", "WITH " + VEC_CTES + "\nSELECT word, CAST(centroid AS INTEGER) AS centroid FROM w2c")
def word_to_centroid_q(spark, sf):
    """Nearest centroid of every vocabulary word, computed once."""
    return word_centroid(spark, sf)


@query("centroid_histogram", "WITH " + VEC_CTES + """,
hits AS (SELECT t.id, w.centroid FROM (SELECT id, unnest(words) AS word FROM ltok) t JOIN w2c w ON t.word = w.word),
per AS (SELECT id, centroid, count(*) AS c FROM hits GROUP BY id, centroid)
SELECT id AS doc_id, CAST(centroid AS INTEGER) AS centroid, round(c / sum(c) OVER (PARTITION BY id), 6) AS share FROM per""")
def centroid_histogram_q(spark, sf):
    """Share of each labeled review's known words per centroid."""
    h = EM.centroid_histogram(labeled_tokens(spark, sf), word_centroid(spark, sf))
    return h.select(F.col("id").alias("doc_id"), "centroid", F.round("share", 6).alias("share"))


def trained_model(spark, sf, vector_size=300):
    return EM.train_word2vec(_union_corpus(spark, sf), vector_size=vector_size, min_count=40, window=10, max_iter=10, sample=1e-3,
                             keys=("corpus", "review_id", "sent_no"))


_KEEP = "(sqrt(0.001 / (n / (SELECT sum(n) FROM wc))) + 0.001 / (n / (SELECT sum(n) FROM wc)))"


@query("subsampled_corpus", f"""
WITH src AS (SELECT 'labeled' AS corpus, review_id, {D.sentences('text', 'split_first')} AS s FROM ({_LABELED_SQL}) a
  UNION ALL SELECT 'unlabeled', review_id, {D.sentences('text', 'split_first')} FROM ({_UNLAB_SQL}) b),
sn AS (SELECT corpus, review_id, generate_subscripts(s, 1) - 1 AS sent_no, unnest(s) AS words FROM src),
tk AS (SELECT corpus, review_id, sent_no, generate_subscripts(words, 1) - 1 AS pos, unnest(words) AS word FROM sn),
wc AS (SELECT word, count(*) AS n FROM tk GROUP BY word),
kp AS (SELECT word, n, CASE WHEN {_KEEP} >= 1 THEN 1.0 ELSE {_KEEP} END AS p FROM wc)
SELECT tk.word, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE
  CAST(('0x' || substr(md5(concat_ws('|', corpus, coalesce(review_id, ''), sent_no, pos, tk.word)), 1, 8)) AS BIGINT) / 4294967296.0 < p) AS BIGINT) AS kept
FROM tk JOIN kp ON tk.word = kp.word GROUP BY tk.word""")
def subsampled_corpus_q(spark, sf):
    """Every word of the corpus with its places and those that stay for skip-gram at sample 0.001."""
    corpus = _union_corpus(spark, sf)
    counts = written(C.word_frequency(corpus), "word-counts")
    kept = C.word_frequency(thin(corpus, keep_probabilities(counts), ["corpus", "review_id", "sent_no"])).withColumnRenamed("n", "kept")
    return counts.join(kept, "word", "left").select("word", "n", F.coalesce("kept", F.lit(0)).cast("long").alias("kept"))


@query("word2vec_train", _UNION_SQL + """
SELECT word, CAST(300 AS BIGINT) AS dims, TRUE AS finite FROM (SELECT unnest(words) AS word FROM corpus) t
GROUP BY word HAVING count(*) >= 40""")
def word2vec_train_q(spark, sf):
    """Skip-gram on the labeled + unlabeled sentence corpus (dim 300, min_count 40, window 10, 10
    iterations): the words that get a vector, its size, and whether its numbers are finite."""
    v = EM.model_vectors(trained_model(spark, sf))
    finite = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6))
    return v.select("word", F.size("vector").cast("long").alias("dims"), finite.alias("finite"))


@query("kmeans_centroids")
def kmeans_centroids_q(spark, sf, k=EM.CENTROIDS):
    """K-means (2,000 centroids, 5 seeds, 20 iterations) on the word vectors: every word's centroid and squared
    distance, whether none of a few other centres is nearer, and whether the k centres cost less than one."""
    v = word_vectors(spark, sf)
    model = EM.kmeans_centroids(v, k, n_init=5, max_iter=20)
    cheaper = model.cost < EM.one_center_cost(v)
    return _challenged(model, v).select("word", "centroid", F.round("distance", 6).alias("distance"), "nearest",
                                        F.lit(bool(cheaper)).alias("cheaper_than_one"))


#: Other centres that each word's centre is compared with by a plain sum, chosen by a hash.
CHALLENGES = 8


def _challenged(model, v):
    """The words' centres, and whether CHALLENGES others are at least as far: a join per (word, other centre), in
    which nothing of the search is used."""
    own = written(model.assign(v.select("word", "vector")), "assigned")
    k, table = model.getK(), model.table(v.sparkSession)
    other = F.explode(F.transform(F.sequence(F.lit(0), F.lit(CHALLENGES - 1)), lambda i: F.pmod(F.xxhash64("word", i), F.lit(k)).cast("int")))
    far = F.aggregate(F.zip_with("vector", "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    met = own.select("word", "vector", other.alias("other")).join(table.withColumnRenamed("centroid", "other"), "other")
    least = met.groupBy("word").agg(F.min(far).alias("least"))
    return own.join(least, "word").withColumn("nearest", F.col("distance") <= F.col("least") + 1e-9)


#: Vectors for each centroid in the checks below, at least.
CHECK_SHARE = 5


def _check_rows(v, model):
    """One row of facts about a fit, each computed a second way from the written assignment."""
    own = written(_challenged(model, v), "challenged")
    far = F.aggregate(F.zip_with("vector", "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    plain = own.join(model.table(v.sparkSession), "centroid")
    r = plain.agg(F.sum(far).alias("cost"), F.count_if(~F.col("nearest")).alias("wrong"), F.count(F.lit(1)).alias("n"),
                  F.countDistinct("centroid").alias("used")).first()
    facts = own.sparkSession.range(1)
    return facts.select(
        F.lit(r["n"]).cast("long").alias("n_words"), F.lit(model.getK()).cast("long").alias("n_centroids"),
        F.lit(r["wrong"] == 0).alias("none_nearer"), F.lit(abs(r["cost"] - model.cost) <= 1e-6 * max(1.0, model.cost)).alias("cost_agrees"),
        F.lit(model.cost < model.seed_cost).alias("below_seeds"), F.lit(r["used"] >= 0.5 * model.getK()).alias("most_used"),
        F.lit(model.cost < 0.8 * EM.one_center_cost(v)).alias("below_one"))


_CHECK_SQL = "WITH " + VEC_CTES + f"""
SELECT count(*) AS n_words, least({EM.CENTROIDS}, count(*) // {CHECK_SHARE}) AS n_centroids, TRUE AS none_nearer, TRUE AS cost_agrees,
       TRUE AS below_seeds, TRUE AS most_used, TRUE AS below_one FROM vec"""


@query("kmeans_centroids_check", _CHECK_SQL)
def kmeans_centroids_check_q(spark, sf):
    """D18 with a fifth as many centroids as vectors (at most 2,000): number of words and centroids, and whether
    no challenged centre is nearer, the cost agrees with a plain sum, is below that of the seeds and well below that
    of one centre, and most centroids are used."""
    v = word_vectors(spark, sf)
    return _check_rows(v, EM.kmeans_centroids(v, min(EM.CENTROIDS, v.count() // CHECK_SHARE)))


#: Centroids of the mini-batch form, and the words of a step.
BATCH_CENTROIDS, BATCH_WORDS = 5000, 100_000


def _minibatch(v, k=BATCH_CENTROIDS, starts=10):
    n = v.count()
    return fit_minibatch(v, max(2, min(k, n // CHECK_SHARE)), starts, max(4, -(-n // BATCH_WORDS)))


@query("minibatch_centroids")
def minibatch_centroids_q(spark, sf, k=BATCH_CENTROIDS):
    """D18, mini-batch form (5,000 centroids, but at least five vectors for each; 10 sets of seeds): every word's
    centroid and squared distance."""
    v = word_vectors(spark, sf)
    return _minibatch(v, k).assign(v.select("word", "vector")).select("word", "centroid", F.round("distance", 6).alias("distance"))


@query("minibatch_centroids_check", _CHECK_SQL.replace(f"least({EM.CENTROIDS},", f"least({BATCH_CENTROIDS},"))
def minibatch_centroids_check_q(spark, sf):
    """The facts of kmeans_centroids_check about the mini-batch form."""
    v = word_vectors(spark, sf)
    return _check_rows(v, _minibatch(v))
