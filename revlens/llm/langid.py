"""Language identification: interpolated Kneser-Ney character models in sorted hash arrays.

A text is read as letters (lower case) with one boundary sign for any run of other characters.
Per language the counts of all character ``ORDER``-grams are gathered from every training row by a
distributed aggregation (each task sums its own rows first, so a language that holds most rows is
spread over all tasks). Lower orders use continuation counts. Every n-gram counts and is kept:
continuation counts, discounts and probabilities are aggregates and joins of tables, and only the
discounts (a number per language and order) reach the driver.

A log-probability is a sum over the orders: the back-off weight of the context, and what a seen n-gram
adds to it and to the order below (nothing where it was not seen). So the written table of these
summands can be cut anywhere: tasks read it in blocks of at most ``BLOCK_BYTES`` as sorted 64-bit
hashes with a value per language, and add up what each block holds. A model that outgrows a block
costs more passes over a slice of texts, never a larger block.

A text gets per language the cross-entropy per character; the lowest is chosen.
``score`` is a softmax over the negative cross-entropies, whose sharpness is fitted on all training rows; on
the same rows each language gets the cross-entropy that 99.5 % of its own texts do not exceed, and a text
beyond its language's limit is not ``accepted`` (rejection). Tasks score the rows and give sums of losses;
the rows of a language are ranked in ranges. ``fit_languages`` calibrates on fewer ids only if asked to.

Defined cases: null text, text without a letter, or no training rows: ``und``, score 0, not
accepted. Rows with a null language are not learned from; ties go to the first language in
alphabetical order; repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import code_points, extended, numbered, shared_uri, slices, table, texts
from revlens.session import written

ORDER = 4
#: Values that the sharpness is chosen of, and the share of a language's texts below its limit.
SHARPNESS, WITHIN = tuple(2.0 ** e for e in range(-2, 8)), 0.995
#: Bytes of a block of the model table as a task holds it.
BLOCK_BYTES = 64 << 20
#: Distinct n-grams that a task holds before it passes its sums on.
HELD = 1 << 20


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """16-bit sign of each code point: the lower-case letter, 0 for what is no letter. Letters from U+D800 up
    share 10,240 signs, which may make two of them one to the models but never no letter."""
    out = np.zeros(0x110000, np.uint64)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = ord(s.lower()[0])
            out[c] = low if low < 0xD800 else 0xD800 + low % 0x2800
    return out


def grams(many: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(text number, packed n-gram) of every position: a letter or the boundary after a word."""
    flat, starts = code_points(many)  # the line break after each text is its last boundary
    sign = _symbols()[flat]
    keep = np.ones(len(sign), bool)
    keep[1:] = (sign[1:] != 0) | (sign[:-1] != 0)
    keep[starts[:-1]] &= sign[starts[:-1]] != 0  # a text begins after a boundary anyway
    text = np.repeat(np.arange(len(many)), np.diff(starts))[keep]
    sign = sign[keep]
    key = sign.copy()
    for k in range(1, order):
        before = np.zeros_like(sign)
        before[k:] = np.where(text[k:] == text[:-k], sign[:-k], np.uint64(0))
        key |= before << np.uint64(16 * k)
    return text, key


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class HashArray:
    """Sorted hashes of n-grams with a row of values each; an index on the leading bits of the
    hash leaves a few neighbours to compare."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = _mix(keys)
        by = np.argsort(hashes)
        self.hashes, self.values = hashes[by], values[by].astype(np.float32)
        self.bits = max(1, int(len(keys)).bit_length() + 1)
        self.first = np.searchsorted(self.hashes >> np.uint64(64 - self.bits),
                                     np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it has none."""
        h = _mix(keys)
        top = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.first[top], self.first[top + 1]
        out = np.full(len(keys), -1, np.int64)
        left = np.flatnonzero(at < end)
        at = at[left]
        while len(left):
            hit = self.hashes[at] == h[left]
            out[left[hit]] = at[hit]
            at = at + 1
            more = ~hit & (at < end[left])
            left, at = left[more], at[more]
        return out


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


class Models:
    """The models of all languages from their n-gram counts in memory: {language: (packed n-grams, counts)}.
    The plain form of TableModels."""

    #: Text bytes that are scored together.
    slice_bytes = 1 << 18

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER):
        self.order, self.langs = order, sorted(counts)
        self.sharpness, self.limit = 1.0, np.full(len(self.langs), np.inf)
        n_langs = len(self.langs)
        own = {}
        for lang in self.langs:
            keys, n = counts[lang]
            by = np.argsort(keys)
            own[lang] = {order: (keys[by], n[by].astype(np.float64))}
            for k in range(order - 1, 0, -1):  # continuation counts: distinct longer n-grams with that end
                suffix, n = np.unique(own[lang][k + 1][0] & self._mask(k), return_counts=True)
                own[lang][k] = suffix, n.astype(np.float64)
        letters = np.unique(np.concatenate([own[x][1][0] for x in self.langs])) if n_langs else np.empty(0, np.uint64)
        self.unseen = -np.log(len(letters) + 1.0)
        below_keys, below = None, None
        self.grams, self.contexts = {}, {}
        for k in range(1, order + 1):
            keys = np.unique(np.concatenate([own[x][k][0] for x in self.langs])) if n_langs else letters
            contexts = np.unique(keys >> np.uint64(16))
            prob, back = np.empty((len(keys), n_langs)), np.ones((len(contexts), n_langs))
            lower = (np.full((len(keys), n_langs), np.exp(self.unseen)) if k == 1
                     else below[np.searchsorted(below_keys, keys & self._mask(k - 1))])
            for j, lang in enumerate(self.langs):
                mine, n = own[lang][k]
                d = (n == 1).sum() / max(1.0, (n == 1).sum() + 2.0 * (n == 2).sum())
                d = min(max(d, 0.1), 0.9)
                ctx, inverse, kinds = np.unique(mine >> np.uint64(16), return_inverse=True, return_counts=True)
                total = np.bincount(inverse, n, len(ctx))
                at, has = _lookup(ctx, contexts)
                back[has, j] = d * kinds[at[has]] / total[at[has]]
                at, has = _lookup(mine, keys)
                c = np.where(has, n[at], 0.0)
                place = np.searchsorted(contexts, keys >> np.uint64(16))
                at, has = _lookup(ctx, keys >> np.uint64(16))
                share = np.where(has, np.maximum(c - d, 0.0) / total[at], 0.0)
                prob[:, j] = share + back[place, j] * lower[:, j]
            self.grams[k] = HashArray(keys, np.log(prob))
            self.contexts[k] = HashArray(contexts, np.log(back))
            below_keys, below = keys, prob

    @staticmethod
    def _mask(k: int) -> np.uint64:
        return np.uint64((1 << 16 * k) - 1)

    def log_probs(self, keys: np.ndarray, k: int | None = None) -> np.ndarray:
        """Per n-gram and language the log-probability of its last sign after the others."""
        k = self.order if k is None else k
        if k == 0:
            return np.full((len(keys), len(self.langs)), self.unseen, np.float32)
        at = self.grams[k].find(keys)
        out = self.grams[k].values[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            rest, back = np.unique(keys[miss], return_inverse=True)
            lower = self.log_probs(rest & self._mask(k - 1), k - 1)
            ctx = self.contexts[k].find(rest >> np.uint64(16))
            lower += np.where(ctx[:, None] >= 0, self.contexts[k].values[ctx], np.float32(0))
            out[miss] = lower[back]
        return out

    def entropies(self, many: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character of each text and language, whether the text has a letter)."""
        text, key = grams(many, self.order)
        logs = self.log_probs(key)
        n = np.bincount(text, minlength=len(many))
        sums = np.stack([np.bincount(text, logs[:, j], len(many)) for j in range(len(self.langs))], 1)
        lettered = np.bincount(text, (key & np.uint64(0xFFFF)) != 0, len(many)) > 0
        return -sums / np.maximum(n, 1)[:, None], lettered

    def fitted(self, h: np.ndarray, langs: list[str]) -> tuple[float, np.ndarray]:
        """Sharpness of the score and limit of each language, from the cross-entropies of labelled texts."""
        limit = np.full(len(self.langs), np.inf)
        if not len(h):
            return 1.0, limit
        truth = np.array([self.langs.index(x) for x in langs])

        def loss(s: float) -> float:
            p = np.exp(-s * (h - h.min(1, keepdims=True)))
            p = p[np.arange(len(h)), truth] / p.sum(1)
            return float(-np.log(np.maximum(p, 1e-12)).mean())

        for j in range(len(self.langs)):
            if (truth == j).any():
                limit[j] = np.quantile(h[truth == j, j], 0.995)
        return min((2.0 ** e for e in range(-2, 8)), key=loss), limit

    def predict(self, many: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, cross-entropy, accepted) of each text."""
        if not self.langs:
            none = np.zeros(len(many))
            return ["und"] * len(many), none, none, none.astype(bool)
        h, lettered = self.entropies(many)
        best = h.argmin(1)
        low = h[np.arange(len(h)), best]
        p = 1 / np.exp(-self.sharpness * (h - low[:, None])).sum(1)
        langs = [self.langs[j] if ok else "und" for j, ok in zip(best, lettered, strict=True)]
        return langs, np.where(lettered, p, 0.0), np.where(lettered, low, 0.0), lettered & (low <= self.limit[best])


@lru_cache(maxsize=1)
def _block(folder: str, names: tuple[str, ...], n_langs: int) -> dict[int, HashArray]:
    """The summands in some files of a model table, by kind."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    parts = []
    for n in names:
        with store.open_input_file(f"{base}/{n}") as file:
            parts.append(pq.ParquetFile(file, pre_buffer=False).read(use_threads=False))
    got = pa.concat_tables(parts).combine_chunks()
    kind, gram = got.column("kind").to_numpy(), got.column("gram").to_numpy().view(np.uint64)
    at = pa.compute.list_flatten(got.column("langs")).to_numpy()
    row = pa.compute.list_parent_indices(got.column("langs")).to_numpy()
    values = np.zeros((len(kind), n_langs), np.float32)
    values[row, at] = pa.compute.list_flatten(got.column("adds")).to_numpy()
    return {k: HashArray(gram[kind == k], values[kind == k]) for k in np.unique(kind).tolist()}


class TableModels(Models):
    """The models in a written table of summands: (kind, gram, langs, adds), where kind k holds what
    n-grams of k signs add and -k the back-off weights of their contexts."""

    def __init__(self, langs: list[str], order: int, unseen: float, folder: str = "", blocks: tuple = ()):
        self.langs, self.order, self.unseen, self.folder, self.blocks = langs, order, unseen, folder, blocks
        self.sharpness, self.limit = 1.0, np.full(len(langs), np.inf)
        if len(blocks) > 1:  # fewer passes over the blocks
            self.slice_bytes = 8 << 20

    def log_probs(self, keys: np.ndarray) -> np.ndarray:
        some, back = np.unique(keys, return_inverse=True)
        out = np.full((len(some), len(self.langs)), self.unseen)
        for names in self.blocks:
            for kind, held in _block(self.folder, names, len(self.langs)).items():
                own = some & self._mask(abs(kind))
                at = held.find(own if kind > 0 else own >> np.uint64(16))
                hit = np.flatnonzero(at >= 0)
                out[hit] += held.values[at[hit]]
        return out.astype(np.float32)[back]


def _blocks(folder: str, rows: int) -> tuple[tuple[str, ...], ...]:
    """The files of a table in groups of at most ``rows`` rows."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    out, held = [[]], 0
    for info in sorted(store.get_file_info(fs.FileSelector(base)), key=lambda x: x.path):
        if not info.path.endswith(".parquet"):
            continue
        n = pq.read_metadata(info.path, filesystem=store).num_rows
        if held and held + n > rows:
            out, held = [*out, []], 0
        if n:
            out[-1].append(info.base_name)
            held += n
    return tuple(tuple(x) for x in out if x)


def _summands(counted: DataFrame, order: int) -> TableModels:
    """The models of (lang, gram, n)."""
    spark = counted.sparkSession
    counts = {order: written(counted, "grams")}
    for k in range(order - 1, 0, -1):  # continuation counts: distinct longer n-grams with that end
        end = F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("gram")
        counts[k] = written(counts[k + 1].groupBy("lang", end).agg(F.count(F.lit(1)).alias("n")), "grams")
    few = None
    for k, own in counts.items():
        one = own.select(F.lit(k).alias("k"), "lang", "n")
        few = one if few is None else few.union(one)
    few = few.groupBy("k", "lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
    facts = [(r.k, r.lang, min(max(r.n1 / max(1.0, r.n1 + 2.0 * r.n2), 0.1), 0.9)) for r in few.collect()]
    langs = sorted({lang for _, lang, _ in facts})
    unseen = float(-np.log(counts[1].select("gram").distinct().count() + 1.0))
    if not langs:
        return TableModels(langs, order, unseen)
    place = {x: j for j, x in enumerate(langs)}
    parts, below = [], None
    for k in range(1, order + 1):
        fact = spark.createDataFrame([(x, place[x], d) for j, x, d in facts if j == k], "lang string, at int, d double")
        context = F.shiftrightunsigned("gram", 16).alias("context")
        weights = written(
            counts[k].groupBy("lang", context).agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total"))
            .join(F.broadcast(fact), "lang")
            .select("lang", "context", "at", "d", "total", (F.col("d") * F.col("kinds") / F.col("total")).alias("back")), "contexts")
        own = counts[k].select("lang", "gram", "n", context).join(weights, ["lang", "context"])
        if below is None:
            own = own.withColumn("lower", F.lit(float(np.exp(unseen))))
        else:
            end = F.col("gram").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1))
            own = own.withColumn("end", end).join(
                below.select("lang", F.col("gram").alias("end"), F.col("p").alias("lower")), ["lang", "end"])
        share, low = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total"), F.col("back") * F.col("lower")
        below = written(own.select("lang", "gram", "at", (share + low).alias("p"), F.log1p(share / low).alias("add")), "probabilities")
        parts += [below.select(F.lit(k).alias("kind"), "gram", "at", "add"),
                  weights.select(F.lit(-k).alias("kind"), F.col("context").alias("gram"), "at", F.log("back").alias("add"))]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    rows = max(1, BLOCK_BYTES // (8 + 4 * len(langs)))
    folder = shared_uri(spark, "language-models")
    every = every.groupBy("kind", "gram").agg(F.collect_list(F.struct("at", "add")).alias("own"))
    every.select("kind", "gram", F.col("own.at").alias("langs"), F.col("own.add").cast("array<float>").alias("adds")) \
        .write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(folder)
    return TableModels(langs, order, unseen, folder, _blocks(folder, rows))


def gram_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out():
            for lang, (keys, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)],
                                                 ["lang", "gram", "n"])
            held.clear()

        for part in slices(batches, limit=1 << 20):
            langs = np.array(part.column("lang").to_pylist(), object)
            many = np.array(texts(part), object)
            for lang in set(langs.tolist()):
                keys, n = np.unique(grams(many[langs == lang].tolist(), order)[1], return_counts=True)
                if lang in held:
                    both = np.concatenate([held[lang][0], keys])
                    counts = np.concatenate([held[lang][1], n])
                    keys, back = np.unique(both, return_inverse=True)
                    n = np.bincount(back, counts).astype(np.int64)
                held[lang] = keys, n
            if sum(len(k) for k, _ in held.values()) > HELD:
                yield from out()
        yield from out()

    return (rows.select("lang", "text").mapInArrow(count, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def fit_languages(rows: DataFrame, order: int = ORDER, sample: int | None = None) -> TableModels:
    """Models of the languages of (doc_id, lang, text); rows with a null language or text do not count. They are
    calibrated on all rows, or on ``sample`` ids of each language."""
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    models = _summands(gram_counts(rows, order), order)
    if models.langs:
        models.sharpness, models.limit = _calibrated(rows if sample is None else _sample(rows, sample), models)
    return models


def _sample(rows: DataFrame, sample: int) -> DataFrame:
    """(lang, text) of at most ``sample`` ids of each language, the first by a hash; one row of each id.
    The languages' sizes give a limit of the hash first, so that few more rows than wanted leave the tasks."""
    from pyspark.sql import Window

    ids = rows.filter(F.col("doc_id").isNotNull()).groupBy("lang", "doc_id").agg(F.min(F.xxhash64("text")).alias("own"))
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))  # a row for each language
    sure = sample + 8 * sample ** 0.5 + 8
    ids = ids.withColumn("place", F.xxhash64("doc_id")).join(F.broadcast(sizes), "lang").filter(
        F.pmod("place", F.lit(1 << 20)) < F.ceil(F.lit(sure * (1 << 20)) / F.col("n")))
    first = Window.partitionBy("lang").orderBy(F.pmod("place", F.lit(1 << 20)), "place", "doc_id")
    ids = ids.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= sample).select("lang", "doc_id", "own")
    met = rows.select("lang", "doc_id", "text", F.xxhash64("text").alias("own")).join(F.broadcast(ids), ["lang", "doc_id", "own"])
    return met.dropDuplicates(["lang", "doc_id"]).select("lang", "text")


def _calibrated(rows: DataFrame, models: Models) -> tuple[float, np.ndarray]:
    """Sharpness of the score and limit of each language, from all of (lang, text): tasks score the rows, and only sums
    of losses and two ranked values of each language reach the driver."""
    held = rows.sparkSession.sparkContext.broadcast(models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = held.value.langs
        for part in slices(batches, limit=held.value.slice_bytes):
            h, lettered = held.value.entropies(texts(part))
            at = np.flatnonzero(lettered)
            h, own = h[at], part.column("lang").take(pa.array(at))
            row, truth = np.arange(len(at)), np.array([langs.index(x) for x in own.to_pylist()], int)
            loss = np.empty((len(at), len(SHARPNESS)))
            for k, s in enumerate(SHARPNESS):
                p = np.exp(-s * (h - h.min(1, keepdims=True)))
                loss[:, k] = -np.log(np.maximum(p[row, truth] / p.sum(1), 1e-12))
            yield pa.RecordBatch.from_arrays([own, pa.array(h[row, truth]), pa.array(loss.tolist(), pa.list_(pa.float64()))], ["lang", "own", "loss"])

    scored = written(rows.select("lang", "text").mapInArrow(score, "lang string, own double, loss array<double>"), "calibration")
    limit = np.full(len(models.langs), np.inf)
    sums = scored.agg(F.count(F.lit(1)), *(F.sum(F.col("loss")[k]) for k in range(len(SHARPNESS)))).first()
    if not sums[0]:
        return 1.0, limit
    sizes = {r["lang"]: r["n"] for r in scored.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    places = {x: (n - 1) * WITHIN for x, n in sizes.items()}
    wanted = rows.sparkSession.createDataFrame(sorted({(x, int(f(q))) for x, q in places.items() for f in (np.floor, np.ceil)}), "lang string, rank bigint")
    ranked = numbered(scored.select("lang", "own"), "lang", ["own"], "ranked-entropies")
    values = {(r["lang"], r["rank"]): r["own"] for r in ranked.join(F.broadcast(wanted), ["lang", "rank"]).collect()}  # two of each language
    for x, q in places.items():
        low, high = values[x, int(np.floor(q))], values[x, int(np.ceil(q))]
        limit[models.langs.index(x)] = low + (high - low) * (q - np.floor(q))
    return SHARPNESS[int(np.argmin([sums[k + 1] for k in range(len(SHARPNESS))]))], limit


def identify(df: DataFrame, models: Models) -> DataFrame:
    """``df`` (with a text column and any others; columns of these names are replaced) plus lang_pred,
    score, entropy and accepted."""
    df = df.drop("lang_pred", "score", "entropy", "accepted")
    held = df.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=held.value.slice_bytes):
            langs, score, low, accepted = held.value.predict(texts(part))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(langs, pa.string()), pa.array(score), pa.array(low), pa.array(accepted)],
                [*part.schema.names, "lang_pred", "score", "entropy", "accepted"])

    return df.mapInArrow(run, extended(df, "lang_pred string, score double, entropy double, accepted boolean"))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by models of the rows that are not held out."""
    rows = table(spark, sf_dir, "documents")
    models = fit_languages(rows.filter(~held_out()).select("doc_id", "lang", "text"))
    return identify(rows.select("doc_id", "text"), models).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "entropy", "accepted")
