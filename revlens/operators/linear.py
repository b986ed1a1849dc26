"""Many linear models in one pass.

A model minimises  1/2 |w|^2 + C * sum_i s_i loss(y_i, w . x_i + b)  over the rows it uses: all rows of its feature
table, less those of the fold that it leaves out, s_i being a weight of the row's class. Losses: ``logistic``, whose
intercept is free, and ``squared_hinge``, whose intercept is one more coefficient of a constant feature.

Rows of all feature tables are packed into blocks of arrays and written. One pass over the blocks serves every model:
tasks multiply a block by the coefficients of the models that use it, add up losses and gradients, and the
sums meet by a range of the coefficients, so that 18 fits of a grid take the passes of the longest one. While models
are fitted the blocks' arrays also lie as they are in files of the shared folder, which tasks read themselves: a pass
neither unpacks a table nor hands it from the JVM to the workers. Where the folder isn't within reach of pyarrow, passes
read the written table. Optimisers
run on the driver as generators that ask for what they need: L-BFGS for a loss and gradient, Newton's method for
products of the Hessian with a vector, which are sums over the rows inside the margin (conjugate gradients).

Driver and tasks hold coefficients (models x features), bounded by the vocabularies' sizes, and nothing that grows
with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import discard, file_folder, importable, written

#: Rows of a block, ranges of coefficients in which sums meet, and sums of all tasks for each range where blocks lie in files.
BLOCK_ROWS, RANGES, MET = 512, 16, 1 << 22
MEMORY = 10


@dataclass(frozen=True)
class Spec:
    """One model: its name, C, the feature table it reads, the fold it leaves out (-1: none), and class weights."""
    name: str
    C: float
    table: int = 0
    fold: int = -1
    pos: float = 1.0
    neg: float = 1.0
    loss: str = "logistic"


@dataclass
class Linear:
    spec: Spec
    w: np.ndarray
    b: float
    slope: float
    gap: float
    passes: int


def _packed(feat: DataFrame, docs: DataFrame, table: int, block_rows: int) -> DataFrame:
    importable(feat.sparkSession)
    per = feat.groupBy("id").agg(F.collect_list(F.struct(F.col("idx").cast("int").alias("i"), F.col("value").cast("double").alias("v"))).alias("e"))
    label = F.col("label").cast("double") if "label" in docs.columns else F.lit(None).cast("double")
    fold = F.col("fold").cast("int") if "fold" in docs.columns else F.lit(-1)
    rows = docs.select("id", label.alias("label"), fold.alias("fold")).join(per, "id", "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), block_rows):
                b = batch.slice(start, block_rows)
                n, e = len(b), b.column("e")
                size = pa.compute.list_value_length(e).fill_null(0).to_numpy(zero_copy_only=False)
                flat = pa.compute.list_flatten(e)
                arrays = [b.column("label").to_numpy(zero_copy_only=False).astype(np.float64),
                          b.column("fold").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32),
                          pa.compute.struct_field(flat, "i").to_numpy(zero_copy_only=False).astype(np.int32),
                          np.repeat(np.arange(n, dtype=np.int32), size),
                          pa.compute.struct_field(flat, "v").to_numpy(zero_copy_only=False).astype(np.float64)]
                ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), b.column("id"))
                yield pa.RecordBatch.from_arrays([pa.array([table], pa.int32()), ids, *(pa.array([x.tobytes()], pa.binary()) for x in arrays)],
                                                 ["feats", "ids", "label", "fold", "col", "row", "value"])

    return rows.mapInArrow(pack, _blocks_of(docs.schema["id"].dataType.simpleString()))


def packed(tables: list[tuple[DataFrame, DataFrame]], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of several feature tables: pairs of (id, idx, value) and docs (id, label, fold), written."""
    out = None
    for k, (feat, docs) in enumerate(tables):
        one = _packed(feat, docs, k, block_rows)
        out = one if out is None else out.unionByName(one)
    return written(out, "linear")


def packed_vectors(tables: list[DataFrame], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of several tables (id, features and, if there, label and fold) whose features are vectors, written."""
    return written(vector_blocks(tables, block_rows), "linear")


def vector_blocks(tables: list[DataFrame], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The blocks of ``packed_vectors`` for one reading, as that of ``fit_many`` or ``score_many``."""
    out = None
    for k, df in enumerate(tables):
        importable(df.sparkSession)
        label = F.col("label").cast("double") if "label" in df.columns else F.lit(None).cast("double")
        fold = F.col("fold").cast("int") if "fold" in df.columns else F.lit(-1)
        one = df.select("id", label.alias("label"), fold.alias("fold"), "features").mapInArrow(
            _pack_vectors(k, block_rows), _blocks_of(df.schema["id"].dataType.simpleString()))
        out = one if out is None else out.unionByName(one)
    return out


def _blocks_of(kind: str) -> str:
    return f"feats int, ids array<{kind}>, label binary, fold binary, col binary, row binary, value binary"


def _pack_vectors(table: int, block_rows: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), block_rows):
                b = batch.slice(start, block_rows)
                col, row, value = [], [], []
                for k, x in enumerate(b.column("features")):
                    v = x["values"].values.to_numpy(zero_copy_only=False) if x["values"].is_valid else np.empty(0)
                    value.append(v)
                    col.append(np.arange(len(v)) if x["type"].as_py() else x["indices"].values.to_numpy(zero_copy_only=False))
                    row.append(np.full(len(v), k))
                arrays = [b.column("label").to_numpy(zero_copy_only=False).astype(np.float64),
                          b.column("fold").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32),
                          np.concatenate(col).astype(np.int32), np.concatenate(row).astype(np.int32), np.concatenate(value).astype(np.float64)]
                ids = pa.ListArray.from_arrays(pa.array([0, len(b)], pa.int32()), b.column("id"))
                yield pa.RecordBatch.from_arrays([pa.array([table], pa.int32()), ids, *(pa.array([x.tobytes()], pa.binary()) for x in arrays)],
                                                 ["feats", "ids", "label", "fold", "col", "row", "value"])

    return pack


class _Block:
    def __init__(self, batch: pa.RecordBatch, k: int):
        get = lambda name, kind: np.frombuffer(batch.column(name)[k].as_buffer(), kind)
        self._hold(batch.column("feats")[k].as_py(), get("label", np.float64), get("fold", np.int32), get("col", np.int32),
                   np.bincount(get("row", np.int32), minlength=batch.column("label")[k].as_buffer().size // 8), get("value", np.float64))

    def _hold(self, table: int, label: np.ndarray, fold: np.ndarray, col: np.ndarray, size: np.ndarray, value: np.ndarray) -> None:
        self.table, self.label, self.fold, self.size, self.value = table, label, fold, size, value
        self.n = len(label)
        self.at = col.astype(np.intp)
        self.full = np.flatnonzero(size)  # rows ascend in a block
        self.start = (np.cumsum(size) - size)[self.full]

    def plain(self) -> bytes:
        """What ``read`` takes of a block of ``n`` rows and ``len(value)`` entries."""
        return b"".join(x.astype(kind).tobytes() for x, kind in (
            (self.value, np.float64), (self.label, np.float64), (self.size, np.int64), (self.fold, np.int32), (self.at, np.int32)))

    @classmethod
    def read(cls, data, table: int, n: int, entries: int) -> _Block:
        out, at = cls.__new__(cls), 0
        held = []
        for kind, count in ((np.float64, entries), (np.float64, n), (np.int64, n), (np.int32, n), (np.int32, entries)):
            held.append(np.frombuffer(data, kind, count, at))
            at += held[-1].nbytes
        value, label, size, fold, col = held
        out._hold(table, label, fold, col, size, value)
        return out

    def products(self, w: np.ndarray) -> np.ndarray:
        """Models x rows of w (features x models), best held by model."""
        out, term = np.zeros((w.shape[1], self.n)), np.empty(len(self.value))
        if len(term):
            for own, x in zip(out, np.ascontiguousarray(w.T), strict=True):
                np.take(x, self.at, out=term, mode="clip")
                np.multiply(term, self.value, out=term)
                own[self.full] = np.add.reduceat(term, self.start)
        return out

    def scores(self, w: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rows x models of w (models x features)."""
        return self.products(np.ascontiguousarray(w.T)).T + b


def _loss(kind: str, y: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, its slope and its curvature by the score; y is 0 or 1."""
    sign = 2.0 * y - 1.0
    if kind == "logistic":
        z = sign * s
        p = 1 / (1 + np.exp(np.clip(z, -700, 700)))
        return np.logaddexp(0.0, -z), -sign * p, p * (1 - p)
    if kind == "squared_hinge":
        room = np.maximum(1.0 - sign * s, 0.0)
        return room * room, -2.0 * sign * room, 2.0 * (room > 0)
    raise ValueError(kind)


def _in_files(blocks: DataFrame, tables: list[int], folder: str) -> list[str]:
    """Files with the arrays of the blocks of ``tables``: one for each task that read blocks, under its own name, with an
    index of its blocks and the index's length at its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(folder)
        name, at, out, index = f"{base}/{uuid.uuid4().hex}", 0, None, []
        for batch in batches:
            for k in range(len(batch)):
                b = _Block(batch, k)
                out = out or store.open_output_stream(name)
                data = b.plain()
                out.write(data)
                index.append((b.table, at, len(data), b.n, len(b.value)))
                at += len(data)
        if out is not None:
            index = np.array(index, np.int64).tobytes()
            out.write(index + np.int64(len(index)).tobytes())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["file"])

    own = blocks.filter(F.col("feats").isin(tables)).mapInArrow(run, "file string")
    return [r["file"] for r in own.collect()]  # a name for each task


def _read_files(files: Iterator[str], folder: str, tables: set[int]) -> Iterator[_Block]:
    """The blocks of ``tables`` that lie in ``files``, one after another."""
    from pyarrow import fs
    store = fs.FileSystem.from_uri(folder)[0]
    for name in files:
        with store.open_input_file(name) as file:
            end = file.size() - 8
            size = int(np.frombuffer(file.read_at(8, end), np.int64)[0])
            for table, at, length, n, entries in np.frombuffer(file.read_at(size, end - size), np.int64).reshape(-1, 5).tolist():
                if table in tables:
                    yield _Block.read(file.read_at(length, at), table, n, entries)


_SUMS = "part int, sums binary"


def _pass(blocks: DataFrame, specs: list[Spec], asked: list[tuple], widths: list[int], folder: str | None = None,
          files: list[str] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each request (w with the intercept last, v or None): the summed slope (v None) or Hessian product over
    the rows, and [loss, sum of slopes' sizes, sum of their squares]. The rows are those of ``blocks``, or of the
    ``files`` in ``folder`` that were made of them."""
    sc = blocks.sparkSession.sparkContext
    starts = np.concatenate([[0], np.cumsum([len(w) + 3 for w, _ in asked])]).astype(int)
    tasks = min(len(files), sc.defaultParallelism) if files else 0  # every task sends sums as long as the coefficients
    parts = min(RANGES, starts[-1]) if files is None else max(1, min(RANGES, starts[-1] * tasks // MET))
    edges = np.linspace(0, starts[-1], parts + 1).astype(int)
    held = sc.broadcast((specs, asked))

    def sums(own_blocks: Iterator[_Block]) -> list[np.ndarray]:
        specs, asked = held.value
        out, seen = np.zeros(starts[-1]), False
        together = {}  # table -> the requests on it and their vectors side by side, (features x vectors)
        for t in {spec.table for spec in specs}:
            on = [j for j, spec in enumerate(specs) if spec.table == t]
            vectors = [x for j in on for x in asked[j] if x is not None]
            together[t] = on, np.stack([x[:-1] for x in vectors]).T, [x[-1] for x in vectors]
        for b in own_blocks:
            if b.table not in together:
                continue
            on, side, last = together[b.table]
            seen, scores, at = True, b.products(side), 0
            for j in on:
                spec, (w, v) = specs[j], asked[j]
                use = np.where(b.label > 0.5, spec.pos, spec.neg) * ((b.fold != spec.fold) | (spec.fold < 0))
                loss, slope, bend = _loss(spec.loss, b.label, scores[at] + last[at])
                r, at = use * slope, at + 1
                if v is not None:
                    r, at = use * bend * (scores[at] + last[at]), at + 1
                own = out[starts[j]:starts[j + 1]]
                term = np.repeat(r, b.size)
                np.multiply(term, b.value, out=term)
                np.add.at(own, b.at, term)
                own[len(w) - 1] += r.sum()
                own[len(w):] += (use * loss).sum(), np.abs(use * slope).sum(), (use * slope * slope).sum()
        return [out[a:z] for a, z in zip(edges, edges[1:], strict=False)] if seen else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [x.tobytes() for x in sums(_Block(batch, k) for batch in batches for k in range(len(batch)))]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist())
        return pa.table([table.column("part").slice(0, 1).combine_chunks(), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

    flat = np.zeros(starts[-1])
    tables = {spec.table for spec in specs}  # of models still fitted
    if files is None:
        got = blocks.filter(F.col("feats").isin(sorted(tables))).mapInArrow(run, _SUMS).groupBy("part").applyInArrow(add, _SUMS).collect()
        got = [(r["part"], np.frombuffer(r["sums"], np.float64)) for r in got]
    elif files:
        own = sc.parallelize(files, tasks).mapPartitions(lambda names: enumerate(sums(_read_files(names, folder, tables))))
        got = own.reduceByKey(np.add, parts).collect()
    else:
        got = []
    for part, total in got:  # the coefficients' size
        flat[edges[part]:edges[part + 1]] = total
    held.unpersist()
    return [(flat[a:z - 3], flat[z - 3:z]) for a, z in zip(starts, starts[1:], strict=False)]


def _penalty(spec: Spec, w: np.ndarray) -> np.ndarray:
    """The part of the coefficients that 1/2 |w|^2 is taken of."""
    out = w.copy()
    if spec.loss == "logistic":
        out[-1] = 0.0
    return out


def _lbfgs(spec: Spec, size: int, steps: int, tol: float):
    """Asks ("point", w), gets (objective, gradient); returns (w, gradient's share of that at zero)."""
    w = np.zeros(size)
    value, g = yield w, None
    first, pairs = max(np.abs(g).max(), 1e-300), []
    for _ in range(steps):
        if np.abs(g).max() <= tol * first:
            break
        q, back = g.copy(), []
        for s, y, rho in reversed(pairs):
            a = rho * (s @ q)
            q -= a * y
            back.append(a)
        if pairs:
            s, y, _ = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(g))
        for (s, y, rho), a in zip(pairs, reversed(back), strict=True):
            q += (a - rho * (y @ q)) * s
        slope, t = -(g @ q), 1.0
        if slope >= 0:
            q, slope, pairs = g.copy(), -(g @ g), []
        moved = False
        for _ in range(25):
            new = w - t * q
            value2, g2 = yield new, None
            if value2 <= value + 1e-4 * t * slope:
                moved = True
                break
            t *= 0.5
        if not moved:
            break
        s, y = new - w, g2 - g
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs, (s, y, 1.0 / (s @ y))][-MEMORY:]
        w, value, g = new, value2, g2
    return w, float(np.abs(g).max() / first)


def _newton(spec: Spec, size: int, steps: int, tol: float):
    """Newton's steps by conjugate gradients: asks also ("product", w, v)."""
    w = np.zeros(size)
    value, g = yield w, None
    first = max(np.abs(g).max(), 1e-300)
    for _ in range(steps):
        if np.abs(g).max() <= tol * first:
            break
        d, r = np.zeros(size), -g
        p, rr = r.copy(), r @ r
        enough = min(0.1, np.sqrt(np.linalg.norm(g) / (first * size ** 0.5))) * np.sqrt(rr)
        for _ in range(50):
            _, hp = yield w, p
            a = rr / max(p @ hp, 1e-300)
            d += a * p
            r = r - a * hp
            new = r @ r
            if np.sqrt(new) <= enough:
                break
            p, rr = r + (new / rr) * p, new
        slope, t = g @ d, 1.0
        moved = False
        for _ in range(25):
            value2, g2 = yield w + t * d, None
            if value2 <= value + 1e-4 * t * slope:
                moved = True
                break
            t *= 0.5
        if not moved:
            break
        w, value, g = w + t * d, value2, g2
    return w, float(np.abs(g).max() / first)


def fit_many(blocks: DataFrame, specs: list[Spec], widths: list[int], steps: int = 100, tol: float = 1e-4) -> list[Linear]:
    """Every model of ``specs`` on packed blocks; ``widths`` are the numbers of features of the tables."""
    folder = file_folder(blocks.sparkSession, "linear-arrays")
    if folder is None:  # passes read a written table
        return _fit_many(written(blocks, "linear"), specs, widths, steps, tol)
    try:
        return _fit_many(blocks, specs, widths, steps, tol, folder, _in_files(blocks, sorted({s.table for s in specs}), folder))
    finally:
        discard(blocks.sparkSession, folder)


def _fit_many(blocks: DataFrame, specs: list[Spec], widths: list[int], steps: int, tol: float, folder: str | None = None,
              files: list[str] | None = None) -> list[Linear]:
    runs = [(_newton if s.loss == "squared_hinge" else _lbfgs)(s, widths[s.table] + 1, steps, tol) for s in specs]
    asks = {k: next(r) for k, r in enumerate(runs)}
    done: dict[int, tuple] = {}
    passes = dict.fromkeys(asks, 0)
    while asks:
        keys = sorted(asks)
        got = _pass(blocks, [specs[k] for k in keys], [asks[k] for k in keys], widths, folder, files)
        for k, (total, sums) in zip(keys, got, strict=True):
            (w, v), spec = asks[k], specs[k]
            passes[k] += 1
            own = _penalty(spec, w)
            answer = ((None, _penalty(spec, v) + spec.C * total) if v is not None
                      else (0.5 * own @ own + spec.C * sums[0], own + spec.C * total))
            try:
                asks[k] = runs[k].send(answer)
            except StopIteration as end:
                done[k] = end.value
                del asks[k]
    out = []
    last = _pass(blocks, specs, [(done[k][0], None) for k in range(len(specs))], widths, folder, files)
    for k, spec in enumerate(specs):
        (w, slope), (total, sums) = done[k], last[k]
        gap = float("nan")
        if spec.loss == "squared_hinge":
            # dual point: a row's weight is C times the size of its loss's slope
            primal = 0.5 * w @ w + spec.C * sums[0]
            dual = spec.C * sums[1] - 0.5 * spec.C ** 2 * (total @ total) - spec.C * sums[2] / 4
            gap = (primal - dual) / max(abs(primal), 1e-300)
        out.append(Linear(spec, w[:-1], float(w[-1]), slope, float(gap), passes[k]))
    return out


def score_many(blocks: DataFrame, models: list[Linear], held_out: bool = False) -> DataFrame:
    """(id, model, fold, label, score) of the blocks' rows by every model of their table; ``held_out``: only the rows of
    the fold that the model left out."""
    held = blocks.sparkSession.sparkContext.broadcast(models)
    kind = blocks.schema["ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side: dict[int, np.ndarray] = {}  # table -> its models' coefficients side by side
        for batch in batches:
            for k in range(len(batch)):
                b = _Block(batch, k)
                ids = batch.column("ids")[k].values
                on = [m for m in held.value if m.spec.table == b.table]
                if not on:
                    continue
                if b.table not in side:
                    side[b.table] = np.stack([m.w for m in on]).T
                for m, score in zip(on, b.products(side[b.table]), strict=True):
                    score = score + m.b
                    at = np.flatnonzero(b.fold == m.spec.fold) if held_out else np.arange(b.n)
                    label = b.label[at]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at)), pa.array([m.spec.name] * len(at), pa.string()), pa.array(b.fold[at]),
                         pa.array(np.nan_to_num(label).astype(np.int32), mask=np.isnan(label)), pa.array(score[at])],
                        ["id", "model", "fold", "label", "score"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("model", T.StringType()), T.StructField("fold", T.IntegerType()),
                           T.StructField("label", T.IntegerType()), T.StructField("score", T.DoubleType())])
    return blocks.mapInArrow(run, schema)


def balanced(docs: DataFrame) -> tuple[float, float]:
    """Class weights (positive, negative) that give both classes the same total, the number of rows."""
    r = docs.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") > 0.5).alias("p")).first()
    return (r["n"] / (2.0 * max(1, r["p"])), r["n"] / (2.0 * max(1, r["n"] - r["p"])))


@dataclass
class Platt:
    """p = 1 / (1 + exp(-(a * score + b))); ``slope`` is the gradient's share of that at the start."""
    a: float
    b: float
    slope: float


def platt_many(scores: DataFrame, steps: int = 40, tol: float = 1e-9) -> dict[str, Platt]:
    """Sigmoid calibration of every model of (model, score, label), with Platt's soft targets, by Newton's steps: one
    aggregate per step for all models, five sums of each."""
    spark = scores.sparkSession
    n = {r["model"]: (r["p"], r["n"] - r["p"]) for r in scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("p")).collect()}  # a row for each model
    target = {m: ((p + 1.0) / (p + 2.0), 1.0 / (q + 2.0)) for m, (p, q) in n.items()}
    at = {m: (0.0, float(np.log((p + 1.0) / (q + 1.0)))) for m, (p, q) in n.items()}

    def sums(points: dict) -> dict:
        table = F.broadcast(spark.createDataFrame([(m, *points[m], *target[m]) for m in points],
                                                  "model string, a double, b double, tp double, tn double"))
        rows = scores.select("model", "label", F.col("score").alias("s")).join(table, "model")
        z = F.col("a") * F.col("s") + F.col("b")
        t = F.when(F.col("label") == 1, F.col("tp")).otherwise(F.col("tn"))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        soft = F.when(z > 0, F.log1p(F.exp(-z))).otherwise(F.log1p(F.exp(z)) - z)
        rows = rows.select("model", "s", (p - t).alias("r"), (p * (F.lit(1.0) - p)).alias("h"), (soft + (F.lit(1.0) - t) * z).alias("loss"))
        got = rows.groupBy("model").agg(F.sum(F.col("r") * F.col("s")), F.sum("r"), F.sum(F.col("h") * F.col("s") * F.col("s")),
                                        F.sum(F.col("h") * F.col("s")), F.sum("h"), F.sum("loss")).collect()
        return {r[0]: tuple(r)[1:] for r in got}

    now, size, out = sums(at), {}, {}
    first = {m: max(abs(x[0]), abs(x[1]), 1e-300) for m, x in now.items()}
    going = dict(at)
    for _ in range(steps):
        for m in [m for m in going if max(abs(now[m][0]), abs(now[m][1])) <= tol * first[m]]:
            del going[m]
        if not going:
            break
        tried = {}
        for m in going:
            ga, gb, haa, hab, hbb, _ = now[m]
            haa, hbb = haa + 1e-12, hbb + 1e-12
            det = haa * hbb - hab * hab
            da, db = ((-ga / haa, -gb / hbb) if det <= 1e-18 * haa * hbb else
                      (-(hbb * ga - hab * gb) / det, -(haa * gb - hab * ga) / det))
            t = size.get(m, 1.0)
            tried[m] = at[m][0] + t * da, at[m][1] + t * db
        got = sums(tried)
        for m in tried:
            if got[m][5] <= now[m][5] + 1e-12 * abs(now[m][5]):
                at[m], now[m], size[m] = tried[m], got[m], 1.0
            else:
                size[m] = size.get(m, 1.0) / 2
                if size[m] < 1e-6:
                    del going[m]
    for m in at:
        out[m] = Platt(*at[m], max(abs(now[m][0]), abs(now[m][1])) / first[m])
    return out


def calibrated_probabilities(scores: DataFrame, platts: dict[str, Platt]) -> DataFrame:
    """``scores`` (id, model, score) with p by the model's calibration."""
    table = F.broadcast(scores.sparkSession.createDataFrame([(m, x.a, x.b) for m, x in platts.items()], "model string, a double, b double"))
    return scores.join(table, "model").withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("a") * F.col("score") + F.col("b"))))).drop("a", "b")
