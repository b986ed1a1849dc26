"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one Arrow batch are worked on in slices of about this many text bytes.
SLICE_BYTES = 4 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package wherever the session was started. Where executors have
    other disks, the package is installed there or shipped with the job."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``limit`` bytes of ``column`` (text, bytes or a list of
    64-bit numbers; one row at least),
    so that a batch of very long texts is never turned into Python objects at once."""
    for batch in batches:
        own = batch.column(column)
        sizes = pa.compute.multiply(pa.compute.list_value_length(own), 8) if pa.types.is_list(own.type) \
            else pa.compute.binary_length(own)
        sizes = sizes.fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings, null as the empty string."""
    return ["" if x is None else x for x in batch.column(column).to_pylist()]


def pieces(total: int, each: int) -> int:
    return max(1, -(-int(total or 0) // each))


def fresh(name: str, df: DataFrame) -> str:
    """The name, lengthened until no column of ``df`` has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def extended(df: DataFrame, more: str) -> T.StructType:
    """The schema of ``df`` and the columns of a schema string after it."""
    return T.StructType([*df.schema.fields, *T._parse_datatype_string(more).fields])


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def put_file(folder: str, name: str, data: bytes) -> None:
    """Write one file of a shared folder under a deterministic name. The bytes go to a private
    name first and are moved into place, so a retried or speculative task leaves one whole file."""
    import uuid

    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    part = f"{base}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, f"{base}/{name}")


def make_folder(folder: str) -> None:
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)


def shared_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder, as a URI, in the shared checkpoint folder."""
    from revlens.session import scratch_path

    path = scratch_path(spark, name)
    uri = path if "://" in path else f"file://{path.removeprefix('file:')}"
    make_folder(uri)
    return uri


def code_points(many: list[str]):
    """All texts as one array of code points, each followed by a line break, and where each begins
    (one entry more than texts)."""
    import numpy as np

    flat = np.frombuffer("\n".join([*many, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(many) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in many], out=starts[1:])
    return flat, starts


def numbered(df: DataFrame, group: str, order: list[str], name: str, out: str = "rank") -> DataFrame:
    """``df`` with the place (from 0) of every row in its group, ascending, null first; written.

    Rows are dealt by ranges of (group, order), equal ones by chance, so a group of any size is spread. A
    task numbers its own rows; only the first group of a task can have begun in an earlier one, so that
    one number for each task (at most as many as partitions, broadcast) puts the ranges together.
    ``group`` must not be null."""
    from revlens.session import written

    task, begun = fresh("_task", df), fresh("_begun", df)
    tie = fresh("_tie", df)
    spark = df.sparkSession
    keys = [F.col(group), *(F.col(c).asc_nulls_first() for c in order), F.col(tie)]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = (df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
             .sortWithinPartitions(*keys).drop(tie).withColumn(task, F.spark_partition_id()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        last, held, first = None, 0, True
        for b in batches:
            if not len(b):
                continue
            own = b.column(group)
            new = np.ones(len(b), bool)
            new[1:] = np.asarray(pa.compute.not_equal(own[1:], own[:-1]).to_numpy(zero_copy_only=False), bool)
            new[0] = own[0] != last
            at = np.arange(len(b))
            start = np.maximum.accumulate(np.where(new, at, -1))
            place = np.where(start < 0, at + held, at - start)
            opened = np.cumsum(new) == (1 if last is None else 0)
            lead = opened if first else np.zeros(len(b), bool)
            first = first and bool(lead.all())
            last, held = own[len(b) - 1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place.astype(np.int64)), pa.array(lead)],
                                             [*b.schema.names, out, begun])

    rows = written(dealt.mapInArrow(count, extended(dealt, f"`{out}` bigint, `{begun}` boolean")), name)
    # of every task: its first and its last group, and how many rows of them it has
    ends = rows.groupBy(task).agg(
        F.min_by(group, ~F.col(begun)).alias("g"), F.count_if(F.col(begun)).alias("n"), F.count_if(~F.col(begun)).alias("others"),
        F.max(F.struct(F.col(group), F.col(out))).alias("z"))
    from pyspark.sql import Window

    ends = ends.select(task, F.explode(F.when(F.col("others") == 0, F.array(F.struct("g", "n"))).otherwise(F.array(
        F.struct("g", "n"), F.struct(F.col(f"z.{group}").alias("g"), (F.col(f"z.{out}") + 1).alias("n"))))).alias("e"))
    before = F.sum("e.n").over(Window.partitionBy("e.g").orderBy(task).rowsBetween(Window.unboundedPreceding, -1))
    more = ends.select(task, F.col("e.g").alias("_g"), before.alias("_before")).filter("_before is not null")
    met = rows.join(F.broadcast(more.select(task, "_before", F.lit(True).alias(begun))), [task, begun], "left")
    return met.withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))).select(*df.columns, out)
