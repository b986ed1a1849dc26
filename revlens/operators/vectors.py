"""Long sparse features (id, idx, value) -> one MLlib vector per review, with no Python on
the row path.

Spark has no SQL function that builds a VectorUDT value, but the UDT is stored in parquet as
struct(type tinyint, size int, indices array<int>, values array<double>). We write that
struct with plain SQL functions to a table under the shared checkpoint folder and read it
back with a VectorUDT schema; the write doubles as the cache that the iterative learners
need and cuts the lineage (an executor loss re-reads the files instead of recomputing the
feature plan).
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import scratch_path


def assemble_sparse(feat: DataFrame, size: int, docs: DataFrame, id_col: str = "id",
                    keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep_cols, features VectorUDT). ``docs`` lists every review (a review without any
    feature gets the empty sparse vector); a review's entries are bounded by ``size``."""
    per = feat.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct(
        F.col("idx").cast("int").alias("i"), F.col("value").cast("double").alias("v")))).alias("e"))
    full = docs.select(id_col, *keep_cols).join(per, id_col, "left")
    e = F.coalesce(F.col("e"), F.array().cast("array<struct<i:int,v:double>>"))
    struct = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(int(size)).alias("size"),
                      F.transform(e, lambda x: x["i"]).alias("indices"),
                      F.transform(e, lambda x: x["v"]).alias("values"))
    out = full.select(id_col, *keep_cols, struct.alias("features"))
    spark = feat.sparkSession
    path = scratch_path(spark, "vectors")
    out.write.mode("overwrite").parquet(path)
    schema = T.StructType([f if f.name != "features" else T.StructField("features", VectorUDT(), True)
                           for f in out.schema.fields])
    return spark.read.schema(schema).parquet(path)
