"""Exact ranks and running counts over a global order, without a single-partition window.

``Window.partitionBy(label).orderBy(key)`` puts a whole class (85% of the rows in the
driver's data) into one task; ``Window.orderBy(key)`` puts everything there. Instead:

1. range-partition on (group, order): Spark samples the keys, so every range holds about
   the same number of rows whatever the group sizes are;
2. freeze the range id with a reliable checkpoint (a re-run could sample other bounds);
3. running sum inside each (range, group) with a window — bounded by one range;
4. per (range, group) totals — at most ``ranges + groups`` rows — give each range its
   offset, joined back.

Ties must be pre-aggregated by the caller (one row per distinct key with a weight), so a
hot value is one row here, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import ensure_checkpoint_dir


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def running_before(df: DataFrame, order_cols: Sequence[str | Column], group_cols: Sequence[str] = (),
                   weight_col: str | None = None, out: str = "before",
                   num_ranges: int | None = None, broadcast_offsets: bool = True) -> DataFrame:
    """Add ``out`` = sum of weights (1 per row by default) of the rows of the same group that
    come strictly before this row in ``order_cols`` (which must be unique within a group).

    ``broadcast_offsets``: the offsets table has at most ranges + groups rows; keep True when
    the number of groups is small (labels, folds, models)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    group_cols = list(group_cols)
    order = _cols(order_cols)
    w = F.col(weight_col).cast("long") if weight_col else F.lit(1).cast("long")
    ranged = (df.withColumn("_w", w)
              .repartitionByRange(n, *[F.col(g) for g in group_cols], *order)
              .withColumn("_rp", F.spark_partition_id())
              .checkpoint(eager=True))
    local_w = (Window.partitionBy("_rp", *group_cols).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumn("_lb", F.coalesce(F.sum("_w").over(local_w), F.lit(0).cast("long")))
    totals = ranged.groupBy("_rp", *group_cols).agg(F.sum("_w").alias("_t"))
    off_w = Window.partitionBy(*group_cols).orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1) \
        if group_cols else Window.orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_rp", *group_cols,
                            F.coalesce(F.sum("_t").over(off_w), F.lit(0).cast("long")).alias("_off"))
    if broadcast_offsets:
        offsets = F.broadcast(offsets)
    return (local.join(offsets, ["_rp", *group_cols])
            .withColumn(out, F.col("_off") + F.col("_lb"))
            .drop("_rp", "_lb", "_off", "_w"))


def row_number0(df: DataFrame, order_cols, group_cols=(), out: str = "rn0", **kw) -> DataFrame:
    """0-based row number within group by a unique order."""
    return running_before(df, order_cols, group_cols, None, out, **kw)


def average_rank_table(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                       extra_sums: dict[str, Column] | None = None, **kw) -> DataFrame:
    """Distinct (group, value) with ``cnt`` rows and ``avg_rank`` = 1-based rank of the value
    within its group, ties sharing the mean of their positions. ``extra_sums`` adds sum
    aggregates per distinct value (e.g. positives for AUC)."""
    aggs = [F.count(F.lit(1)).alias("cnt")]
    for name, c in (extra_sums or {}).items():
        aggs.append(F.sum(c).alias(name))
    distinct = df.groupBy(*group_cols, value_col).agg(*aggs)
    ranked = running_before(distinct, [value_col], group_cols, "cnt", "before", **kw)
    return ranked.withColumn("avg_rank", F.col("before") + (F.col("cnt") + 1) / 2.0)
