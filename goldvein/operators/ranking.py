"""Exact global ranks and tiles without a single-task window.

``ntile`` over a whole table needs one global order; written as a window
without ``partitionBy`` it runs in one task. Here:

1. range-partition on the ordering columns (sampled bounds; written once with a
   reliable ``checkpoint()`` so every branch sees the same partitioning);
2. count rows per partition and prefix-sum those counts: a table with one row
   per partition, so its window is bounded by the partition count, not the data;
3. rank = rows in earlier partitions + row number inside the partition;
4. tile from the rank and the total, with SQL NTILE's rule: the first
   ``total % tiles`` tiles get one row more.

Order columns must make the order total (add a unique key as the last one);
then the result equals ``NTILE(tiles) OVER (ORDER BY ...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def global_rank(df: DataFrame, order_cols: list[str], out: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = 1-based position in ascending ``order_cols`` (NULLs first)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(spark)
    sliced = (df.repartitionByRange(n, *order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    per_part = sliced.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = per_part.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = sliced.withColumn("_r", F.row_number().over(Window.partitionBy("_pid").orderBy(*order_cols)))
    return (local.join(offsets, "_pid")
            .withColumn(out, F.col("_off") + F.col("_r"))
            .drop("_pid", "_r", "_off"))


def ntile_from_rank(rank: Column, total: Column, tiles: int) -> Column:
    """SQL NTILE bucket of a 1-based rank among ``total`` rows."""
    q = F.floor(total / tiles)
    rem = total % tiles
    big = (q + 1) * rem  # rows held by the tiles that get one extra row
    return (F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1)
            .otherwise(rem + F.floor((rank - 1 - big) / q) + 1)).cast("int")


def global_ntile(df: DataFrame, order_cols: list[str], tiles: int, out: str,
                 partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = NTILE(tiles) OVER (ORDER BY order_cols)."""
    total = df.count()  # one scalar
    ranked = global_rank(df, order_cols, "_rank", partitions)
    return ranked.withColumn(out, ntile_from_rank(F.col("_rank"), F.lit(total), tiles)).drop("_rank")


def global_ntiles(df: DataFrame, id_col: str, measures: dict[str, Column], tiles: int,
                  partitions: int | None = None) -> DataFrame:
    """``id_col`` and, per measure (output name -> numeric column), its NTILE(tiles) OVER (ORDER BY measure, id).

    All measures are ranked at once: ``df`` is computed once, one narrow row a measure and id is
    range-partitioned and written once, and totals come from the counts per partition.
    ``id_col`` must be unique; NULL measures come first, as a NULL id does.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(spark)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_m"), v.cast("double").alias("_v")) for i, v in enumerate(measures.values())]))
    sliced = (df.select(id_col, pairs.alias("_p")).select(id_col, "_p._m", "_p._v")
              .repartitionByRange(n, "_m", "_v", id_col)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    measure = Window.partitionBy("_m")
    earlier = measure.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (sliced.groupBy("_m", "_pid").agg(F.count(F.lit(1)).alias("_n"))
             .select("_m", "_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(measure).alias("_total")))
    inside = F.row_number().over(Window.partitionBy("_m", "_pid").orderBy("_v", id_col))
    tiled = sliced.withColumn("_r", inside).join(sizes, ["_m", "_pid"]).select(
        id_col, "_m", ntile_from_rank(F.col("_before") + F.col("_r"), F.col("_total"), tiles).alias("_tile"))
    return tiled.groupBy(id_col).agg(*[F.max(F.when(F.col("_m") == i, F.col("_tile"))).alias(out) for i, out in enumerate(measures)])
