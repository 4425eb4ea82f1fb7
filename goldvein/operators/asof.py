"""Skew-safe as-of lookup: for each probe row, the value of the latest fact row
with the same key at or before the probe's time.

Spark has no as-of join. The plain form (union + ``last(ignorenulls)`` over a
window partitioned by key) puts all rows of one key into one task; a key that
holds a third of the data would make one task do a third of the work. Here the
time of a key is cut into slices of fixed width:

1. per (key, slice) the last fact value: an aggregation that each task begins
   before the shuffle, with at most one row a slice;
2. over that small table, the value that each slice with probes begins with is
   the last one of the key's earlier slices;
3. this carried value joins its slice as one more fact at the slice's start, and
   one window per (key, slice) over probes, facts and carried values fills
   forward. This is the only shuffle of whole rows.

The slices depend on the data alone (unlike sampled range bounds), so nothing has
to be checkpointed and a recomputed task gives the same rows.

Facts at the same time as a probe count as "at or before" (facts sort first);
among facts with equal times the largest tiebreak wins, then the largest value.
Facts without a value don't count. Probes without key or time get NULL. The
result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "1 hour"
CARRIED, FACT, PROBE = -1, 0, 1  # rows of one time in this order


def asof_latest(probes: DataFrame, facts: DataFrame, key: str, probe_ts: str, fact_ts: str,
                value: str, tiebreak: str, out: str = "asof_value", slice_width: str = SLICE) -> DataFrame:
    """``probes`` with one more column ``out``: the as-of fact value, NULL if none.

    ``slice_width`` is best chosen so that the busiest key's rows of one slice fit in a task.
    """
    pcols = probes.columns
    ptypes = {f.name: f.dataType for f in probes.schema}
    vtype, ttype = facts.schema[value].dataType, facts.schema[tiebreak].dataType
    usable = F.col(key).isNotNull() & F.col(probe_ts).isNotNull()
    rest = probes.where(~usable).withColumn(out, F.lit(None).cast(vtype))
    slice_of = lambda ts: F.window(ts, slice_width)["start"]

    def rows(df: DataFrame, k: Column, ts: Column, kind: int, tb: Column, v: Column) -> DataFrame:
        own = [F.col(c) if kind == PROBE else F.lit(None).cast(ptypes[c]).alias(c) for c in pcols]
        return df.select(*own, k.alias("_k"), ts.alias("_ts"), F.lit(kind).alias("_kind"), tb.cast(ttype).alias("_tb"), v.cast(vtype).alias("_v"))

    none = F.lit(None)
    p = rows(probes.where(usable), F.col(key), F.col(probe_ts), PROBE, none, none)
    f = rows(facts.where(F.col(key).isNotNull() & F.col(fact_ts).isNotNull() & F.col(value).isNotNull()),
             F.col(key), F.col(fact_ts), FACT, F.col(tiebreak), F.col(value))

    ends = f.groupBy("_k", slice_of("_ts").alias("_slice")).agg(F.max(F.struct("_ts", "_tb", "_v")).alias("_end"))
    asked = p.groupBy("_k", slice_of("_ts").alias("_slice")).agg(F.lit(True).alias("_asked"))
    earlier = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ends.unionByName(asked, allowMissingColumns=True)
               .groupBy("_k", "_slice").agg(F.max("_end").alias("_end"), F.max("_asked").alias("_asked"))
               .withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier))
               .where(F.col("_asked") & F.col("_carry").isNotNull()))
    c = rows(carried, F.col("_k"), F.col("_slice"), CARRIED, none, F.col("_carry._v"))

    filled = Window.partitionBy("_k", "_slice").orderBy("_ts", "_kind", "_tb", "_v")
    sliced = p.unionByName(f).unionByName(c).withColumn("_slice", slice_of("_ts"))
    found = (sliced.withColumn(out, F.last("_v", ignorenulls=True).over(filled.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .where(F.col("_kind") == PROBE).select(*pcols, out))
    return found.unionByName(rest)
