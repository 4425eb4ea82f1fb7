"""Skew-safe batch sessionization (K2).

A session groups a key's events whose gaps are at most ``gap`` (inclusive);
it starts at its first event and ends ``gap`` after its last one. Spark's
``session_window`` does this per key, but in batch it sorts every event of a
key in one task. Here:

1. events are aggregated by (key, time slice of width ``gap``). Two events of one
   slice are always in one session, so a slice needs no more than its first and
   last time and its totals: each task combines its own rows before the shuffle,
   and a hot key is spread over its slices;
2. a window over the slices of a key starts a new session where a slice begins
   more than ``gap`` after the end of the one before. A key has at most one row
   per ``gap`` of the calendar there, however many events it has;
3. slices are added up by session, in the same partitioning.

The slices depend on the data alone, so a recomputed task gives the same rows and
nothing is checkpointed. The result equals one global sessionization.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SESSION_COLUMNS = ("session_start", "session_end", "n_events", "first_event", "last_event", "actions",
                   "device_type")


def sessionize(events: DataFrame, key: str, ts: str, gap: str) -> DataFrame:
    """Sessions of ``events`` (needs columns key, ts, action, device_type); rows without key or time don't count.

    Output: key, session_start, session_end, n_events, first_event, last_event,
    actions (distinct, sorted array), device_type (smallest seen).
    """
    interval = F.expr(f"INTERVAL {gap}")
    slices = (events.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
              .groupBy(F.col(key), F.window(ts, gap).alias("_slice"))
              .agg(F.count(F.lit(1)).alias("n_events"), F.min(ts).alias("first_event"), F.max(ts).alias("last_event"),
                   F.collect_set("action").alias("actions"), F.min("device_type").alias("device_type"))
              .drop("_slice"))
    by_time = Window.partitionBy(key).orderBy("first_event")
    before = F.lag("last_event").over(by_time)
    numbered = (slices.withColumn("_new", F.when(before + interval >= F.col("first_event"), 0).otherwise(1))
                .withColumn("_session", F.sum("_new").over(by_time.rowsBetween(Window.unboundedPreceding, 0))))
    return (numbered.groupBy(key, "_session")
            .agg(F.min("first_event").alias("session_start"), (F.max("last_event") + interval).alias("session_end"),
                 F.sum("n_events").alias("n_events"), F.min("first_event").alias("first_event"),
                 F.max("last_event").alias("last_event"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("actions")))).alias("actions"),
                 F.min("device_type").alias("device_type"))
            .select(key, *SESSION_COLUMNS))


def merge_sessions(parts: DataFrame, key: str, gap: str) -> DataFrame:
    """Sessions from parts of sessions (key, n_events, first_event, last_event) that may overlap or be nested.

    Parts within ``gap`` of each other are one session. A key's parts are put in
    order by one task, so callers add up single events per slice first.
    """
    interval = F.expr(f"INTERVAL {gap}")
    by_time = Window.partitionBy(key).orderBy("first_event", "last_event")
    before = F.max("last_event").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    numbered = (parts.withColumn("_new", F.when(before + interval >= F.col("first_event"), 0).otherwise(1))
                .withColumn("_session", F.sum("_new").over(by_time.rowsBetween(Window.unboundedPreceding, 0))))
    return (numbered.groupBy(key, "_session")
            .agg(F.min("first_event").alias("session_start"), (F.max("last_event") + interval).alias("session_end"),
                 F.sum("n_events").alias("n_events"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"))
            .drop("_session"))
