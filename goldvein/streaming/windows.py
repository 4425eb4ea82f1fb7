"""Event-time windowed aggregations over bronze streams (T4, T5; K2 and K10 streaming forms).

Both operators are append-mode stateful aggregations: a window or session is
emitted once the watermark (max event time seen minus the delay) passes its
end, and its state is dropped then. Sessions are merged inside each input
partition before the shuffle (see ``session.RECOMMENDED_CONF``), so a hot
customer ships sessions rather than raw events.

Landed files are not ordered by event time, so a run may bring rows that are
behind the watermark of the runs before. Spark would drop them from the state;
``run_with_late_rows`` turns them aside instead, while they pass: windows and
late rows leave one query through one exactly-once sink, in folders of their own
(``arrival=on_time`` and ``arrival=late``). ``complete_sessions`` and
``complete_hourly_counts`` bring the emitted results to what all rows give by
merging the late rows into the windows of their keys, without reading bronze:
a late row is a session of one event, and sessions within the gap of each other
are one. Sessions that are still open are read from the state store
(``open_sessions``), so that emitted + open + late rows account for the input.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules as R
from ..operators.sessions import merge_sessions
from ..session import path_exists

ARRIVAL, ON_TIME, LATE = "arrival", "on_time", "late"


def utc_wall_clock(spark: SparkSession, c: Column) -> Column:
    """TIMESTAMP (instant) -> TIMESTAMP_NTZ holding its UTC wall-clock time."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    ntz = c.cast("timestamp_ntz")
    return ntz if tz in ("UTC", "Etc/UTC", "GMT", "Z") else F.convert_timezone(F.lit(tz), F.lit("UTC"), ntz)


def customer_sessions(spark: SparkSession, events: DataFrame, gap: str = "30 minutes",
                      delay: str | None = None, key: str = "customer_id") -> DataFrame:
    """Per-key sessions: events closer than ``gap`` (inclusive) share a session.

    Session end = last event + gap. ``delay`` (default = gap) is the watermark
    delay; later events for a closed session are dropped by Spark as late.
    """
    ts = R.utc_instant("timestamp")
    keyed = events.where(F.col(key).isNotNull()).withColumn("event_ts", ts).where(F.col("event_ts").isNotNull())
    agg = (keyed.withWatermark("event_ts", delay or gap)
           .groupBy(key, F.session_window("event_ts", gap).alias("s"))
           .agg(F.count(F.lit(1)).alias("n_events"),
                F.min("event_ts").alias("first_event"),
                F.max("event_ts").alias("last_event")))
    return agg.select(
        key,
        utc_wall_clock(spark, F.col("s.start")).alias("session_start"),
        utc_wall_clock(spark, F.col("s.end")).alias("session_end"),
        "n_events",
        utc_wall_clock(spark, F.col("first_event")).alias("first_event"),
        utc_wall_clock(spark, F.col("last_event")).alias("last_event"))


def hourly_log_counts(spark: SparkSession, logs: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Tumbling 1-hour windows per service and level: events and 5xx responses."""
    keyed = logs.withColumn("event_ts", R.utc_instant("timestamp")).where(F.col("event_ts").isNotNull())
    agg = (keyed.withWatermark("event_ts", delay)
           .groupBy(F.window("event_ts", "1 hour").alias("w"), "service", "level")
           .agg(F.count(F.lit(1)).alias("n_events"),
                R.count_when(F.col("status_code") >= 500).alias("n_5xx")))
    return agg.select(utc_wall_clock(spark, F.col("w.start")).alias("window_start"),
                      utc_wall_clock(spark, F.col("w.end")).alias("window_end"),
                      "service", "level", "n_events", "n_5xx")


def watermark_ms(spark: SparkSession, checkpoint: str) -> int:
    """The watermark that the next micro-batch starts with, in milliseconds; 0 before the first one."""
    commits = f"{checkpoint}/commits"
    if not path_exists(spark, commits):
        return 0
    marks = spark.read.text(commits).where(F.col("value").startswith("{"))  # a bounded number of small files
    return marks.agg(F.max(F.get_json_object("value", "$.nextBatchWatermarkMs").cast("long"))).first()[0] or 0


def closed_until(spark: SparkSession, checkpoint: str) -> datetime:
    """UTC wall-clock time up to which windows have been emitted."""
    return datetime(1970, 1, 1) + timedelta(milliseconds=watermark_ms(spark, checkpoint))


def _newest_batch(spark: SparkSession, folder: str) -> int:
    if not path_exists(spark, folder):
        return -1
    newest = spark.read.text(folder).agg(F.max(F.expr("try_cast(_metadata.file_name AS BIGINT)"))).first()[0]
    return -1 if newest is None else newest


def dropped_rows(query: StreamingQuery) -> int:
    """Waits for the end of a query; rows that its state operators dropped as late."""
    dropped: dict[int, int] = {}
    ended = False
    while not ended:  # Spark keeps the last progress reports only: gather them on the way
        ended = query.awaitTermination(1)
        dropped |= {p["batchId"]: sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]) for p in query.recentProgress}
    return sum(dropped.values())


def run_with_late_rows(spark: SparkSession, plan: Callable[[int], DataFrame], path: str, checkpoint: str) -> None:
    """Append-mode, exactly-once Parquet sink; processes what is available and stops.

    ``plan(watermark)`` gives the windows and late rows of one run, such as
    ``sessions_and_late_rows``. The watermark moves between micro-batches, so a
    run reads what is there in one of them (its source must not limit files per
    trigger). A micro-batch that a lost run left unfinished is ended by itself
    first, with the watermark it had.
    """
    left = True
    while left:
        left = _newest_batch(spark, f"{checkpoint}/offsets") > _newest_batch(spark, f"{checkpoint}/commits")
        w = (plan(watermark_ms(spark, checkpoint)).writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", checkpoint).partitionBy(ARRIVAL).outputMode("append"))
        dropped = dropped_rows((w.trigger(once=True) if left else w.trigger(availableNow=True)).start())
        if dropped:
            raise RuntimeError(f"{dropped} late rows were dropped: the source gave more than one micro-batch to a run")


def arrived(spark: SparkSession, path: str, arrival: str) -> DataFrame:
    """What ``run_with_late_rows`` wrote: emitted windows (``ON_TIME``) or late rows (``LATE``)."""
    return spark.read.parquet(path).where(F.col(ARRIVAL) == arrival).drop(ARRIVAL)


def sessions_and_late_rows(spark: SparkSession, events: DataFrame, watermark: int, gap: str = "30 minutes",
                           delay: str | None = None, key: str = "customer_id") -> DataFrame:
    """``customer_sessions`` of the events after the watermark, and each other event as a session of its own.

    An event up to the watermark may be within the gap of a session that was
    emitted; one after it is not, and Spark drops none of them. Events without
    key or time don't count. The source is read by both branches.
    """
    ts = F.col("event_ts")
    passed = F.unix_millis(R.utc_instant("timestamp")) <= watermark
    sessions = customer_sessions(spark, events.where(~passed), gap, delay, key)
    rows = events.where(passed & F.col(key).isNotNull()).withColumn("event_ts", R.utc_instant("timestamp"))
    at = utc_wall_clock(spark, ts)
    late = rows.select(key, at.alias("session_start"), (at + F.expr(f"INTERVAL {gap}")).alias("session_end"),
                       F.lit(1).cast("long").alias("n_events"), at.alias("first_event"), at.alias("last_event"))
    return sessions.withColumn(ARRIVAL, F.lit(ON_TIME)).unionByName(late.withColumn(ARRIVAL, F.lit(LATE)))


def hourly_counts_and_late_rows(spark: SparkSession, logs: DataFrame, watermark: int, delay: str = "1 hour") -> DataFrame:
    """``hourly_log_counts`` of the rows whose window is open, and each other row as a window of its own."""
    hour = F.floor(F.unix_millis(R.utc_instant("timestamp")) / 3_600_000)
    passed = (hour + 1) * 3_600_000 <= watermark
    counts = hourly_log_counts(spark, logs.where(~passed), delay)
    start = utc_wall_clock(spark, F.timestamp_millis(hour * 3_600_000))
    late = logs.where(passed).select(
        start.alias("window_start"), (start + F.expr("INTERVAL 1 HOUR")).alias("window_end"), "service", "level",
        F.lit(1).cast("long").alias("n_events"),
        F.when(F.col("status_code") >= 500, 1).otherwise(0).cast("long").alias("n_5xx"))
    return counts.withColumn(ARRIVAL, F.lit(ON_TIME)).unionByName(late.withColumn(ARRIVAL, F.lit(LATE)))


def open_sessions(spark: SparkSession, checkpoint: str, key: str = "customer_id") -> DataFrame:
    """The sessions that a session query holds in its state, not emitted yet."""
    held = spark.read.format("statestore").load(checkpoint).select("value.*")
    return held.select(
        key,
        utc_wall_clock(spark, F.col("session_window.start")).alias("session_start"),
        utc_wall_clock(spark, F.col("session_window.end")).alias("session_end"),
        F.col("count").alias("n_events"),
        utc_wall_clock(spark, F.col("min")).alias("first_event"),
        utc_wall_clock(spark, F.col("max")).alias("last_event"))


def complete_sessions(emitted: DataFrame, late: DataFrame, still_open: DataFrame, until: datetime | None,
                      gap: str = "30 minutes", key: str = "customer_id") -> DataFrame:
    """The sessions closed by ``until`` that all rows give (None: all sessions, open ones too).

    Only keys with late rows are merged again, from their sessions: those of
    other keys are as emitted. Late rows are added up per gap-wide slice of a key
    first, in each task, so a hot key ships no more than its slices.
    """
    keys = late.select(key).distinct()
    slices = (late.groupBy(key, F.window("first_event", gap).alias("_slice"))
              .agg(F.sum("n_events").alias("n_events"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event")))
    columns = [key, "n_events", "first_event", "last_event"]
    known = emitted.unionByName(still_open)
    merged = merge_sessions(known.join(keys, key, "left_semi").select(columns).unionByName(slices.select(columns)), key, gap)
    whole = known.join(keys, key, "left_anti").unionByName(merged.select(*emitted.columns))
    return whole if until is None else whole.where(F.col("session_end") <= F.lit(until).cast("timestamp_ntz"))


def complete_hourly_counts(emitted: DataFrame, late: DataFrame) -> DataFrame:
    """The closed hourly windows that all rows give: late rows belong to closed windows alone and are added to them."""
    return (emitted.unionByName(late).groupBy("window_start", "window_end", "service", "level")
            .agg(F.sum("n_events").alias("n_events"), F.sum("n_5xx").alias("n_5xx")))
