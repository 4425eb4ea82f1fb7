"""Streaming bronze ingest.

landing JSON envelopes --readStream--> decode payload --> dedup --> one Parquet table per stream,
partitioned by record_status (valid | quarantined)

* Offsets live in the checkpoint, so each run reads only new files and the
  Parquet file sink commits exactly once (the reference re-read every stream
  from the start on each run and appended it again).
* Malformed envelopes or payloads, rows without event_id and rows whose
  timestamp does not parse are quarantined (with a reason) instead of failing
  the run. Valid and quarantined rows leave in ONE query through one
  exactly-once file sink partitioned by ``record_status``: every record is
  parsed once and both outputs commit together. ``read_bronze`` and
  ``read_quarantine`` read the two parts through the sink's commit log.
* Re-delivered records (same event_id and same payload) are dropped with
  ``dropDuplicatesWithinWatermark`` on (event_id, 64-bit payload hash). Two
  different payloads under one event_id are both kept and reported by the
  bronze validation (DQ1), as in the reference. The watermark is on arrival
  time, not event time, so an event with an old timestamp is never discarded
  as late; state holds the keys seen within ``cfg.dedup_watermark`` of arrival.
  Re-deliveries arriving later than that are kept and reported by DQ1.
* Fields that a producer adds to its payload don't change the declared columns;
  they are kept beside them as a variant (``read_unknown``), and
  ``drift_report`` tells which there are, of which types and since when.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..config import PipelineConfig
from ..functions import rules as R
from ..schemas import ENVELOPE, STREAMS, with_lineage
from ..session import path_exists
from . import compaction

CORRUPT_ENVELOPE = "_corrupt_record"
CORRUPT_PAYLOAD = "_corrupt_payload"
PAYLOAD_HASH = "_payload_hash"
UNKNOWN = "unknown_fields"  # what a payload holds beside its declared fields

QUARANTINE_SCHEMA_COLUMNS = ("partition_key", "sequence_number", "data", "raw_record", "reason", "processed_at")


def envelope_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landing folder as a stream of envelopes (declared schema, no inference)."""
    schema = T.StructType(list(ENVELOPE.fields) + [T.StructField(CORRUPT_ENVELOPE, T.StringType())])
    reader = (spark.readStream.schema(schema)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_ENVELOPE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir)


def envelopes_from_records(records: DataFrame, key: str = "key", value: str = "value",
                           sequence: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """Any record stream with a key, a payload and position columns (for example a
    Kafka source: binary key/value, partition, offset) as envelopes. The sequence
    number is the position columns joined with '-'."""
    seq = F.concat_ws("-", *[F.col(c).cast("string") for c in sequence])
    return records.select(F.col(key).cast("string").alias("partition_key"), seq.alias("sequence_number"),
                          F.col(value).cast("string").alias("data"))


def decode(envelopes: DataFrame, payload_schema: T.StructType, cfg: PipelineConfig = C.DEFAULT,
           per_batch_time: bool = False) -> DataFrame:
    """S2 + S3: parse the payload, add lineage columns, flag invalid rows.

    Works on batch and streaming DataFrames alike. ``processed_at`` is the run
    timestamp, or, for a query that keeps running (``per_batch_time``), the time
    of each micro-batch in UTC.
    """
    processed_at = (F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
                    if per_batch_time else F.lit(cfg.run_ts_string()))
    parse_schema = T.StructType(list(payload_schema.fields) + [T.StructField(CORRUPT_PAYLOAD, T.StringType())])
    p = F.from_json("data", parse_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_PAYLOAD})
    if CORRUPT_ENVELOPE not in envelopes.columns:
        envelopes = envelopes.withColumn(CORRUPT_ENVELOPE, F.lit(None).cast("string"))
    names = F.array(*[F.lit(f.name) for f in payload_schema.fields])
    added = F.size(F.array_except(F.json_object_keys("data"), names)) > 0  # a scan of the keys; values are parsed where there are any
    unknown = F.when(added, F.to_variant_object(F.map_filter(
        F.from_json("data", "map<string,variant>"), lambda k, _: ~F.array_contains(names, k))))
    parsed = envelopes.select("partition_key", "sequence_number", "data", CORRUPT_ENVELOPE, p.alias("p"), unknown.alias(UNKNOWN))
    fields = [F.col(f"p.{f.name}").alias(f.name) for f in payload_schema.fields]
    reason = (F.when(F.col(CORRUPT_ENVELOPE).isNotNull(), "malformed envelope")
              .when(F.col("data").isNull(), "missing payload")
              .when(F.col(f"p.{CORRUPT_PAYLOAD}").isNotNull(), "malformed payload")
              .when(F.col("p.event_id").isNull(), "missing event_id")
              .when(R.utc_instant(F.col("p.timestamp")).isNull(), "bad timestamp"))
    return parsed.select(
        *fields,
        F.col("sequence_number").alias("kinesis_sequence_number"),
        F.col("partition_key").alias("kinesis_partition_key"),
        processed_at.alias("processed_at"),
        "partition_key", "sequence_number", "data",
        F.col(CORRUPT_ENVELOPE).alias("raw_record"),
        reason.alias("reason"),
        F.when(reason.isNull(), F.col(UNKNOWN)).alias(UNKNOWN),
    )


RECORD_STATUS = "record_status"
VALID, QUARANTINED = "valid", "quarantined"


def valid_events(decoded: DataFrame, payload_schema: T.StructType, with_payload_hash: bool = False) -> DataFrame:
    bronze_cols = [f.name for f in with_lineage(payload_schema).fields]
    extra = [F.xxhash64("data").alias(PAYLOAD_HASH)] if with_payload_hash else []
    return decoded.where(F.col("reason").isNull()).select(*bronze_cols, *extra)


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull()).select(*QUARANTINE_SCHEMA_COLUMNS)


def deduplicate(events: DataFrame, delay: str) -> DataFrame:
    """Drop records whose (event_id, payload hash) arrived within ``delay`` before.

    ``events`` carries the hash column (``valid_events(..., with_payload_hash=True)``
    or ``ingest_rows``).
    """
    return (events.withColumn("_arrival", F.current_timestamp())
            .withWatermark("_arrival", delay)
            .dropDuplicatesWithinWatermark(["event_id", PAYLOAD_HASH])
            .drop("_arrival", PAYLOAD_HASH))


def ingest_rows(decoded: DataFrame, payload_schema: T.StructType) -> DataFrame:
    """Bronze columns + quarantine columns + record_status, ready for one sink.

    Valid rows keep their parsed fields and drop the raw text; quarantined rows
    keep the raw text and the reason. The dedup key hashes the raw record, so
    only byte-identical re-deliveries collapse.
    """
    bronze_cols = [f.name for f in with_lineage(payload_schema).fields]
    ok = F.col("reason").isNull()
    return decoded.select(
        *bronze_cols,
        F.when(~ok, F.col("partition_key")).alias("q_partition_key"),
        F.when(~ok, F.col("sequence_number")).alias("q_sequence_number"),
        F.when(~ok, F.col("data")).alias("q_data"),
        F.col("raw_record").alias("q_raw_record"),
        F.col("reason").alias("q_reason"),
        UNKNOWN,
        F.when(ok, VALID).otherwise(QUARANTINED).alias(RECORD_STATUS),
        F.xxhash64("data", "raw_record").alias(PAYLOAD_HASH))


# A bronze table has one folder per writer. The stream's is read through its commit
# log, which hides files that others put there; so the batch append has its own.
STREAM, BATCH, ONCE = compaction.STREAM, "batch", "once"  # ONCE: see streaming.once


def sink_schema(payload_schema: T.StructType) -> T.StructType:
    """Columns of the stream's sink."""
    rest = [f"q_{c}" for c in QUARANTINE_SCHEMA_COLUMNS if c != "processed_at"]
    return T.StructType([*with_lineage(payload_schema).fields, *[T.StructField(c, T.StringType()) for c in rest],
                         T.StructField(UNKNOWN, T.VariantType()), T.StructField(RECORD_STATUS, T.StringType())])


def _part(spark: SparkSession, root: str, part: str, schema: T.StructType) -> DataFrame:
    """One writer's folder with its declared schema; no rows where nothing was written yet."""
    path = f"{root}/{part}"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _streamed(spark: SparkSession, root: str, payload_schema: T.StructType) -> DataFrame:
    schema = sink_schema(payload_schema)
    parts = [compaction.unmerged(spark, root, schema), compaction.merged(spark, root, schema), _part(spark, root, ONCE, schema).select(*schema.fieldNames())]
    return reduce(DataFrame.unionByName, parts)


def read_bronze(spark: SparkSession, root: str, payload_schema: T.StructType) -> DataFrame:
    """The valid records of an ingest table, streamed and appended in batch."""
    cols = [f.name for f in with_lineage(payload_schema).fields]
    streamed = _streamed(spark, root, payload_schema).where(F.col(RECORD_STATUS) == VALID)
    return streamed.select(*cols).unionByName(_part(spark, root, BATCH, with_lineage(payload_schema)).select(*cols))


def read_quarantine(spark: SparkSession, root: str, payload_schema: T.StructType) -> DataFrame:
    """The rejected records of an ingest table, with their reason."""
    rows = _streamed(spark, root, payload_schema).where(F.col(RECORD_STATUS) == QUARANTINED)
    return rows.select(*[F.col(f"q_{c}").alias(c) for c in QUARANTINE_SCHEMA_COLUMNS if c != "processed_at"], "processed_at")


def read_unknown(spark: SparkSession, root: str, payload_schema: T.StructType) -> DataFrame:
    """(event_id, processed_at, unknown_fields) of the valid records that hold fields beyond the declared ones."""
    rows = _streamed(spark, root, payload_schema).where((F.col(RECORD_STATUS) == VALID) & F.col(UNKNOWN).isNotNull())
    return rows.select("event_id", "processed_at", UNKNOWN)


def drift_report(unknown: DataFrame) -> DataFrame:
    """(field, value_type, records, first_seen): the fields that ``read_unknown`` found, one row a type.

    One pass over the drifted records alone; a task keeps one counter a field and type. Types are
    JSON's (object, array, string, number, boolean, null): stored variants don't keep apart whole
    and decimal numbers. ``drift_schema`` has the inner types.
    """
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    json_type = (F.when(kind.isin("OBJECT", "ARRAY", "STRING", "BOOLEAN"), F.lower(kind)).when(kind == "VOID", "null").otherwise("number"))
    fields = unknown.lateralJoin(unknown.sparkSession.tvf.variant_explode(F.col(UNKNOWN).outer()))
    return fields.groupBy(F.col("key").alias("field"), json_type.alias("value_type")).agg(
        F.count(F.lit(1)).alias("records"), F.min("processed_at").alias("first_seen"))


def drift_schema(unknown: DataFrame) -> DataFrame:
    """One row: the number of drifted records, and the merged schema of their unknown fields (null if there are none)."""
    return unknown.agg(F.count(F.lit(1)).alias("records"), F.schema_of_variant_agg(UNKNOWN).alias("unknown_schema")).select(
        "records", F.when(F.col("records") > 0, F.col("unknown_schema")).alias("unknown_schema"))


def append_bronze(df: DataFrame, root: str, payload_schema: T.StructType) -> None:
    """Batch form of the bronze sink (S4): append events to an ingest table."""
    df.select(*[f.name for f in with_lineage(payload_schema).fields]).write.mode("append").parquet(f"{root}/{BATCH}")


@dataclass
class IngestQuery:
    query: StreamingQuery
    seen: dict[int, tuple[int, int]] = field(default_factory=dict)  # batch id -> records read, quarantined

    def await_all(self) -> None:
        while not self.query.awaitTermination(1):  # Spark keeps the last progress reports only: gather them on the way
            self.counts()

    def counts(self) -> dict[str, int]:
        """Records read and quarantined by this run (observed per micro-batch).

        An error if reports were lost, so that a count is never too low.
        """
        for p in self.query.recentProgress:
            m = (p.get("observedMetrics") or {}).get("ingest")  # a Row per batch
            if m is not None:
                self.seen[p["batchId"]] = (int(m["records"] or 0), int(m["quarantined"] or 0))
        if self.seen and len(self.seen) != max(self.seen) - min(self.seen) + 1:
            raise RuntimeError("progress reports of some micro-batches were dropped before they were read")
        return {"records_read": sum(r for r, _ in self.seen.values()), "records_quarantined": sum(q for _, q in self.seen.values())}


def start_ingest(spark: SparkSession, landing_dir: str | None, payload_schema: T.StructType, table_root: str,
                 checkpoint_dir: str, cfg: PipelineConfig = C.DEFAULT,
                 available_now: bool = True, processing_time: str | None = None,
                 max_files_per_trigger: int | None = None, envelopes: DataFrame | None = None,
                 retention: str | None = None) -> IngestQuery:
    """S1-S6 for one stream: one query, exactly-once into ``table_root``/stream (Parquet,
    partitioned by record_status).

    The source is the landing folder, or any streaming DataFrame of envelopes
    (``envelopes``, e.g. from ``envelopes_from_records``). ``available_now``
    processes everything available and stops (the hourly run, T1);
    ``processing_time="1 hour"`` keeps the query running instead. ``retention``
    ("30d") lets the sink's log forget older files; it must be much longer than
    the time between two runs of ``compaction.compact``, which takes their rows over.
    """
    source = envelopes if envelopes is not None else envelope_stream(spark, landing_dir, max_files_per_trigger)
    decoded = decode(source, payload_schema, cfg, per_batch_time=not available_now).observe(
        "ingest", F.count(F.lit(1)).alias("records"),
        F.count(F.when(F.col("reason").isNotNull(), 1)).alias("quarantined"))
    rows = deduplicate(ingest_rows(decoded, payload_schema), cfg.dedup_watermark)
    w = (rows.writeStream.format("parquet").option("path", f"{table_root}/{STREAM}")
         .option("checkpointLocation", checkpoint_dir).partitionBy(RECORD_STATUS).outputMode("append"))
    w = w.option("retention", retention) if retention else w
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 hour")
    return IngestQuery(w.start())


def ingest_all(spark: SparkSession, landing_root: str, bronze_root: str, checkpoint_root: str,
               cfg: PipelineConfig = C.DEFAULT, streams: dict | None = None,
               counts: dict | None = None, max_files_per_trigger: int | None = None) -> dict[str, str]:
    """One independent ingest per stream; landing_root/<stream>/ -> bronze_root/<table>/.

    All streams are started, then awaited; a failing stream does not stop the
    others, and every failure is raised together at the end. Returns the
    table root of each stream (read it with ``read_bronze``); ``counts`` (if
    given) receives per-table records read and quarantined (D3).
    ``max_files_per_trigger`` bounds a micro-batch, and with it the dedup state, on a backlog.
    """
    streams = streams or STREAMS
    running: dict[str, IngestQuery] = {}
    paths: dict[str, str] = {}
    errors: dict[str, str] = {}
    for stream_name, (table, schema) in streams.items():
        paths[table] = f"{bronze_root}/{table}"
        try:
            running[table] = start_ingest(spark, f"{landing_root}/{stream_name}", schema, paths[table],
                                          f"{checkpoint_root}/{table}", cfg,
                                          max_files_per_trigger=max_files_per_trigger)
        except Exception as e:  # noqa: BLE001
            errors[table] = str(e)
    for table, q in running.items():
        try:
            q.await_all()
            if counts is not None:
                counts[table] = q.counts()
        except Exception as e:  # noqa: BLE001
            errors[table] = str(e)
    if errors:
        raise RuntimeError(f"ingest failed for {sorted(errors)}: {errors}")
    return paths
