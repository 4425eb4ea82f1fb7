"""Bronze ingest that drops a re-delivery whenever it comes.

``ingest.deduplicate`` forgets a record once the watermark has passed it; here
the keys of all records ever written, (event_id, payload hash), are kept in a
table beside the data, in folders by a hash of the event id. Each micro-batch
is held against it: its own keys are few, so they pick the ones already known
out of the table in one scan of two narrow columns, and the records not among
those are written.

Every folder carries the number of its micro-batch and is overwritten as a
whole, first the records, then their keys; a batch only looks at keys of
batches before it. So a micro-batch that is run again after a crash writes what
it wrote before.

``keep_days`` lets keys go that are older than that many days before the run,
for streams whose producers promise as much; by default none go.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..config import PipelineConfig
from ..session import path_exists
from . import ingest as I

KEYS, BUCKETS = "keys", 16
KEY = ("event_id", I.PAYLOAD_HASH)
KEY_SCHEMA = "event_id string, _payload_hash long, arrived date, bucket int, batch long"


def _bucket() -> F.Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(BUCKETS)).cast("int")


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_batch(rows: DataFrame, batch: int, table_root: str, cfg: PipelineConfig = C.DEFAULT, keep_days: int | None = None) -> None:
    """Writes the records of one micro-batch (``ingest.ingest_rows``) that no earlier batch brought, and their keys.

    Rejected records have no event id; their key is the hash of the raw record.
    """
    spark = rows.sparkSession
    new = rows
    path = f"{table_root}/{KEYS}"
    if path_exists(spark, path):
        known = spark.read.schema(KEY_SCHEMA).parquet(path).where(F.col("batch") < batch)
        if keep_days is not None:
            known = known.where(F.col("arrived") >= F.lit((cfg.as_of - timedelta(days=keep_days)).isoformat()).cast("date"))
        same = F.col("k.event_id").eqNullSafe(F.col("b.event_id")) & (F.col(f"k.{I.PAYLOAD_HASH}") == F.col(f"b.{I.PAYLOAD_HASH}"))
        again = known.select(*KEY).alias("k").join(new.select(*KEY).alias("b"), same, "left_semi").distinct()
        same = F.col("k.event_id").eqNullSafe(F.col("b.event_id")) & (F.col(f"k.{I.PAYLOAD_HASH}") == F.col(f"b.{I.PAYLOAD_HASH}"))
        new = new.alias("b").join(again.alias("k"), same, "left_anti")
    new = new.dropDuplicates(list(KEY))  # last: what is already known isn't shuffled again
    # the batch's folder is there even if nothing new came, so that a rerun replaces it
    number = F.lit(batch).cast("long")
    _overwrite(new.drop(I.PAYLOAD_HASH).withColumn("batch", number), f"{table_root}/{I.ONCE}", "batch", I.RECORD_STATUS)
    written = new.select(*KEY, F.lit(cfg.as_of.isoformat()).cast("date").alias("arrived"), _bucket().alias("bucket"), number.alias("batch"))
    _overwrite(written.hint("rebalance", "bucket"), path, "bucket", "batch")


def ingest_once(spark: SparkSession, landing_dir: str | None, payload_schema: T.StructType, table_root: str, checkpoint_dir: str,
                cfg: PipelineConfig = C.DEFAULT, max_files_per_trigger: int | None = None, envelopes: DataFrame | None = None,
                keep_days: int | None = None) -> None:
    """S1-S6 for what is available now; every record ends once in ``table_root``, however late it is sent again.

    ``ingest.read_bronze`` and ``ingest.read_quarantine`` read the result.
    """
    source = envelopes if envelopes is not None else I.envelope_stream(spark, landing_dir, max_files_per_trigger)
    rows = I.ingest_rows(I.decode(source, payload_schema, cfg), payload_schema)

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()  # read for the keys and for the records
        try:
            write_batch(held, number, table_root, cfg, keep_days)
        finally:
            held.unpersist()

    rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start().awaitTermination()
