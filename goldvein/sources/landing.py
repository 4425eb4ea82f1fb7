"""Record envelopes and the landing folder that the streaming ingest reads.

A stream record is (partition key, sequence number, JSON payload). S7 turns
event rows into envelopes; ``write_landing`` lands them as JSON-lines files,
one file per key range, the way a stream service hands out shard batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_envelope(events: DataFrame, payload_schema: T.StructType,
                sequence_col: str = "kinesis_sequence_number",
                key_cols: tuple[str, ...] = ("customer_id", "event_id")) -> DataFrame:
    """Serialise each event to JSON with its partition key.

    The key is the first non-NULL of ``key_cols`` (customer, else event id,
    else 'default'), so one customer's events stay in one shard/partition.
    """
    present = [c for c in key_cols if c in events.columns]
    key = F.coalesce(*[F.col(c) for c in present], F.lit("default"))
    payload = F.to_json(F.struct(*[F.col(f.name) for f in payload_schema.fields]))
    return events.select(key.alias("partition_key"),
                         F.col(sequence_col).cast("string").alias("sequence_number"),
                         payload.alias("data"))


def write_landing(envelopes: DataFrame, path: str, shards: int | None = None, compression: str = "none") -> None:
    """Append one batch of records, one file per shuffle partition (sized by the session and
    AQE from the data) or exactly ``shards`` files.

    Every record repeats the field names, so "gzip" files take a tenth of the disk; a file is
    then read by one task. Readers tell by the file's name.

    Files are ranges of (partition key, sequence number): each key's records
    stay contiguous and in sequence order, and a key holding a large share of
    the batch is split over several files instead of filling one.
    """
    keys = ("partition_key", "sequence_number")
    ranged = envelopes.repartitionByRange(shards, *keys) if shards else envelopes.repartitionByRange(*keys)
    (ranged.write.mode("append").option("compression", compression).json(path))
