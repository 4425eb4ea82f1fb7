"""Registered streaming queries (S1-S7, T1-T5) and their oracles.

Each query lands envelopes derived from the driver tables into a fresh folder
under the shared checkpoint location, runs the streaming job to completion
(``availableNow``) and returns the sink read back as a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..schemas import CUSTOMER_EVENT, SYSTEM_LOG, TRANSACTION_EVENT
from ..session import scratch_path
from ..sources import landing as S
from ..sources.landing import to_envelope
from ..streaming import compaction
from ..streaming import ingest as I
from ..streaming import once as O
from ..streaming import windows as W
from .catalog import L, query
from .oracle_ctes import with_ctes


def _fields(schema) -> str:
    return ", ".join(f.name for f in schema.fields)


def write_landing(envelopes, path: str) -> None:
    """Landed records are written once and read once: compressed."""
    S.write_landing(envelopes, path, compression="gzip")


def _land(layers, bronze_df, schema, deliveries: int = 1) -> str:
    path = scratch_path(layers.spark, "landing")
    env = to_envelope(bronze_df, schema)
    for _ in range(deliveries):
        write_landing(env, path)
    return path


@query("event_envelope", with_ctes(f"""
SELECT {_fields(TRANSACTION_EVENT)}, kinesis_sequence_number,
  COALESCE(customer_id, event_id, 'default') AS kinesis_partition_key
FROM bronze_transaction_events""", "bronze_transaction_events"))
def q_event_envelope(spark, sf_dir):
    """S7 then S2/S3 in batch: envelope every transaction event and decode it back."""
    layers = L(spark, sf_dir)
    env = to_envelope(layers.bronze.transaction_events, TRANSACTION_EVENT)
    decoded = I.decode(env, TRANSACTION_EVENT, layers.cfg)
    return I.valid_events(decoded, TRANSACTION_EVENT).drop("processed_at")


@query("stream_ingest_dedup", with_ctes(f"""
SELECT {_fields(CUSTOMER_EVENT)}, kinesis_sequence_number,
  COALESCE(customer_id, event_id, 'default') AS kinesis_partition_key
FROM bronze_customer_events""", "bronze_customer_events"))
def q_stream_ingest_dedup(spark, sf_dir):
    """Every customer event delivered twice; the stream must write each once."""
    layers = L(spark, sf_dir)
    landing = _land(layers, layers.bronze.customer_events, CUSTOMER_EVENT, deliveries=2)
    out = scratch_path(spark, "bronze")
    q = I.start_ingest(spark, landing, CUSTOMER_EVENT, f"{out}/table", f"{out}/_checkpoints", layers.cfg)
    q.await_all()
    return I.read_bronze(spark, f"{out}/table", CUSTOMER_EVENT).drop("processed_at")


def _in_runs(layers, bronze_df, schema, run, runs: int = 3) -> None:
    """Delivers the events in ``runs`` parts by their time, every tenth of them one part late; ``run(landing)`` after each."""
    seconds = F.unix_seconds(R.utc_instant("timestamp"))
    first, last = bronze_df.agg(F.min(seconds), F.max(seconds)).first()
    width = ((last or 0) - (first or 0)) // runs + 1
    straggler = F.when(F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0, 1).otherwise(0)
    part = F.coalesce(F.least(F.floor((seconds - (first or 0)) / width) + straggler, F.lit(runs - 1)), F.lit(0))
    landing = scratch_path(layers.spark, "landing")
    for n in range(runs):
        write_landing(to_envelope(bronze_df.where(part == n), schema), landing)
        run(landing)


def _session_run(layers) -> str:
    """Sessions of the customer events, streamed in three runs with late rows; the folder of results and checkpoint."""
    spark, out = layers.spark, scratch_path(layers.spark, "sessions")

    def run(landing):
        events = I.valid_events(I.decode(I.envelope_stream(spark, landing), CUSTOMER_EVENT, layers.cfg), CUSTOMER_EVENT)
        W.run_with_late_rows(spark, lambda mark: W.sessions_and_late_rows(spark, events, mark, layers.cfg.session_gap),
                             f"{out}/data", f"{out}/_ckpt")
    _in_runs(layers, layers.bronze.customer_events, CUSTOMER_EVENT, run)
    return out


def _whole_sessions(layers, out: str, until):
    spark = layers.spark
    return W.complete_sessions(W.arrived(spark, f"{out}/data", W.ON_TIME), W.arrived(spark, f"{out}/data", W.LATE),
                               W.open_sessions(spark, f"{out}/_ckpt"), until, layers.cfg.session_gap)


SESSIONS_SQL = """
SELECT customer_id, first_event AS session_start, last_event + INTERVAL 30 MINUTE AS session_end,
  n_events, first_event, last_event
FROM (
  SELECT customer_id, sid, COUNT(*) AS n_events, MIN(ts) AS first_event, MAX(ts) AS last_event
  FROM (
    SELECT customer_id, ts, SUM(new_session) OVER (PARTITION BY customer_id ORDER BY ts
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
    FROM (
      SELECT customer_id, ts,
        CASE WHEN LAG(ts) OVER (PARTITION BY customer_id ORDER BY ts) IS NULL
               OR ts - LAG(ts) OVER (PARTITION BY customer_id ORDER BY ts) > INTERVAL 30 MINUTE
             THEN 1 ELSE 0 END AS new_session
      FROM (SELECT customer_id, CAST(timestamp AS TIMESTAMP) AS ts FROM bronze_customer_events
            WHERE customer_id IS NOT NULL) e) g) s
  GROUP BY customer_id, sid) x"""


@query("stream_sessions", with_ctes(SESSIONS_SQL + """
WHERE last_event + INTERVAL 30 MINUTE <=
  (SELECT MAX(CAST(timestamp AS TIMESTAMP)) FROM bronze_customer_events WHERE customer_id IS NOT NULL)
  - INTERVAL 30 MINUTE""", "bronze_customer_events"))
def q_stream_sessions(spark, sf_dir):
    """30-minute-gap sessions per customer from the event stream, late rows merged in; closed sessions only."""
    layers = L(spark, sf_dir)
    out = _session_run(layers)
    return _whole_sessions(layers, out, W.closed_until(spark, f"{out}/_ckpt"))


@query("stream_sessions_with_open", with_ctes(SESSIONS_SQL, "bronze_customer_events"))
def q_stream_sessions_with_open(spark, sf_dir):
    """All sessions at the end of the stream: emitted ones, those open in the state store, and late rows account for every event."""
    layers = L(spark, sf_dir)
    return _whole_sessions(layers, _session_run(layers), None)


@query("stream_hourly_counts", with_ctes("""
SELECT window_start, window_end, service, level, n_events, n_5xx FROM (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
    service, level, COUNT(*) AS n_events, COUNT(CASE WHEN status_code >= 500 THEN 1 END) AS n_5xx
  FROM (SELECT service, level, status_code, CAST(timestamp AS TIMESTAMP) AS ts FROM bronze_system_logs) e
  GROUP BY 1, 2, 3, 4) w
WHERE window_end <= (SELECT MAX(CAST(timestamp AS TIMESTAMP)) FROM bronze_system_logs) - INTERVAL 1 HOUR""",
    "bronze_system_logs"))
def q_stream_hourly_counts(spark, sf_dir):
    """Hourly events and 5xx per service and level from the system-log stream, late rows added; closed windows only."""
    layers = L(spark, sf_dir)
    out = scratch_path(spark, "hourly")

    def run(landing):
        logs = I.valid_events(I.decode(I.envelope_stream(spark, landing), SYSTEM_LOG, layers.cfg), SYSTEM_LOG)
        W.run_with_late_rows(spark, lambda mark: W.hourly_counts_and_late_rows(spark, logs, mark), f"{out}/data", f"{out}/_ckpt")
    _in_runs(layers, layers.bronze.system_logs, SYSTEM_LOG, run)
    return W.complete_hourly_counts(W.arrived(spark, f"{out}/data", W.ON_TIME), W.arrived(spark, f"{out}/data", W.LATE))


@query("bronze_stream_and_batch", with_ctes(f"""
SELECT {_fields(TRANSACTION_EVENT)} FROM bronze_transaction_events""", "bronze_transaction_events"))
def q_bronze_stream_and_batch(spark, sf_dir):
    """One table written by the stream, then in batch, then by the stream again; every row reads back."""
    layers = L(spark, sf_dir)
    events = layers.bronze.transaction_events
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    out, landing = scratch_path(spark, "bronze"), scratch_path(spark, "landing")
    for part in range(3):
        rows = events.where(third == part)
        if part == 1:
            I.append_bronze(rows, f"{out}/table", TRANSACTION_EVENT)
        else:
            write_landing(to_envelope(rows, TRANSACTION_EVENT), landing)
            I.start_ingest(spark, landing, TRANSACTION_EVENT, f"{out}/table", f"{out}/_checkpoints", layers.cfg).await_all()
    return I.read_bronze(spark, f"{out}/table", TRANSACTION_EVENT).select(*[f.name for f in TRANSACTION_EVENT.fields])


@query("stream_ingest_once", with_ctes(f"""
SELECT {_fields(CUSTOMER_EVENT)}, kinesis_sequence_number,
  COALESCE(customer_id, event_id, 'default') AS kinesis_partition_key
FROM bronze_customer_events""", "bronze_customer_events"))
def q_stream_ingest_once(spark, sf_dir):
    """Every customer event delivered, and all of them again to a later run: beyond any watermark, each is written once."""
    layers = L(spark, sf_dir)
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    env = to_envelope(layers.bronze.customer_events, CUSTOMER_EVENT)
    for _ in range(2):
        write_landing(env, landing)
        O.ingest_once(spark, landing, CUSTOMER_EVENT, f"{out}/table", f"{out}/_checkpoints", layers.cfg)
    return I.read_bronze(spark, f"{out}/table", CUSTOMER_EVENT).drop("processed_at")


@query("bronze_drift", with_ctes("""
SELECT 'referrer' AS field, 'string' AS value_type, COUNT(*) AS records FROM bronze_customer_events WHERE event_id LIKE '%7'
UNION ALL
SELECT 'visit', CASE WHEN event_id LIKE '%77' THEN 'string' ELSE 'number' END, COUNT(*)
FROM bronze_customer_events WHERE event_id LIKE '%7' GROUP BY 2""", "bronze_customer_events"))
def q_bronze_drift(spark, sf_dir):
    """Producers add two fields to some events, one of them of changing type; the ingest keeps and reports them."""
    layers = L(spark, sf_dir)
    env = to_envelope(layers.bronze.customer_events, CUSTOMER_EVENT)
    parsed = F.from_json("data", CUSTOMER_EVENT)
    visit = F.when(parsed["event_id"].endswith("77"), F.lit('"often"')).otherwise(F.lit("3"))
    more = F.concat(F.lit('"referrer":"a page","visit":'), visit, F.lit(","), F.substring("data", 2, 1 << 30))
    landed = env.withColumn("data", F.when(parsed["event_id"].endswith("7"), F.concat(F.lit("{"), more)).otherwise(F.col("data")))
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    write_landing(landed, landing)
    I.start_ingest(spark, landing, CUSTOMER_EVENT, f"{out}/table", f"{out}/_checkpoints", layers.cfg).await_all()
    return I.drift_report(I.read_unknown(spark, f"{out}/table", CUSTOMER_EVENT)).drop("first_seen")


@query("stream_compaction", with_ctes(f"""
SELECT {_fields(CUSTOMER_EVENT)} FROM bronze_customer_events""", "bronze_customer_events"))
def q_stream_compaction(spark, sf_dir):
    """Half of the events streamed, compacted, then the other half streamed and compacted; every row reads back once."""
    layers = L(spark, sf_dir)
    events = layers.bronze.customer_events
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    out, landing = scratch_path(spark, "bronze"), scratch_path(spark, "landing")
    for part in range(2):
        write_landing(to_envelope(events.where(half == part), CUSTOMER_EVENT), landing)
        I.start_ingest(spark, landing, CUSTOMER_EVENT, f"{out}/table", f"{out}/_checkpoints", layers.cfg, max_files_per_trigger=4).await_all()
        compaction.compact(spark, f"{out}/table", I.sink_schema(CUSTOMER_EVENT), part)
    return I.read_bronze(spark, f"{out}/table", CUSTOMER_EVENT).select(*[f.name for f in CUSTOMER_EVENT.fields])
