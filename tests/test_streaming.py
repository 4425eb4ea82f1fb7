"""Streaming ingest on landed files: malformed line, repeated file, old event, re-run."""

import glob
import os
import shutil

from pyspark.sql import functions as F

from goldvein.config import PipelineConfig
from goldvein.functions import rules as R
from goldvein.schemas import CUSTOMER_EVENT
from goldvein.sources.driver_tables import load_bronze
from goldvein.sources.landing import to_envelope, write_landing
from goldvein.streaming import ingest as I

from .conftest import SF_SMALL

CFG = PipelineConfig()


def land(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    bronze = load_bronze(spark, SF_SMALL).customer_events
    write_landing(to_envelope(bronze, CUSTOMER_EVENT), landing, 3)
    files = sorted(glob.glob(os.path.join(landing, "*.json")))
    shutil.copy(files[0], os.path.join(landing, "repeated-delivery.json"))
    with open(os.path.join(landing, "extra.json"), "w") as f:
        f.write('{"partition_key": "k", "sequence_number": "1", "data": "{not json"}\n')
        f.write('this line is not an envelope\n')
        f.write('{"partition_key": "old", "sequence_number": "2", "data": '
                '"{\\"event_id\\": \\"ce_old\\", \\"timestamp\\": \\"2020-01-01T00:00:00\\", '
                '\\"customer_id\\": \\"cust_1\\"}"}\n')
    return landing, bronze


def run(spark, landing, out):
    q = I.start_ingest(spark, landing, CUSTOMER_EVENT, f"{out}/table", f"{out}/_ckpt", CFG)
    q.await_all()
    run.last_counts = q.counts()
    return I.read_bronze(spark, f"{out}/table", CUSTOMER_EVENT), I.read_quarantine(spark, f"{out}/table", CUSTOMER_EVENT)


def test_ingest_quarantine_dedup_late_and_rerun(spark, tmp_dir):
    landing, bronze = land(spark, tmp_dir)
    out = os.path.join(tmp_dir, "out")
    got, bad = run(spark, landing, out)
    n_src = bronze.count()
    assert got.count() == n_src + 1  # every event once, plus the old-timestamp event
    assert got.where(F.col("event_id") == "ce_old").count() == 1
    assert got.select("event_id").distinct().count() == n_src + 1
    assert sorted(r.reason for r in bad.collect()) == ["malformed envelope", "malformed payload"]
    lines = sum(sum(1 for _ in open(f)) for f in glob.glob(os.path.join(landing, "*.json")))
    assert run.last_counts == {"records_read": lines, "records_quarantined": 2}
    assert set(r.processed_at for r in got.select("processed_at").distinct().collect()) == {CFG.run_ts_string()}
    # second run over the same folder: offsets say nothing is new
    got2, bad2 = run(spark, landing, out)
    assert got2.count() == n_src + 1 and bad2.count() == 2
    # batch decode of the same files gives the same bronze rows
    env = spark.read.schema(I.envelope_stream(spark, landing).schema).json(landing)
    batch = I.valid_events(I.decode(env, CUSTOMER_EVENT, CFG), CUSTOMER_EVENT).distinct()
    assert batch.exceptAll(got).count() == 0 and got.exceptAll(batch).count() == 0


def test_distinct_payloads_with_same_id_are_kept(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as f:
        for amount in ("1", "2", "2"):
            f.write('{"partition_key": "k", "sequence_number": "1", "data": "{\\"event_id\\": \\"e1\\", '
                    '\\"timestamp\\": \\"2024-01-01T00:00:00\\", \\"action\\": \\"' + amount + '\\"}"}\n')
    got, _ = run(spark, landing, os.path.join(tmp_dir, "out"))
    assert sorted(r.action for r in got.collect()) == ["1", "2"]


def test_record_stream_adapter(spark):
    recs = spark.createDataFrame(
        [(b"cust_1", b'{"event_id": "e1", "timestamp": "2024-01-01T00:00:00", "customer_id": "cust_1"}', 0, 7),
         (None, b"garbage", 1, 8)], "key binary, value binary, partition int, offset bigint")
    dec = I.decode(I.envelopes_from_records(recs), CUSTOMER_EVENT, CFG)
    good = I.valid_events(dec, CUSTOMER_EVENT).first()
    assert (good.event_id, good.kinesis_sequence_number, good.kinesis_partition_key) == ("e1", "0-7", "cust_1")
    assert [r.reason for r in I.quarantined(dec).collect()] == ["malformed payload"]


def test_processing_time_trigger_keeps_running(spark, tmp_dir):
    landing, bronze = land(spark, tmp_dir)
    out = os.path.join(tmp_dir, "out")
    q = I.start_ingest(spark, landing, CUSTOMER_EVENT, f"{out}/table", f"{out}/_ckpt", CFG,
                       available_now=False, processing_time="1 second")
    try:
        q.query.processAllAvailable()
        assert q.query.isActive
        assert I.read_bronze(spark, f"{out}/table", CUSTOMER_EVENT).count() == bronze.count() + 1
    finally:
        q.query.stop()


def test_unknown_payload_fields_do_not_change_the_schema(spark):
    env = spark.createDataFrame(
        [("k", "1", '{"event_id": "e1", "timestamp": "2024-01-01T00:00:00", "brand_new_field": [1, 2]}'),
         ("k", "2", '{"event_id": "e2", "timestamp": "2024-01-01T00:00:00", "rating": null}')],
        "partition_key string, sequence_number string, data string")
    from goldvein.schemas import BRONZE_SCHEMAS, PRODUCT_EVENT
    out = I.valid_events(I.decode(env, PRODUCT_EVENT, CFG), PRODUCT_EVENT)
    shape = lambda s: [(f.name, f.dataType) for f in s.fields]
    assert shape(out.schema) == shape(BRONZE_SCHEMAS["bronze_product_events"]) and out.count() == 2


def test_batch_and_stream_rows_both_read_back_in_either_order(spark, tmp_dir):
    bronze = load_bronze(spark, SF_SMALL).customer_events
    for order in ("batch first", "stream first"):
        out, landing = os.path.join(tmp_dir, order, "table"), os.path.join(tmp_dir, order, "landing")
        write_landing(to_envelope(bronze, CUSTOMER_EVENT), landing, 2)
        steps = [lambda: I.append_bronze(bronze, out, CUSTOMER_EVENT),
                 lambda: I.start_ingest(spark, landing, CUSTOMER_EVENT, out, f"{out}-ckpt", CFG).await_all()]
        for step in steps if order == "batch first" else steps[::-1]:
            step()
        assert I.read_bronze(spark, out, CUSTOMER_EVENT).count() == 2 * bronze.count()
    assert I.read_bronze(spark, f"{tmp_dir}/nothing", CUSTOMER_EVENT).count() == 0


def test_counts_over_more_batches_than_reports_are_kept(spark, tmp_dir):
    bronze = load_bronze(spark, SF_SMALL).customer_events
    landing, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "out")
    write_landing(to_envelope(bronze, CUSTOMER_EVENT), landing, 5)
    q = I.start_ingest(spark, landing, CUSTOMER_EVENT, f"{out}/t", f"{out}/c", CFG, max_files_per_trigger=1)
    q.await_all()
    assert q.counts() == {"records_read": bronze.count(), "records_quarantined": 0} and len(q.seen) > 2


def test_zoned_and_date_only_timestamps(spark):
    texts = ["2024-01-01T05:00:00", "2024-01-01T05:00:00Z", "2024-01-01T05:00:00+02:00", "2024-01-01", "2024-03-10 02:30:00", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = df.select("t", R.to_ts("t", tolerant=True).cast("string").alias("ntz"), R.utc_instant("t").cast("long").alias("s"),
                             R.hour_start(R.to_ts("t", tolerant=True)).cast("string").alias("h")).collect()
            assert [r.ntz for r in rows] == ["2024-01-01 05:00:00"] * 3 + ["2024-01-01 00:00:00", "2024-03-10 02:30:00", None, None]
            assert [r.s for r in rows] == [1704085200] * 3 + [1704067200, 1710037800, None, None]
            assert rows[4].h == "2024-03-10 02:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


SESSION_ROWS = "customer_id string, timestamp string"


def _runs(spark, root, runs, watermark_moves=None):
    """Streams each list of (customer, time) as one run; (emitted, late, open, until)."""
    from goldvein.streaming import windows as W
    for n, rows in enumerate(runs):
        spark.createDataFrame(rows, SESSION_ROWS).coalesce(1).write.mode("append").json(f"{root}/in")
        if watermark_moves:
            watermark_moves(n)
        events = spark.readStream.schema(SESSION_ROWS).json(f"{root}/in")
        W.run_with_late_rows(spark, lambda mark: W.sessions_and_late_rows(spark, events, mark), f"{root}/out", f"{root}/ckpt")
    return (W.arrived(spark, f"{root}/out", W.ON_TIME), W.arrived(spark, f"{root}/out", W.LATE), W.open_sessions(spark, f"{root}/ckpt"),
            W.closed_until(spark, f"{root}/ckpt"))


def _brute(rows, until=None):
    """{(customer, first, last, events)} by going through each customer's events in order."""
    from collections import defaultdict
    from datetime import datetime, timedelta
    gap, by, found = timedelta(minutes=30), defaultdict(list), set()
    for c, t in rows:
        if c is not None and t is not None:
            by[c].append(datetime.fromisoformat(t))
    for c, times in by.items():
        session = []
        for t in sorted(times) + [datetime.max]:
            if session and (t == datetime.max or t - session[-1] > gap):
                if until is None or session[-1] + gap <= until:
                    found.add((c, session[0], session[-1], len(session)))
                session = []
            session.append(t)
    return found


def _rows(df):
    rows = df.collect()
    assert all(r.session_start == r.first_event for r in rows)
    found = {(r.customer_id, r.first_event, r.last_event, r.n_events) for r in rows}
    assert len(found) == len(rows)
    return found


def test_late_rows_are_kept_aside_and_merged_by_key(spark, tmp_dir):
    from goldvein.streaming import windows as W
    runs = [
        [("a", "2024-01-01T10:00:00"), ("a", "2024-01-01T10:10:00"), ("b", "2024-01-01T12:00:00"), (None, "2024-01-01T12:00:00"), ("c", None)],
        # bridges a's session to nothing, b's first open session; extends a's; a second one; a repeated row; one on the watermark itself
        [("a", "2024-01-01T10:35:00"), ("a", "2024-01-01T09:00:00"), ("a", "2024-01-01T09:00:00"), ("b", "2024-01-01T11:31:00"),
         ("d", "2024-01-01T11:30:00"), ("e", "2024-01-01T18:00:00")],
        [("a", "2024-01-01T09:25:00"), ("a", "2024-01-01T09:50:00"), ("e", "2024-01-01T17:35:00"), ("f", "2024-01-01T17:45:00")],
    ]
    everything = [r for part in runs for r in part]
    emitted, late, still_open, until = _runs(spark, tmp_dir, runs)
    counted = [r[0] or 0 for df in (emitted, late, still_open) for r in df.selectExpr("sum(n_events)").collect()]
    assert sum(counted) == sum(c is not None and t is not None for c, t in everything) and all(counted)
    assert _rows(W.complete_sessions(emitted, late, still_open, None)) == _brute(everything)
    assert _rows(W.complete_sessions(emitted, late, still_open, until)) == _brute(everything, until)


def test_late_rows_at_random(spark, tmp_dir):
    import random
    from goldvein.streaming import windows as W
    rng, runs = random.Random(7), []
    for n in range(3):
        at = [rng.randint(0, 1440) if rng.random() < 0.3 else 480 * n + rng.randint(0, 480) for _ in range(150)]
        runs.append([("hot" if rng.random() < 0.3 else f"k{rng.randint(0, 12)}", f"2024-01-0{1 + m // 1440}T{m % 1440 // 60:02}:{m % 60:02}:00") for m in at])
    everything = [r for part in runs for r in part]
    emitted, late, still_open, until = _runs(spark, tmp_dir, runs)
    assert late.count() > 20 and emitted.count() > 20
    assert _rows(W.complete_sessions(emitted, late, still_open, None)) == _brute(everything)
    assert _rows(W.complete_sessions(emitted, late, still_open, until)) == _brute(everything, until)


def test_a_run_that_was_lost_is_ended_before_the_next(spark, tmp_dir):
    from goldvein.streaming import windows as W

    def lose_last_commit(n):
        if n == 1:  # as if the driver had died before the first run's last micro-batches were committed
            commits = sorted((f for f in os.listdir(f"{tmp_dir}/ckpt/commits") if f.isdigit()), key=int)
            for f in (commits[-1], f".{commits[-1]}.crc"):
                os.remove(f"{tmp_dir}/ckpt/commits/{f}")
    runs = [[("a", "2024-01-01T10:00:00"), ("b", "2024-01-01T12:00:00")], [("a", "2024-01-01T10:20:00"), ("b", "2024-01-01T15:00:00")],
            [("b", "2024-01-01T12:30:00")]]
    emitted, late, still_open, until = _runs(spark, tmp_dir, runs, lose_last_commit)
    assert _rows(W.complete_sessions(emitted, late, still_open, None)) == _brute([r for part in runs for r in part])
    assert late.count() == 2


def test_no_rows_and_rows_without_time_or_key(spark, tmp_dir):
    from goldvein.streaming import windows as W
    emitted, late, still_open, until = _runs(spark, tmp_dir, [[(None, "2024-01-01T10:00:00"), ("a", None)], [("a", "1969-01-01T10:00:00")]])
    assert (emitted.count(), late.count(), still_open.count()) == (0, 1, 0)
    assert _rows(W.complete_sessions(emitted, late, still_open, None)) == _brute([("a", "1969-01-01T10:00:00")])


def test_late_log_rows_are_added_to_their_hours(spark, tmp_dir):
    from goldvein.streaming import windows as W
    schema = "timestamp string, service string, level string, status_code int"
    runs = [[("2024-01-01T10:05:00", "s", "INFO", 200), ("2024-01-01T13:00:00", "s", "INFO", 500)],
            [("2024-01-01T10:59:00", "s", "INFO", 503), ("2024-01-01T09:00:00", None, "INFO", None), ("2024-01-01T12:10:00", "s", "INFO", 200)],
            [("2024-01-01T20:00:00", "s", "INFO", 200)]]
    for rows in runs:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{tmp_dir}/in")
        logs = spark.readStream.schema(schema).json(f"{tmp_dir}/in")
        W.run_with_late_rows(spark, lambda mark: W.hourly_counts_and_late_rows(spark, logs, mark), f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    whole = W.complete_hourly_counts(W.arrived(spark, f"{tmp_dir}/out", W.ON_TIME), W.arrived(spark, f"{tmp_dir}/out", W.LATE)).collect()
    got = {(r.window_start.hour, r.window_end.hour, r.service, r.n_events, r.n_5xx) for r in whole}
    assert got == {(9, 10, None, 1, 0), (10, 11, "s", 2, 1), (12, 13, "s", 1, 0), (13, 14, "s", 1, 1)} and len(whole) == 4
