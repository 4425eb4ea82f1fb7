"""Re-deliveries beyond any watermark; repeated micro-batches; latency sketches."""

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from goldvein.config import PipelineConfig
from goldvein.operators import products as P
from goldvein.schemas import CUSTOMER_EVENT, with_lineage
from goldvein.sources.landing import to_envelope, write_landing
from goldvein.streaming import ingest as I
from goldvein.streaming import once as O

CFG = PipelineConfig()


def events(spark, ids, action="view"):
    cols = {"event_id": None, "timestamp": "2024-01-01T00:00:00", "customer_id": "c", "action": action}
    rows = [tuple(i if f.name == "event_id" else cols.get(f.name) for f in with_lineage(CUSTOMER_EVENT).fields) for i in ids]
    return spark.createDataFrame(rows, with_lineage(CUSTOMER_EVENT))


def batch(spark, ids, action="view"):
    env = to_envelope(events(spark, ids, action), CUSTOMER_EVENT).unionByName(spark.createDataFrame(
        [("k", "s", "{broken")], "partition_key string, sequence_number string, data string"))
    return I.ingest_rows(I.decode(env, CUSTOMER_EVENT, CFG), CUSTOMER_EVENT)


def written(spark, root):
    return sorted((r.event_id, r.action) for r in I.read_bronze(spark, root, CUSTOMER_EVENT).collect())


def test_batches_and_repeats(spark, tmp_dir):
    O.write_batch(batch(spark, ["a", "b", "a"]), 0, tmp_dir, CFG)
    O.write_batch(batch(spark, ["b", "c"]), 1, tmp_dir, CFG)
    O.write_batch(batch(spark, ["a", "d"], "changed"), 2, tmp_dir, CFG)  # another payload under a known id stays
    want = [("a", "changed"), ("a", "view"), ("b", "view"), ("c", "view"), ("d", "changed")]
    assert written(spark, tmp_dir) == want
    for number, ids in ((1, ["b", "c"]), (2, ["a", "d"])):  # run again after a crash
        O.write_batch(batch(spark, ids, "view" if number == 1 else "changed"), number, tmp_dir, CFG)
    O.write_batch(batch(spark, ["a", "b", "c"]), 3, tmp_dir, CFG)  # all known: nothing is written
    assert written(spark, tmp_dir) == want
    assert I.read_quarantine(spark, tmp_dir, CUSTOMER_EVENT).count() == 1  # the rejected record, too, is kept once


def test_a_broken_batch_is_replaced(spark, tmp_dir):
    O.write_batch(batch(spark, ["a"]), 0, tmp_dir, CFG)
    rows = batch(spark, ["a", "b"]).dropDuplicates(list(O.KEY))
    # the batch wrote its records, but no keys, before it broke off
    O._overwrite(rows.where("event_id = 'b'").drop(I.PAYLOAD_HASH).withColumn("batch", F.lit(1).cast("long")), f"{tmp_dir}/{I.ONCE}", "batch", I.RECORD_STATUS)
    O.write_batch(batch(spark, ["a", "b"]), 1, tmp_dir, CFG)
    assert written(spark, tmp_dir) == [("a", "view"), ("b", "view")]


def test_keys_may_be_let_go(spark, tmp_dir):
    O.write_batch(batch(spark, ["a"]), 0, tmp_dir, CFG)
    later = replace(CFG, as_of=date(2024, 3, 1))
    O.write_batch(batch(spark, ["a"]), 1, tmp_dir, later, keep_days=60)
    assert written(spark, tmp_dir) == [("a", "view")]
    O.write_batch(batch(spark, ["a"]), 2, tmp_dir, later, keep_days=0)
    assert written(spark, tmp_dir) == [("a", "view")] * 2  # the key of the first is older than that


def test_stream_beside_batch_append(spark, tmp_dir):
    for ids in (["a", "b"], ["b", "c"], ["a", "c"]):
        write_landing(to_envelope(events(spark, ids), CUSTOMER_EVENT), f"{tmp_dir}/landing", 1)
        O.ingest_once(spark, f"{tmp_dir}/landing", CUSTOMER_EVENT, f"{tmp_dir}/t", f"{tmp_dir}/ckpt", CFG)
    I.append_bronze(events(spark, ["z"]), f"{tmp_dir}/t", CUSTOMER_EVENT)
    assert written(spark, f"{tmp_dir}/t") == [(i, "view") for i in "abcz"]


def test_latency_of_merged_hours(spark):
    rows = [("s", f"2024-01-01T{h:02d}:10:00", None if v % 50 == 0 else v) for h in range(24) for v in range(200)] + [("t", "2024-01-02T00:00:00", None)]
    logs = spark.createDataFrame(rows, "service string, timestamp string, response_time_ms long")
    found = {r.service: r for r in P.latency_by_day(P.latency_sketches(logs)).collect()}
    assert found["s"].requests == 4800 and (found["t"].requests, found["t"].latencies) == (1, None)
    assert all(abs(v - q * 200) <= 2 * 0.0165 * 200 + 1 for v, q in zip(found["s"].latencies, (0.5, 0.95, 0.99)))


def test_landed_records_are_small_and_read_the_same(spark, tmp_dir):
    import os
    from goldvein.plans import catalog_streaming as Q
    env = to_envelope(events(spark, [f"e{i}" for i in range(3000)]), CUSTOMER_EVENT)
    write_landing(env, f"{tmp_dir}/plain", 1)
    Q.write_landing(env, f"{tmp_dir}/landing")
    size = lambda d: sum(os.path.getsize(f"{tmp_dir}/{d}/{f}") for f in os.listdir(f"{tmp_dir}/{d}"))
    assert size("landing") < size("plain") / 3
    O.ingest_once(spark, f"{tmp_dir}/landing", CUSTOMER_EVENT, f"{tmp_dir}/t", f"{tmp_dir}/c", CFG)
    assert written(spark, f"{tmp_dir}/t") == sorted((f"e{i}", "view") for i in range(3000))
