"""Compaction of the stream's files: same rows, fewer files, the stream goes on, broken runs don't show."""

import json

from goldvein.config import PipelineConfig
from goldvein.schemas import CUSTOMER_EVENT
from goldvein.streaming import compaction as K
from goldvein.streaming import ingest as I


def land(spark, path, ids, files=6):
    rows = [("k", str(i), json.dumps({"event_id": f"e{i}", "timestamp": "2024-01-01T00:00:00", "extra": i}) if i % 10 else "{broken") for i in ids]
    spark.createDataFrame(rows, "partition_key string, sequence_number string, data string").repartition(files).write.mode("append").json(path)


def ingest(spark, tmp):
    I.start_ingest(spark, f"{tmp}/landing", CUSTOMER_EVENT, f"{tmp}/t", f"{tmp}/c", PipelineConfig(), max_files_per_trigger=2, retention="30d").await_all()


def state(spark, root):
    bronze, rejected = I.read_bronze(spark, root, CUSTOMER_EVENT), I.read_quarantine(spark, root, CUSTOMER_EVENT)
    return (sorted(map(str, bronze.collect())), sorted(r.partition_key + str(r.raw_record) + r.reason for r in rejected.collect()),
            I.read_unknown(spark, root, CUSTOMER_EVENT).count()), len(bronze.inputFiles())


def test_same_rows_fewer_files_and_the_stream_goes_on(spark, tmp_dir):
    root, schema = f"{tmp_dir}/t", I.sink_schema(CUSTOMER_EVENT)
    assert K.compact(spark, root, schema, 0) == 0  # nothing there yet
    land(spark, f"{tmp_dir}/landing", range(60))
    ingest(spark, tmp_dir)
    before, files = state(spark, root)
    assert len(before[0]) == 54 and before[2] == 54
    assert K.compact(spark, root, schema, 1) >= files > 2
    after, fewer = state(spark, root)
    assert after == before and fewer < files
    assert K.compact(spark, root, schema, 1) == 0 and K.compact(spark, root, schema, 2) == 0
    land(spark, f"{tmp_dir}/landing", range(100, 130))
    ingest(spark, tmp_dir)
    both, _ = state(spark, root)
    assert len(both[0]) == 81 and set(before[0]) < set(both[0])
    assert K.compact(spark, root, schema, 3) > 0
    assert state(spark, root)[0] == both


def test_broken_run_is_not_read_and_is_replaced(spark, tmp_dir):
    root, schema = f"{tmp_dir}/t", I.sink_schema(CUSTOMER_EVENT)
    land(spark, f"{tmp_dir}/landing", range(30))
    ingest(spark, tmp_dir)
    before, _ = state(spark, root)
    # rows of a run whose list was never written
    rows = spark.read.schema(schema).parquet(f"{root}/stream").selectExpr("*", "7L AS run")
    rows.write.partitionBy("run", "record_status").parquet(f"{root}/merged")
    assert state(spark, root)[0] == before
    assert K.compact(spark, root, schema, 7) > 0
    assert state(spark, root)[0] == before
