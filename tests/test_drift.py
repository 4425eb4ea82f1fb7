"""Fields that producers add later: kept as a variant, reported, and without effect on the declared columns."""

import json

from goldvein.config import PipelineConfig
from goldvein.schemas import CUSTOMER_EVENT
from goldvein.streaming import ingest as I
from goldvein.streaming import once as O

PAYLOADS = [
    {"event_id": "1", "timestamp": "2024-01-01T00:00:00", "action": "view"},
    {"event_id": "2", "timestamp": "2024-01-01T00:00:00", "action": "view", "plan": "pro", "cart": {"items": [1, 2], "sum": 3.5}},
    {"event_id": "3", "timestamp": "2024-01-01T00:00:00", "plan": 7, "none": None},
    {"event_id": None, "timestamp": "2024-01-01T00:00:00", "plan": "rejected"},
]


def land(spark, path, payloads):
    rows = [("k", str(n), p if isinstance(p, str) or p is None else json.dumps(p)) for n, p in enumerate(payloads)]
    spark.createDataFrame(rows, "partition_key string, sequence_number string, data string").write.mode("append").json(path)


def check(spark, root):
    unknown = I.read_unknown(spark, root, CUSTOMER_EVENT)
    got = {r.event_id: json.loads(r.j) for r in unknown.selectExpr("event_id", "to_json(unknown_fields) AS j").collect()}
    assert got == {"2": {"plan": "pro", "cart": {"items": [1, 2], "sum": 3.5}}, "3": {"plan": 7, "none": None}}
    report = {(r.field, r.value_type): r.records for r in I.drift_report(unknown).collect()}
    assert report == {("plan", "string"): 1, ("plan", "number"): 1, ("cart", "object"): 1, ("none", "null"): 1}
    row = I.drift_schema(unknown).first()
    assert row.records == 2 and "plan" in row.unknown_schema and "cart" in row.unknown_schema
    bronze = I.read_bronze(spark, root, CUSTOMER_EVENT)
    assert I.UNKNOWN not in bronze.columns and sorted(r.event_id for r in bronze.collect()) == ["1", "2", "3"]


def test_unknown_fields_of_the_stream(spark, tmp_dir):
    land(spark, f"{tmp_dir}/landing", [*PAYLOADS, "{broken", None, "[1]", "3"])
    I.start_ingest(spark, f"{tmp_dir}/landing", CUSTOMER_EVENT, f"{tmp_dir}/t", f"{tmp_dir}/c", PipelineConfig()).await_all()
    check(spark, f"{tmp_dir}/t")
    assert I.read_quarantine(spark, f"{tmp_dir}/t", CUSTOMER_EVENT).count() == 5


def test_unknown_fields_written_once(spark, tmp_dir):
    for _ in range(2):
        land(spark, f"{tmp_dir}/landing", PAYLOADS)
        O.ingest_once(spark, f"{tmp_dir}/landing", CUSTOMER_EVENT, f"{tmp_dir}/t", f"{tmp_dir}/c", PipelineConfig())
    check(spark, f"{tmp_dir}/t")


def test_nothing_unknown(spark, tmp_dir):
    land(spark, f"{tmp_dir}/landing", PAYLOADS[:1])
    I.start_ingest(spark, f"{tmp_dir}/landing", CUSTOMER_EVENT, f"{tmp_dir}/t", f"{tmp_dir}/c", PipelineConfig()).await_all()
    unknown = I.read_unknown(spark, f"{tmp_dir}/t", CUSTOMER_EVENT)
    assert I.drift_report(unknown).collect() == [] and tuple(I.drift_schema(unknown).first()) == (0, None)
