"""End-to-end run: stream ingest of all four landed streams, gate, silver, gold, layer tests."""

import os

import pytest

from goldvein.config import PipelineConfig
from goldvein.operators import gold_customer as GC
from goldvein.operators import silver as S
from goldvein.plans import pipeline
from goldvein.plans.pipeline import run_pipeline
from goldvein.schemas import STREAMS
from goldvein.sources.driver_tables import load_bronze
from goldvein.sources.landing import to_envelope, write_landing

from .conftest import SF_SMALL


def land_all(spark, root):
    frames = load_bronze(spark, SF_SMALL).by_table()
    for stream, (table, schema) in STREAMS.items():
        write_landing(to_envelope(frames[table], schema), f"{root}/{stream}", 2)
    return frames


def test_gate_stops_on_duplicate_event_ids(spark, tmp_dir):
    land_all(spark, f"{tmp_dir}/landing")
    with pytest.raises(ValueError, match="bronze_product_events"):
        run_pipeline(spark, f"{tmp_dir}/out", PipelineConfig(), landing_root=f"{tmp_dir}/landing")


def test_full_run_with_tolerance(spark, tmp_dir):
    frames = land_all(spark, f"{tmp_dir}/landing")
    cfg = PipelineConfig(duplicate_tolerance=0.5)
    res = run_pipeline(spark, f"{tmp_dir}/out", cfg, landing_root=f"{tmp_dir}/landing",
                       known_failures=("silver_row_checks", "silver_uniqueness", "silver_referential", "gold_uniqueness"))
    for name in ("silver_transactions", "silver_customers", "gold_customer_analytics", "gold_business_metrics",
                 "silver_products", "silver_sessions", "gold_cohort_analysis", "gold_revenue_attribution"):
        assert os.path.isdir(res.paths[name])
    val = {r.table_name: r.status for r in spark.read.parquet(res.quality["bronze_validation"]).collect()}
    assert set(val.values()) == {"PASS"}
    for name in ("bronze_volume", "bronze_freshness", "silver_completeness", "gold_completeness"):
        assert spark.read.parquet(res.quality[name]).count() > 0
    assert res.ingest_counts["bronze_customer_events"]["records_read"] == frames["bronze_customer_events"].count()
    assert res.ingest_counts["bronze_customer_events"]["records_quarantined"] == 0
    # the written gold table equals the same plan run directly on the source frames
    stx = S.silver_transactions(frames["bronze_transaction_events"], cfg)
    scu = S.silver_customers(frames["bronze_customer_events"], frames["bronze_transaction_events"],
                             frames["bronze_product_events"], cfg)
    direct = GC.gold_customer_analytics(scu, stx, cfg).drop("processed_at", "customer_status")
    written = spark.read.parquet(res.paths["gold_customer_analytics"]).drop("processed_at", "customer_status")
    assert written.count() == direct.count()
    assert written.select(sorted(written.columns)).exceptAll(direct.select(sorted(direct.columns))).count() == 0
    assert "silver_referential" in res.failed_checks  # fixture has transactions of customers without events


def test_a_quiet_stream_reaches_validation(spark, tmp_dir):
    frames = land_all(spark, f"{tmp_dir}/landing")
    assert frames and not os.path.exists(f"{tmp_dir}/quiet/x")
    for stream, _ in STREAMS.items():
        if stream != "system-logs":
            os.rename(f"{tmp_dir}/landing/{stream}", f"{tmp_dir}/{stream}")
            os.makedirs(f"{tmp_dir}/landing/{stream}")
    with pytest.raises(ValueError, match="bronze_customer_events"):
        run_pipeline(spark, f"{tmp_dir}/out", PipelineConfig(), landing_root=f"{tmp_dir}/landing")
    rows = {r.table_name: r for r in spark.read.parquet(f"{tmp_dir}/out/quality/bronze_validation").collect()}
    assert rows["bronze_customer_events"]["count"] == 0 and rows["bronze_customer_events"].status == "FAIL"
    assert rows["bronze_system_logs"].status == "PASS"


def test_a_failed_test_stops_the_run_unless_known(spark, tmp_dir):
    rows = spark.createDataFrame([("t", "FAIL")], "table_name string, status string")
    result = pipeline.RunResult()
    with pytest.raises(ValueError, match="some_test"):
        pipeline._record(spark, result, tmp_dir, "some_test", rows, PipelineConfig(), True)
    pipeline._record(spark, result, tmp_dir, "known_test", rows, PipelineConfig(), False)
    assert result.failed_checks == ["some_test", "known_test"]
