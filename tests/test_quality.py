"""Data-quality operators: PASS/FAIL/ERROR paths and the gate."""

from datetime import date, datetime

import pytest

from goldvein.config import PipelineConfig
from goldvein.operators import quality as Q


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_validate_bronze_pass_fail_error(spark):
    cfg = PipelineConfig(as_of=date(2024, 1, 31))
    ok = frame(spark, [("a", "2024-01-31T10:00:00"), ("b", "2024-01-30T10:00:00")], "event_id string, processed_at string")
    dup = frame(spark, [("a", "2024-01-31T10:00:00"), ("a", "2024-01-31T11:00:00"), (None, "2024-01-31T11:00:00")],
                "event_id string, processed_at string")
    stale = frame(spark, [("a", "2024-01-30T10:00:00")], "event_id string, processed_at string")
    res = {r.table_name: r for r in Q.validate_bronze(spark, {
        "ok": ok, "dup": dup, "stale": stale, "missing": "/nonexistent/path/bronze"}, cfg).collect()}
    assert (res["ok"]["count"], res["ok"].duplicates, res["ok"].status) == (1, 0, "PASS")
    assert (res["dup"]["count"], res["dup"].duplicates, res["dup"].status) == (3, 2, "FAIL")  # NULL id counts
    assert (res["stale"]["count"], res["stale"].status) == (0, "FAIL")
    assert res["missing"].status == "ERROR" and res["missing"].error
    with pytest.raises(ValueError, match="dup"):
        Q.quality_gate(Q.validate_bronze(spark, {"ok": ok, "dup": dup}, cfg))
    assert Q.quality_gate(Q.validate_bronze(spark, {"ok": ok}, cfg)) is True
    tolerant = PipelineConfig(as_of=date(2024, 1, 31), duplicate_tolerance=0.7)
    assert Q.validate_bronze(spark, {"dup": dup}, tolerant).first().status == "PASS"


def test_row_checks(spark):
    df = frame(spark, [("a@b", 1.0, datetime(2024, 1, 1)), ("ab", 1.0, datetime(2024, 1, 1)),
                       ("a@b", -1.0, datetime(2024, 1, 1)), ("a@b", 0.0, datetime(2024, 2, 1))],
               "email string, total_spent double, created_at timestamp_ntz")
    r = Q.row_checks(df, datetime(2024, 1, 31)).first()
    assert (r.failed_records, r.bad_email, r.negative_spend, r.future_created_at, r.status) == (3, 1, 1, 1, "FAIL")


def test_completeness(spark):
    df = frame(spark, [(1, None), (2, "x"), (None, "y")] + [(i, "z") for i in range(17)], "a int, b string")
    res = {r.column_name: r for r in Q.completeness(df, "t", ["a", "b"], 0.05).collect()}
    assert res["a"].null_count == 1 and res["a"].null_fraction == 1 / 20 and res["a"].status == "PASS"
    empty = Q.completeness(df.limit(0), "t", ["a"]).first()
    assert empty.null_fraction is None and empty.status == "PASS"


def test_volume_uses_previous_calendar_day(spark):
    rows = [("2024-01-01T01:00:00",)] * 100 + [("2024-01-02T01:00:00",)] * 160 + [("2024-01-04T01:00:00",)] * 120
    res = {str(r.day): r for r in Q.volume(frame(spark, rows, "timestamp string"), "timestamp", "t", 100, 50.0).collect()}
    assert res["2024-01-01"].prev_day_count is None and res["2024-01-01"].status == "PASS"
    assert res["2024-01-02"].change_pct == 60.0 and res["2024-01-02"].status == "FAIL"
    assert res["2024-01-04"].prev_day_count is None and res["2024-01-04"].status == "PASS"


def test_referential_and_uniqueness(spark):
    child = frame(spark, [("a",), ("a",), ("b",), ("x",), ("x",), ("x",), (None,)], "customer_id string")
    parent = frame(spark, [("a",), ("b",), ("b",)], "customer_id string")
    r = Q.referential(child, parent, "customer_id", "c", "p").first()
    assert (r.orphan_keys, r.orphan_rows, r.status) == (1, 3, "FAIL")
    u = Q.uniqueness(child, "c", ["customer_id"]).first()
    assert (u.total_rows, u.null_key_rows, u.distinct_keys, u.duplicated_keys, u.excess_rows, u.status) == \
        (7, 1, 3, 2, 3, "FAIL")
    assert Q.uniqueness(parent.distinct(), "p", ["customer_id"]).first().status == "PASS"


def test_freshness(spark):
    df = frame(spark, [("2024-01-30T23:00:00",), ("2024-01-30T20:00:00",)], "processed_at string")
    r = Q.freshness(df, "processed_at", "t", datetime(2024, 1, 31)).first()
    assert r.lag_minutes == 60.0 and r.status == "PASS"
    r = Q.freshness(df, "processed_at", "t", datetime(2024, 1, 31, 1, 0, 1)).first()
    assert r.status == "FAIL"
