"""Results do not depend on the session time zone (all event times are wall-clock NTZ)."""

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL
from .oracle_compare import compare, duck

NAMES = ["silver_transactions", "system_log_metrics", "stream_hourly_counts", "silver_sessions", "dq_freshness"]


@pytest.mark.parametrize("tz", ["Asia/Kolkata", "America/Sao_Paulo"])
def test_queries_under_other_time_zones(spark, tz):
    con = duck(SF_SMALL)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        for name in NAMES:
            ok, msg = compare(spark, con, name, E.queries()[name](spark, SF_SMALL), E.oracle_sql()[name])
            assert ok, f"{tz}: {msg}"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
