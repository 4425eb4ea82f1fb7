"""Registered data-quality queries (DQ1, DQ3-DQ8) and their oracles."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..session import scratch_path
from .catalog import L, query
from .oracle_ctes import AS_OF, RUN_TS, with_ctes
from .pipeline import REQUIRED_COLUMNS as PIPELINE_COLUMNS, write_and_check

BRONZE = ("bronze_customer_events", "bronze_transaction_events", "bronze_product_events",
          "bronze_system_logs")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---- DQ1 ----------------------------------------------------------------------------------

_validation_sql = " UNION ALL ".join(f"""
SELECT '{t}' AS table_name, c AS "count", dup AS duplicates,
  CASE WHEN c > 0 AND dup <= 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(NULL AS VARCHAR) AS error
FROM (SELECT COUNT(CASE WHEN CAST(CAST(processed_at AS TIMESTAMP) AS DATE) = {AS_OF} THEN 1 END) AS c,
             COUNT(*) - COUNT(DISTINCT event_id) AS dup FROM {t}) x""" for t in BRONZE)


@query("bronze_validation", with_ctes(_validation_sql, *BRONZE))
def q_bronze_validation(spark, sf_dir):
    layers = L(spark, sf_dir)
    return Q.validate_bronze(spark, layers.bronze.by_table(), layers.cfg)


# The same check where it passes, fails and breaks: a day with rows and the same rows without that
# day (half of the rows may be duplicates), a processed_at that is no timestamp, a table that isn't there.
_day = "processed_at LIKE '2024-01-15%'"
_states_sql = " UNION ALL ".join(f"""
SELECT '{name}' AS table_name, c AS "count", dup AS duplicates,
  CASE WHEN c > 0 AND dup <= FLOOR(total * 0.5) THEN 'PASS' ELSE 'FAIL' END AS status, false AS has_error
FROM (SELECT COUNT(CASE WHEN {_day} THEN 1 END) AS c, COUNT(*) - COUNT(DISTINCT event_id) AS dup, COUNT(*) AS total
      FROM bronze_customer_events WHERE {rows}) x""" for name, rows in (("passes", "true"), ("fails", f"NOT {_day}"))) + """
UNION ALL SELECT 'breaks', NULL, NULL, 'ERROR', true
UNION ALL SELECT 'is_missing', NULL, NULL, 'ERROR', true"""


@query("bronze_validation_states", with_ctes(_states_sql, "bronze_customer_events"))
def q_bronze_validation_states(spark, sf_dir):
    layers = L(spark, sf_dir)
    events = layers.bronze.customer_events
    cfg = replace(layers.cfg, as_of=date(2024, 1, 15), duplicate_tolerance=0.5)
    tables = {"passes": events, "breaks": events.withColumn("processed_at", F.lit("not a time")),
              "fails": events.where(f"NOT {_day}")}
    return Q.validate_bronze(spark, tables, cfg, expected=("passes", "is_missing")).select(
        "table_name", "count", "duplicates", "status", F.col("error").isNotNull().alias("has_error"))


# ---- DQ3 ----------------------------------------------------------------------------------

@query("dq_row_checks", with_ctes(f"""
SELECT 'silver_customers' AS table_name,
  COUNT(CASE WHEN email NOT LIKE '%@%' OR total_spent < 0 OR created_at > {RUN_TS} THEN 1 END) AS failed_records,
  COUNT(CASE WHEN email NOT LIKE '%@%' THEN 1 END) AS bad_email,
  COUNT(CASE WHEN total_spent < 0 THEN 1 END) AS negative_spend,
  COUNT(CASE WHEN created_at > {RUN_TS} THEN 1 END) AS future_created_at,
  COUNT(*) AS total_rows,
  CASE WHEN COUNT(CASE WHEN email NOT LIKE '%@%' OR total_spent < 0 OR created_at > {RUN_TS} THEN 1 END) = 0
       THEN 'PASS' ELSE 'FAIL' END AS status
FROM silver_customers""", "silver_customers"))
def q_dq_row_checks(spark, sf_dir):
    layers = L(spark, sf_dir)
    return Q.row_checks(layers.silver_cust, layers.cfg.run_timestamp)


# ---- DQ4 ----------------------------------------------------------------------------------

REQUIRED_COLUMNS = {
    "bronze_customer_events": ["event_id", "customer_id", "email", "timestamp"],
    "bronze_transaction_events": ["event_id", "transaction_id", "customer_id", "amount", "timestamp"],
    "bronze_product_events": ["event_id", "product_id", "customer_id", "rating"],
    "bronze_system_logs": ["event_id", "user_id", "timestamp"],
}

_completeness_sql = " UNION ALL ".join(f"""
SELECT '{t}' AS table_name, '{c}' AS column_name, nulls AS null_count, total AS total_rows,
  CASE WHEN total > 0 THEN CAST(nulls AS DOUBLE) / CAST(total AS DOUBLE) END AS null_fraction,
  CASE WHEN COALESCE(CASE WHEN total > 0 THEN CAST(nulls AS DOUBLE) / CAST(total AS DOUBLE) END, 0.0) <= 0.05
       THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT COUNT(*) AS total, COUNT(CASE WHEN "{c}" IS NULL THEN 1 END) AS nulls FROM {t}) x"""
    for t, cols in REQUIRED_COLUMNS.items() for c in cols)


@query("dq_completeness", with_ctes(_completeness_sql, *BRONZE))
def q_dq_completeness(spark, sf_dir):
    layers = L(spark, sf_dir)
    frames = layers.bronze.by_table()
    return _union([Q.completeness(frames[t], t, cols, layers.cfg.max_null_percentage)
                   for t, cols in REQUIRED_COLUMNS.items()])


# ---- DQ5 ----------------------------------------------------------------------------------

VOLUME_TABLES = BRONZE

_volume_sql = " UNION ALL ".join(f"""
SELECT '{t}' AS table_name, a.day, a.row_count, p.row_count AS prev_day_count,
  CASE WHEN p.row_count > 0 THEN CAST(a.row_count - p.row_count AS DOUBLE) / p.row_count * CAST(100.0 AS DOUBLE) END AS change_pct,
  CASE WHEN a.row_count >= 100 AND (p.row_count IS NULL OR p.row_count <= 0
        OR ABS(CAST(a.row_count - p.row_count AS DOUBLE) / p.row_count * CAST(100.0 AS DOUBLE)) <= 50.0)
       THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT CAST(CAST(timestamp AS TIMESTAMP) AS DATE) AS day, COUNT(*) AS row_count FROM {t} GROUP BY 1) a
LEFT JOIN (SELECT CAST(CAST(timestamp AS TIMESTAMP) AS DATE) AS day, COUNT(*) AS row_count FROM {t} GROUP BY 1) p
  ON a.day = p.day + 1""" for t in VOLUME_TABLES)


@query("dq_volume", with_ctes(_volume_sql, *VOLUME_TABLES))
def q_dq_volume(spark, sf_dir):
    layers = L(spark, sf_dir)
    frames = layers.bronze.by_table()
    return _union([Q.volume(frames[t], "timestamp", t, layers.cfg.min_row_count,
                            layers.cfg.max_volume_change_pct) for t in VOLUME_TABLES])


# ---- DQ6 ----------------------------------------------------------------------------------

REFERENTIAL = (
    ("silver_transactions", "silver_customers"),
    ("bronze_product_events", "silver_customers"),
    ("gold_customer_analytics", "silver_customers"),
)

_referential_sql = " UNION ALL ".join(f"""
SELECT '{c}.customer_id -> {p}.customer_id' AS check_name, COUNT(*) AS orphan_keys,
  CAST(COALESCE(SUM(n), 0) AS BIGINT) AS orphan_rows,
  CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT customer_id, COUNT(*) AS n FROM {c} WHERE customer_id IS NOT NULL GROUP BY customer_id) k
WHERE NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.customer_id = k.customer_id)""" for c, p in REFERENTIAL)


@query("dq_referential", with_ctes(_referential_sql, "silver_transactions", "silver_customers",
                                   "bronze_product_events", "gold_customer_analytics"))
def q_dq_referential(spark, sf_dir):
    layers = L(spark, sf_dir)
    frames = {"silver_transactions": layers.silver_tx, "silver_customers": layers.silver_cust,
              "bronze_product_events": layers.bronze.product_events,
              "gold_customer_analytics": layers.gold_cust}
    return _union([Q.referential(frames[c], frames[p], "customer_id", c, p) for c, p in REFERENTIAL])


# ---- DQ7 ----------------------------------------------------------------------------------

UNIQUE_KEYS = (
    ("silver_transactions", "transaction_id"),
    ("silver_customers", "customer_id"),
    ("silver_customers", "email"),
    ("gold_customer_analytics", "customer_id"),
    ("bronze_customer_events", "event_id"),
    ("bronze_product_events", "event_id"),
)

_uniqueness_sql = " UNION ALL ".join(f"""
SELECT '{t}' AS table_name, '{k}' AS key_columns,
  CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_rows,
  CAST(COALESCE(SUM(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_key_rows,
  COUNT(CASE WHEN k IS NOT NULL THEN 1 END) AS distinct_keys,
  COUNT(CASE WHEN k IS NOT NULL AND n > 1 THEN 1 END) AS duplicated_keys,
  CAST(COALESCE(SUM(CASE WHEN k IS NOT NULL THEN n - 1 END), 0) AS BIGINT) AS excess_rows,
  CASE WHEN COUNT(CASE WHEN k IS NOT NULL AND n > 1 THEN 1 END) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT {k} AS k, COUNT(*) AS n FROM {t} GROUP BY {k}) x""" for t, k in UNIQUE_KEYS)


@query("dq_uniqueness", with_ctes(_uniqueness_sql, *{t for t, _ in UNIQUE_KEYS}))
def q_dq_uniqueness(spark, sf_dir):
    layers = L(spark, sf_dir)
    frames = {"silver_transactions": layers.silver_tx, "silver_customers": layers.silver_cust,
              "gold_customer_analytics": layers.gold_cust,
              "bronze_customer_events": layers.bronze.customer_events,
              "bronze_product_events": layers.bronze.product_events}
    return _union([Q.uniqueness(frames[t], t, [k]) for t, k in UNIQUE_KEYS])


# ---- DQ8 ----------------------------------------------------------------------------------

_freshness_sql = " UNION ALL ".join(f"""
SELECT '{t}' AS table_name, newest,
  CAST(date_diff('microsecond', newest, {RUN_TS}) AS DOUBLE) / CAST(60000000.0 AS DOUBLE) AS lag_minutes,
  CASE WHEN newest >= {RUN_TS} - INTERVAL 2 HOUR THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT MAX(CAST(processed_at AS TIMESTAMP)) AS newest FROM {t}
      WHERE CAST(processed_at AS TIMESTAMP) <= {RUN_TS}) x""" for t in BRONZE)


@query("dq_freshness", with_ctes(_freshness_sql, *BRONZE))
def q_dq_freshness(spark, sf_dir):
    layers = L(spark, sf_dir)
    return _union([Q.freshness(df, "processed_at", t, layers.cfg.run_timestamp, layers.cfg.freshness_hours)
                   for t, df in layers.bronze.by_table().items()])


# ---- DQ3, DQ4 while writing (T9) ------------------------------------------------------------

WRITTEN_COLUMNS = {"silver_transactions": PIPELINE_COLUMNS["silver_transactions"], "silver_customers": PIPELINE_COLUMNS["silver_customers"]}

_written_sql = " UNION ALL ".join(f"""
SELECT 'complete' AS check_name, '{t}' AS table_name, '{c}' AS measure, COUNT(*) - COUNT("{c}") AS failed, COUNT(*) AS total_rows,
  CASE WHEN COUNT(*) - COUNT("{c}") <= 0.05 * COUNT(*) THEN 'PASS' ELSE 'FAIL' END AS status
FROM {t}""" for t, cols in WRITTEN_COLUMNS.items() for c in cols) + f"""
UNION ALL
SELECT 'rows', 'silver_customers', 'failed_records', bad, total, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END
FROM (SELECT COUNT(*) FILTER (email NOT LIKE '%@%' OR total_spent < 0 OR created_at > {RUN_TS}) AS bad, COUNT(*) AS total
      FROM silver_customers) x"""


@query("dq_while_writing", with_ctes(_written_sql, "silver_transactions", "silver_customers"))
def q_dq_while_writing(spark, sf_dir):
    """Silver is written once; its row checks and completeness come from the rows on their way to the files."""
    layers = L(spark, sf_dir)
    out, cfg = scratch_path(spark, "checked"), layers.cfg
    complete = {t: Q.completeness_check(t, cols, cfg.max_null_percentage) for t, cols in WRITTEN_COLUMNS.items()}
    tx = write_and_check(layers.silver_tx, f"{out}/silver_transactions", {"complete": complete["silver_transactions"]})
    cust = write_and_check(layers.silver_cust, f"{out}/silver_customers", {
        "complete": complete["silver_customers"], "rows": Q.row_check(cfg.run_timestamp)})
    filled = [r.select(F.lit("complete").alias("check_name"), "table_name", F.col("column_name").alias("measure"),
                       F.col("null_count").alias("failed"), "total_rows", "status") for r in (tx["complete"], cust["complete"])]
    rows = cust["rows"].select(F.lit("rows").alias("check_name"), "table_name", F.lit("failed_records").alias("measure"),
                               F.col("failed_records").alias("failed"), "total_rows", "status")
    return _union([*filled, rows])
