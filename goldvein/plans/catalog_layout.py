"""Registered queries over co-located customer tables, and their oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from .catalog import L, query
from .layout import CustomerTables, colocated
from .oracle_ctes import with_ctes

BUCKETS = 8  # the test tables are small; a run takes PipelineConfig.customer_buckets


def _stored(spark, sf_dir) -> CustomerTables:
    layers = L(spark, sf_dir)
    tables = CustomerTables(spark, scratch_path(spark, "customer-tables"), BUCKETS, f"t{uuid.uuid4().hex[:12]}_", layers.cfg)
    tables.put_silver(layers.silver_cust, layers.silver_tx)
    return tables


@query("colocated_gold_customer_analytics", with_ctes("SELECT * FROM gold_customer_analytics", "gold_customer_analytics"))
def q_colocated_gold_customer_analytics(spark, sf_dir):
    """The customer 360 written and read as a bucketed table, from bucketed tables."""
    return _stored(spark, sf_dir).put_gold().drop("processed_at")


@query("colocated_dq", with_ctes("""
SELECT 'unique' AS check_type, COUNT(*) AS rows_checked, CAST(COUNT(*) - COUNT(DISTINCT customer_id) AS BIGINT) AS failures FROM silver_customers
UNION ALL
SELECT 'referential', COUNT(*), CAST(SUM(CASE WHEN customer_id IN (SELECT customer_id FROM silver_customers) THEN 0 ELSE 1 END) AS BIGINT)
FROM transaction_metrics""", "silver_customers", "transaction_metrics"))
def q_colocated_dq(spark, sf_dir):
    """DQ6 and DQ7 on customer_id over bucketed tables: no row of them is shuffled, only one partial sum a task."""
    tables = _stored(spark, sf_dir)
    profiles, metrics = tables.get("silver_customers"), tables.get("customer_metrics")
    per_customer = profiles.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    unique = per_customer.agg(F.lit("unique").alias("check_type"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
                              F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failures"))
    known = metrics.join(colocated(per_customer), "customer_id", "left")
    referential = known.agg(F.lit("referential").alias("check_type"), F.count(F.lit(1)).alias("rows_checked"),
                            F.count(F.when(F.col("n").isNull(), 1)).alias("failures"))
    return unique.unionByName(referential)
