"""Registered queries over states that were merged in several increments, and their oracles.

Bronze is dealt into two increments by a hash of the event id, so both have
rows of all dates and customers; the second increment is applied twice, as
after a crash. The results must equal those of one pass over all history.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..session import scratch_path
from . import incremental as N
from .catalog import _TM_COLS, L, query, stat6
from .oracle_ctes import with_ctes


def _applied(spark, sf_dir, *tables: str) -> N.Layers:
    layers = L(spark, sf_dir)
    cfg = replace(layers.cfg, silver_partition_by=None, state_period="year", state_slots=4)  # the days here have a few rows each
    out, frames = scratch_path(spark, "increments"), layers.bronze.by_table()
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for batch, part in ((1, 0), (2, 1), (2, 1)):
        N.run_increment(spark, out, {t: frames[t].where(half == part) for t in tables}, batch, cfg)
    return N.Layers(spark, out, cfg)


TX, CUSTOMERS, PRODUCTS = "bronze_transaction_events", "bronze_customer_events", "bronze_product_events"


@query("incremental_transaction_metrics", with_ctes(f"SELECT {_TM_COLS} FROM transaction_metrics", "transaction_metrics"))
def q_incremental_transaction_metrics(spark, sf_dir):
    tm = _applied(spark, sf_dir, TX).transaction_metrics()
    return tm.select(*[stat6(c) if c == "transaction_stddev" else c for c in tm.columns])


@query("incremental_gold_customer_analytics", with_ctes("SELECT * FROM gold_customer_analytics", "gold_customer_analytics"))
def q_incremental_gold_customer_analytics(spark, sf_dir):
    return _applied(spark, sf_dir, TX, CUSTOMERS, PRODUCTS).gold_customer_analytics().drop("processed_at")


@query("incremental_gold_business_metrics", with_ctes("SELECT * FROM gold_business_metrics", "gold_business_metrics"))
def q_incremental_gold_business_metrics(spark, sf_dir):
    return _applied(spark, sf_dir, TX, CUSTOMERS, PRODUCTS).gold_business_metrics().drop("processed_at")


@query("monthly_customers_sketch", with_ctes("""
SELECT strftime(transaction_date, '%Y-%m') AS month, COUNT(*) AS transactions, true AS within_error
FROM silver_transactions GROUP BY 1""", "silver_transactions"))
def q_monthly_customers_sketch(spark, sf_dir):
    """A month's customers from the sketches of its days, held against the exact count: within four standard errors."""
    found = _applied(spark, sf_dir, TX).customers_by_month()
    month = F.date_format("transaction_date", "yyyy-MM").alias("month")
    exact = L(spark, sf_dir).silver_tx.groupBy(month).agg(F.countDistinct("customer_id").alias("exact"))
    near = F.abs(F.col("customers") - F.col("exact")) <= F.ceil(4 * 0.016 * F.col("exact"))
    return found.join(exact, "month").select("month", "transactions", near.alias("within_error"))
