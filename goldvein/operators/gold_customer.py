"""Gold customer 360.

``transaction_metrics`` is one aggregation per customer over completed silver
transactions. Its three distinct counts are sizes of sets and its two modes
counters per value, all merged inside each map task first, so a hot customer
ships one row a task and no row is multiplied (COUNT(DISTINCT ...) three times
would be an Expand of every row). The sets are bounded by the calendar and by
the payment methods and categories one customer used. ``state.metrics_from``
gives the same table from states that are merged batch by batch. The reference's lifetime-value and risk CTEs are
projections of the same aggregate; they become columns here instead of two
extra self-joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import PipelineConfig
from ..functions import rules as R


def transaction_metrics(silver_tx: DataFrame, approx: bool = False) -> DataFrame:
    """16 aggregates per customer over status = 'completed'.

    ``approx=True`` replaces the three exact distinct counts by sketches.
    """
    return (silver_tx
            .where(F.col("status") == "completed")
            .groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("total_transactions_detailed"),
                 R.exact_sum("amount_usd").alias("total_revenue_usd"),
                 R.exact_avg("amount_usd").alias("avg_transaction_usd"),
                 F.stddev_samp("amount_usd").alias("transaction_stddev"),
                 R.distinct_size("transaction_date", approx).alias("transaction_days"),
                 F.max("transaction_date").alias("last_transaction_date"),
                 F.min("transaction_date").alias("first_transaction_date"),
                 R.count_when(F.col("is_high_risk")).alias("high_risk_transactions"),
                 R.exact_avg("fraud_score", R.SCORE).alias("avg_fraud_score"),
                 R.count_when(F.col("time_of_day") == "Night").alias("night_transactions"),
                 R.count_when(F.col("day_type") == "Weekend").alias("weekend_transactions"),
                 R.count_when(F.col("amount_category") == "High").alias("high_value_transactions"),
                 F.mode("payment_method", deterministic=True).alias("preferred_payment_method"),
                 R.distinct_size("payment_method", approx).alias("payment_methods_used"),
                 F.mode("category", deterministic=True).alias("preferred_category"),
                 R.distinct_size("category", approx).alias("categories_purchased")))


def with_lifetime_value(tm: DataFrame) -> DataFrame:
    """B16-B17 as columns of the metrics row (the reference re-joins them)."""
    return tm.withColumns({
        "daily_value": R.daily_value("total_revenue_usd", "transaction_days"),
        "estimated_ltv": R.estimated_ltv("total_revenue_usd", "transaction_days"),
    })


def with_risk_score(tm: DataFrame) -> DataFrame:
    """B19 as a column of the metrics row."""
    return tm.withColumn("composite_risk_score", R.composite_risk_score(
        "avg_fraud_score", "high_risk_transactions", "night_transactions",
        "total_transactions_detailed", "transaction_stddev"))


GOLD_CUSTOMER_COLUMNS = (
    "customer_id", "email", "country", "device_type", "created_at", "last_activity_at",
    "customer_status", "customer_segment", "total_transactions_detailed", "total_revenue_usd",
    "avg_transaction_usd", "transaction_days", "first_transaction_date", "last_transaction_date",
    "estimated_ltv", "ltv_category", "composite_risk_score", "risk_level",
    "preferred_payment_method", "payment_methods_used", "preferred_category",
    "categories_purchased", "high_value_transactions", "weekend_transactions",
    "night_transactions", "engagement_level", "recency_score", "frequency_score",
    "monetary_score", "processed_at",
)


def gold_customer_analytics(silver_cust: DataFrame, silver_tx: DataFrame,
                            cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """Customers with transactions, left-joined to their completed-transaction metrics.

    Customers whose transactions never completed keep NULL metrics and fall
    into every ELSE branch (Low LTV, Low Risk, Low Engagement, scores 1/1/1).
    """
    return customer_360(silver_cust, transaction_metrics(silver_tx), cfg)


def customer_360(silver_cust: DataFrame, metrics: DataFrame, cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """B25 from a customer's transaction metrics, however they were made."""
    tm = with_risk_score(with_lifetime_value(metrics))
    base = silver_cust.where(F.col("total_transactions") > 0).drop(
        "last_transaction_date", "processed_at")
    j = base.join(tm, "customer_id", "left")
    return j.select(
        "customer_id", "email", "country", "device_type", "created_at", "last_activity_at",
        "customer_status", "customer_segment", "total_transactions_detailed",
        "total_revenue_usd", "avg_transaction_usd", "transaction_days",
        "first_transaction_date", "last_transaction_date", "estimated_ltv",
        R.ltv_category("estimated_ltv").alias("ltv_category"),
        "composite_risk_score",
        R.risk_level("composite_risk_score").alias("risk_level"),
        "preferred_payment_method", "payment_methods_used", "preferred_category",
        "categories_purchased", "high_value_transactions", "weekend_transactions",
        "night_transactions",
        R.engagement_level("transaction_days", "last_activity_at", cfg.as_of).alias("engagement_level"),
        R.recency_score("last_transaction_date", cfg.as_of).alias("recency_score"),
        R.frequency_score("total_transactions_detailed").alias("frequency_score"),
        R.monetary_score("total_revenue_usd").alias("monetary_score"),
        R.ts_ntz(cfg.run_timestamp).alias("processed_at"),
    )
