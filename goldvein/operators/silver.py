"""Silver layer: cleaned transactions (B1-B7) and the customer profile.

Plans are map-only where the rule is per row (silver_transactions has no
shuffle) and aggregate-then-join where it is per customer: each summary is
reduced with partial (map-side) aggregation before its shuffle, so a customer
holding a large share of events ships one partial row per task, not its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import PipelineConfig
from ..functions import rules as R

SILVER_TRANSACTION_COLUMNS = (
    "transaction_id", "customer_id", "amount", "amount_usd", "currency", "status",
    "payment_method", "merchant_id", "category", "fraud_score", "is_high_risk",
    "amount_category", "transaction_timestamp", "transaction_date", "transaction_hour",
    "day_of_week", "time_of_day", "day_type", "processed_at",
)


def clean_transactions(bronze_tx: DataFrame, cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """B1: drop rows without ids and amounts outside the open range (0, 100000)."""
    amount = F.col("amount")
    tol = cfg.tolerant_casts
    return (bronze_tx
            .where(F.col("transaction_id").isNotNull() & F.col("customer_id").isNotNull()
                   & (amount > C.AMOUNT_LOWER_BOUND) & (amount < C.AMOUNT_UPPER_BOUND))
            .select("transaction_id", "customer_id", "amount", "currency", "status",
                    "payment_method", "merchant_id", "category", "fraud_score",
                    R.to_ts("timestamp", tol).alias("transaction_timestamp"),
                    R.to_ts("processed_at", tol).alias("processed_at"))
            .withColumns({
                "transaction_date": F.to_date("transaction_timestamp"),
                "transaction_hour": F.hour("transaction_timestamp"),
                "day_of_week": R.weekday_sunday0("transaction_timestamp"),
            }))


def silver_transactions(bronze_tx: DataFrame, cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """B7 = B1 + risk flag, amount band, time of day, day type, USD amount."""
    enriched = clean_transactions(bronze_tx, cfg).withColumns({
        "is_high_risk": R.is_high_risk("fraud_score", cfg.fraud_score_threshold),
        "amount_category": R.amount_category("amount", cfg.high_value_transaction_threshold),
        "time_of_day": R.time_of_day("transaction_hour"),
        "day_type": R.day_type("day_of_week"),
        "amount_usd": R.to_usd("amount", "currency", cfg.usd_rates),
    })
    return enriched.select(*SILVER_TRANSACTION_COLUMNS)


def valid_customers(bronze_cust: DataFrame) -> DataFrame:
    """customer events with an id and an email that has an '@'."""
    return bronze_cust.where(F.col("customer_id").isNotNull() & F.col("email").isNotNull() & F.col("email").contains("@"))


def customer_activity(bronze_cust: DataFrame, cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """Grain customer_id x email x country x device_type."""
    ts = R.to_ts("timestamp", cfg.tolerant_casts)
    return (valid_customers(bronze_cust)
            .groupBy("customer_id", "email", "country", "device_type")
            .agg(F.min(ts).alias("first_seen"),
                 F.max(ts).alias("last_seen"),
                 F.count(F.lit(1)).alias("total_events"),
                 F.countDistinct(F.to_date(ts)).alias("active_days")))


def customer_transaction_summary(bronze_tx: DataFrame, cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """Per customer over raw bronze (local currency, every status, no amount filter)."""
    return (bronze_tx
            .where(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("total_transactions"),
                 R.exact_sum("amount", R.MONEY_RAW).alias("total_spent"),
                 R.exact_avg("amount", R.MONEY_RAW).alias("avg_transaction_value"),
                 F.max("amount").alias("max_transaction_value"),
                 R.count_when(F.col("status") == "completed").alias("successful_transactions"),
                 # strict ">" here, ">=" in silver_transactions: both kept as in the reference
                 R.count_when(F.col("fraud_score") > cfg.fraud_score_threshold).alias("high_risk_transactions"),
                 F.max(R.to_ts("timestamp", cfg.tolerant_casts)).alias("last_transaction_date")))


def customer_product_summary(bronze_prod: DataFrame) -> DataFrame:
    """Distinct products touched, purchases, average rating."""
    return (bronze_prod
            .where(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.countDistinct("product_id").alias("unique_products_viewed"),
                 R.count_when(F.col("action") == "purchase").alias("products_purchased"),
                 F.avg("rating").alias("avg_rating_given")))


SILVER_CUSTOMER_COLUMNS = (
    "customer_id", "email", "country", "device_type", "created_at", "last_activity_at",
    "total_events", "active_days", "total_transactions", "total_spent", "avg_transaction_value",
    "max_transaction_value", "successful_transactions", "high_risk_transactions",
    "last_transaction_date", "unique_products_viewed", "products_purchased", "avg_rating_given",
    "success_rate_pct", "customer_status", "customer_segment", "processed_at",
)


def silver_customers(bronze_cust: DataFrame, bronze_tx: DataFrame, bronze_prod: DataFrame,
                     cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """B14 from bronze; see ``profiles``."""
    return profiles(customer_activity(bronze_cust, cfg), customer_transaction_summary(bronze_tx, cfg),
                    customer_product_summary(bronze_prod), cfg)


def profiles(ce: DataFrame, ct: DataFrame, cp: DataFrame, cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """B14 = B8 left join B9 left join B10, then B11-B13.

    Transaction counts and sums default to 0; last_transaction_date and
    avg_rating_given stay NULL. The segment reads the un-defaulted total, so a
    customer without transactions is 'Low Value'.
    """
    joined = ce.join(ct, "customer_id", "left").join(cp, "customer_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = joined.select(
        "customer_id", "email", "country", "device_type",
        F.col("first_seen").alias("created_at"),
        F.col("last_seen").alias("last_activity_at"),
        "total_events", "active_days",
        zero("total_transactions").alias("total_transactions"),
        F.coalesce(F.col("total_spent"), F.lit(0.0)).alias("total_spent"),
        F.coalesce(F.col("avg_transaction_value"), F.lit(0.0)).alias("avg_transaction_value"),
        F.coalesce(F.col("max_transaction_value"), F.lit(0.0)).alias("max_transaction_value"),
        zero("successful_transactions").alias("successful_transactions"),
        zero("high_risk_transactions").alias("high_risk_transactions"),
        "last_transaction_date",
        zero("unique_products_viewed").alias("unique_products_viewed"),
        zero("products_purchased").alias("products_purchased"),
        "avg_rating_given",
        R.success_rate_pct("successful_transactions", "total_transactions").alias("success_rate_pct"),
        R.customer_status("last_seen", cfg.as_of, cfg.active_customer_days).alias("customer_status"),
        R.customer_segment("total_spent", cfg.high_value_transaction_threshold).alias("customer_segment"),
        R.ts_ntz(cfg.run_timestamp).alias("processed_at"),
    )
    if cfg.one_row_per_customer:
        out = latest_profile_per_customer(out)
    return out


def latest_profile_per_customer(silver_cust: DataFrame) -> DataFrame:
    """Optional fix for the 4-column grain: keep the profile row seen last.

    Ties on last_activity_at are broken by the remaining profile columns so the
    result does not depend on row order.
    """
    key = F.struct("last_activity_at", "email", "country", "device_type")
    others = [c for c in silver_cust.columns if c != "customer_id"]
    best = F.max_by(F.struct(*others), key)
    return (silver_cust.groupBy("customer_id").agg(best.alias("p"))
            .select("customer_id", *[F.col(f"p.{c}").alias(c) for c in others]))
