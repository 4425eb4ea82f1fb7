"""Registry of the checkable queries: one Spark plan and one DuckDB oracle each.

Every query reads the shared driver tables (through the bronze mapping) and
runs over them whole. ``QUERIES[name](spark, sf_dir)`` returns a lazy
DataFrame; ``ORACLES[name]`` is ANSI SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions import rules as R
from ..operators import gold_customer as GC
from ..operators import gold_metrics as GM
from ..operators import silver as S
from ..sources.driver_tables import load_bronze
from .oracle_ctes import with_ctes, xsum

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


class Layers:
    """Lazily built bronze/silver/gold DataFrames for one driver-table folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: PipelineConfig = DEFAULT):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg
        self.bronze = load_bronze(spark, sf_dir)

    @cached_property
    def silver_tx(self) -> DataFrame:
        return S.silver_transactions(self.bronze.transaction_events, self.cfg)

    @cached_property
    def silver_cust(self) -> DataFrame:
        b = self.bronze
        return S.silver_customers(b.customer_events, b.transaction_events, b.product_events, self.cfg)

    @cached_property
    def tx_metrics(self) -> DataFrame:
        return GC.with_risk_score(GC.with_lifetime_value(GC.transaction_metrics(self.silver_tx)))

    @cached_property
    def gold_cust(self) -> DataFrame:
        return GC.gold_customer_analytics(self.silver_cust, self.silver_tx, self.cfg)

    @cached_property
    def daily(self) -> DataFrame:
        return GM.daily_transactions(self.silver_tx)


def L(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(spark, sf_dir)


def stat6(c: str) -> F.Column:
    """A floating statistic shown to 6 decimals for cross-engine comparison."""
    return F.col(c).cast("decimal(20,6)").cast("double").alias(c)


# ---- silver transactions -------------------------------------------------------------------

@query("silver_transactions", with_ctes("SELECT * FROM silver_transactions", "silver_transactions"))
def q_silver_transactions(spark, sf_dir):
    return L(spark, sf_dir).silver_tx


@query("silver_transactions_filters", with_ctes("""
SELECT COUNT(*) AS rows_in,
  COUNT(CASE WHEN transaction_id IS NULL THEN 1 END) AS null_transaction_id,
  COUNT(CASE WHEN customer_id IS NULL THEN 1 END) AS null_customer_id,
  COUNT(CASE WHEN amount <= 0 THEN 1 END) AS non_positive_amount,
  COUNT(CASE WHEN amount >= 100000 THEN 1 END) AS outlier_amount,
  (SELECT COUNT(*) FROM silver_transactions) AS rows_out
FROM bronze_transaction_events""", "bronze_transaction_events", "silver_transactions"))
def q_silver_transactions_filters(spark, sf_dir):
    a = F.col("amount")
    tid, cid = F.col("transaction_id"), F.col("customer_id")
    return L(spark, sf_dir).bronze.transaction_events.agg(
        F.count(F.lit(1)).alias("rows_in"),
        R.count_when(tid.isNull()).alias("null_transaction_id"),
        R.count_when(cid.isNull()).alias("null_customer_id"),
        R.count_when(a <= 0).alias("non_positive_amount"),
        R.count_when(a >= 100000).alias("outlier_amount"),
        R.count_when(tid.isNotNull() & cid.isNotNull() & (a > 0) & (a < 100000)).alias("rows_out"))


@query("risk_flag_counts", with_ctes("""
SELECT is_high_risk, COUNT(*) AS n, MIN(fraud_score) AS min_fraud_score, MAX(fraud_score) AS max_fraud_score,
  COUNT(CASE WHEN fraud_score = 0.7 THEN 1 END) AS at_threshold
FROM silver_transactions GROUP BY is_high_risk""", "silver_transactions"))
def q_risk_flag_counts(spark, sf_dir):
    return (L(spark, sf_dir).silver_tx.groupBy("is_high_risk")
            .agg(F.count(F.lit(1)).alias("n"), F.min("fraud_score").alias("min_fraud_score"),
                 F.max("fraud_score").alias("max_fraud_score"),
                 R.count_when(F.col("fraud_score") == 0.7).alias("at_threshold")))


@query("amount_category_counts", with_ctes(f"""
SELECT amount_category, COUNT(*) AS n, {xsum('amount')} AS total_amount,
  MIN(amount) AS min_amount, MAX(amount) AS max_amount
FROM silver_transactions GROUP BY amount_category""", "silver_transactions"))
def q_amount_category_counts(spark, sf_dir):
    return (L(spark, sf_dir).silver_tx.groupBy("amount_category")
            .agg(F.count(F.lit(1)).alias("n"), R.exact_sum("amount").alias("total_amount"),
                 F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount")))


@query("time_of_day_day_type", with_ctes("""
SELECT time_of_day, day_type, COUNT(*) AS n, MIN(transaction_hour) AS min_hour, MAX(transaction_hour) AS max_hour,
  MIN(day_of_week) AS min_dow, MAX(day_of_week) AS max_dow
FROM silver_transactions GROUP BY time_of_day, day_type""", "silver_transactions"))
def q_time_of_day_day_type(spark, sf_dir):
    return (L(spark, sf_dir).silver_tx.groupBy("time_of_day", "day_type")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.min("transaction_hour").alias("min_hour"), F.max("transaction_hour").alias("max_hour"),
                 F.min("day_of_week").alias("min_dow"), F.max("day_of_week").alias("max_dow")))


@query("usd_conversion", with_ctes(f"""
SELECT currency, COUNT(*) AS n, {xsum('amount')} AS total_amount, {xsum('amount_usd')} AS total_amount_usd
FROM silver_transactions GROUP BY currency""", "silver_transactions"))
def q_usd_conversion(spark, sf_dir):
    return (L(spark, sf_dir).silver_tx.groupBy("currency")
            .agg(F.count(F.lit(1)).alias("n"), R.exact_sum("amount").alias("total_amount"),
                 R.exact_sum("amount_usd").alias("total_amount_usd")))


# ---- silver customers ----------------------------------------------------------------------

@query("customer_activity", with_ctes("SELECT * FROM customer_activity", "customer_activity"))
def q_customer_activity(spark, sf_dir):
    return S.customer_activity(L(spark, sf_dir).bronze.customer_events)


@query("customer_transaction_summary",
       with_ctes("SELECT * FROM customer_transaction_summary", "customer_transaction_summary"))
def q_customer_transaction_summary(spark, sf_dir):
    return S.customer_transaction_summary(L(spark, sf_dir).bronze.transaction_events)


@query("customer_product_summary", with_ctes("SELECT * FROM customer_product_summary", "customer_product_summary"))
def q_customer_product_summary(spark, sf_dir):
    return S.customer_product_summary(L(spark, sf_dir).bronze.product_events)


@query("silver_customers", with_ctes("SELECT * FROM silver_customers", "silver_customers"))
def q_silver_customers(spark, sf_dir):
    return L(spark, sf_dir).silver_cust.drop("processed_at")


@query("customer_status_segment", with_ctes("""
SELECT customer_status, customer_segment, COUNT(*) AS n_rows, COUNT(DISTINCT customer_id) AS n_customers
FROM silver_customers GROUP BY customer_status, customer_segment""", "silver_customers"))
def q_customer_status_segment(spark, sf_dir):
    return (L(spark, sf_dir).silver_cust.groupBy("customer_status", "customer_segment")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("customer_id").alias("n_customers")))


# ---- gold customer -------------------------------------------------------------------------

_TM_COLS = ("customer_id, total_transactions_detailed, total_revenue_usd, avg_transaction_usd, "
            "CAST(CAST(transaction_stddev AS DECIMAL(20,6)) AS DOUBLE) AS transaction_stddev, transaction_days, "
            "last_transaction_date, first_transaction_date, high_risk_transactions, avg_fraud_score, "
            "night_transactions, weekend_transactions, high_value_transactions, preferred_payment_method, "
            "payment_methods_used, preferred_category, categories_purchased")


@query("transaction_metrics", with_ctes(f"SELECT {_TM_COLS} FROM transaction_metrics", "transaction_metrics"))
def q_transaction_metrics(spark, sf_dir):
    tm = GC.transaction_metrics(L(spark, sf_dir).silver_tx)
    return tm.select(*[stat6(c) if c == "transaction_stddev" else c for c in tm.columns])


@query("preferred_modes", with_ctes("""
SELECT customer_id, preferred_payment_method, payment_methods_used, preferred_category, categories_purchased
FROM transaction_metrics""", "transaction_metrics"))
def q_preferred_modes(spark, sf_dir):
    return L(spark, sf_dir).tx_metrics.select(
        "customer_id", "preferred_payment_method", "payment_methods_used", "preferred_category",
        "categories_purchased")


@query("customer_ltv", with_ctes("""
SELECT customer_id, total_revenue_usd, transaction_days, daily_value, estimated_ltv,
  CASE WHEN estimated_ltv >= 5000 THEN 'High LTV' WHEN estimated_ltv >= 1000 THEN 'Medium LTV' ELSE 'Low LTV' END AS ltv_category
FROM customer_scores""", "customer_scores"))
def q_customer_ltv(spark, sf_dir):
    return L(spark, sf_dir).tx_metrics.select(
        "customer_id", "total_revenue_usd", "transaction_days", "daily_value", "estimated_ltv",
        R.ltv_category("estimated_ltv").alias("ltv_category"))


@query("composite_risk", with_ctes("""
SELECT customer_id, avg_fraud_score, high_risk_transactions, night_transactions, total_transactions_detailed,
  composite_risk_score,
  CASE WHEN composite_risk_score >= 0.7 THEN 'High Risk' WHEN composite_risk_score >= 0.4 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_level
FROM customer_scores""", "customer_scores"))
def q_composite_risk(spark, sf_dir):
    return L(spark, sf_dir).tx_metrics.select(
        "customer_id", "avg_fraud_score", "high_risk_transactions", "night_transactions",
        "total_transactions_detailed", "composite_risk_score",
        R.risk_level("composite_risk_score").alias("risk_level"))


@query("engagement_level", with_ctes("""
SELECT customer_id, email, country, device_type, transaction_days, last_activity_at, engagement_level
FROM gold_customer_analytics""", "gold_customer_analytics"))
def q_engagement_level(spark, sf_dir):
    return L(spark, sf_dir).gold_cust.select(
        "customer_id", "email", "country", "device_type", "transaction_days", "last_activity_at",
        "engagement_level")


@query("rfm_scores", with_ctes("""
SELECT customer_id, email, country, device_type, last_transaction_date, total_transactions_detailed,
  total_revenue_usd, recency_score, frequency_score, monetary_score
FROM gold_customer_analytics""", "gold_customer_analytics"))
def q_rfm_scores(spark, sf_dir):
    return L(spark, sf_dir).gold_cust.select(
        "customer_id", "email", "country", "device_type", "last_transaction_date",
        "total_transactions_detailed", "total_revenue_usd", "recency_score", "frequency_score",
        "monetary_score")


@query("gold_customer_analytics", with_ctes("SELECT * FROM gold_customer_analytics", "gold_customer_analytics"))
def q_gold_customer_analytics(spark, sf_dir):
    return L(spark, sf_dir).gold_cust.drop("processed_at")


# ---- gold business metrics ------------------------------------------------------------------

@query("daily_transactions", with_ctes("SELECT * FROM daily_transactions", "daily_transactions"))
def q_daily_transactions(spark, sf_dir):
    return L(spark, sf_dir).daily


@query("daily_customers", with_ctes("SELECT * FROM daily_customers", "daily_customers"))
def q_daily_customers(spark, sf_dir):
    return GM.daily_customers(L(spark, sf_dir).silver_cust)


@query("revenue_metrics", with_ctes("SELECT * FROM m_revenue", "m_revenue"))
def q_revenue_metrics(spark, sf_dir):
    return GM.revenue_metrics(L(spark, sf_dir).daily)


@query("conversion_metrics", with_ctes("SELECT * FROM m_conversion", "m_conversion"))
def q_conversion_metrics(spark, sf_dir):
    return GM.conversion_metrics(L(spark, sf_dir).daily)


@query("acquisition_metrics", with_ctes("SELECT * FROM m_acquisition", "m_acquisition"))
def q_acquisition_metrics(spark, sf_dir):
    return GM.acquisition_metrics(GM.daily_customers(L(spark, sf_dir).silver_cust))


@query("risk_metrics", with_ctes("SELECT * FROM m_risk", "m_risk"))
def q_risk_metrics(spark, sf_dir):
    return GM.risk_metrics(L(spark, sf_dir).daily)


@query("category_metrics", with_ctes("SELECT * FROM m_category", "m_category"))
def q_category_metrics(spark, sf_dir):
    return GM.category_metrics(L(spark, sf_dir).silver_tx)


@query("payment_metrics", with_ctes("SELECT * FROM m_payment", "m_payment"))
def q_payment_metrics(spark, sf_dir):
    return GM.payment_metrics(L(spark, sf_dir).silver_tx)


@query("country_metrics", with_ctes("SELECT * FROM m_country", "m_country"))
def q_country_metrics(spark, sf_dir):
    layers = L(spark, sf_dir)
    return GM.country_metrics(layers.silver_tx, layers.silver_cust)


@query("gold_business_metrics", with_ctes("SELECT * FROM gold_business_metrics", "gold_business_metrics"))
def q_gold_business_metrics(spark, sf_dir):
    layers = L(spark, sf_dir)
    return GM.gold_business_metrics(layers.silver_tx, layers.silver_cust, layers.cfg).drop("processed_at")


# Further registries add themselves to QUERIES / ORACLES on import.
from . import catalog_quality  # noqa: E402,F401
from . import catalog_streaming  # noqa: E402,F401
from . import catalog_products  # noqa: E402,F401
from . import catalog_incremental  # noqa: E402,F401
from . import catalog_layout  # noqa: E402,F401
