"""Gold business metrics (B26-B35): one long table of daily KPIs.

Shape of the plan:
- silver transactions are first summed to (date, category, payment method);
  the daily, date x category and date x payment aggregates come from one
  GROUPING SETS pass over that small cube, so no raw row is multiplied; every
  aggregated row becomes its long-format rows with ``inline`` (the reference
  scans the table three times and reads the daily CTE three times).
- country rows pre-aggregate completed transactions to (date, customer)
  before joining the customer profile, so the join never sees raw rows and a
  hot customer contributes one row per day.
All money sums are exact DECIMAL sums reported as DOUBLE.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import PipelineConfig
from ..functions import rules as R

LONG_COLUMNS = ("metric_date", "metric_type", "dimension_type", "dimension_value",
                "metric_value", "supporting_metric_1", "supporting_metric_2")


def daily_transactions(silver_tx: DataFrame, approx: bool = False) -> DataFrame:
    """Per transaction_date over all statuses (``approx``: sketch for unique customers)."""
    return (silver_tx.groupBy("transaction_date")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 R.exact_sum("amount_usd").alias("total_revenue"),
                 R.exact_avg("amount_usd").alias("avg_transaction_value"),
                 R.distinct_count("customer_id", approx).alias("unique_customers"),
                 R.count_when(F.col("is_high_risk")).alias("high_risk_count"),
                 R.count_when(F.col("status") == "completed").alias("successful_count"),
                 R.count_when(F.col("status") == "failed").alias("failed_count")))


def daily_customers(silver_cust: DataFrame) -> DataFrame:
    """Silver rows by signup date (rows, not distinct customers, as the reference)."""
    return (silver_cust.groupBy(F.to_date("created_at").alias("signup_date"))
            .agg(F.count(F.lit(1)).alias("new_customers"),
                 R.count_when(F.col("customer_segment") == "High Value").alias("high_value_signups")))


def _row(date_col: str, metric_type: str, dimension_value: Column | str,
         value: Column, s1: Column | None, s2: Column | None) -> Column:
    """One long-format row as a struct; a str dimension is a constant label."""
    dbl = lambda c: (F.lit(None) if c is None else c).cast("double")
    dim = F.lit(dimension_value) if isinstance(dimension_value, str) else dimension_value
    return F.struct(
        F.col(date_col).alias("metric_date"),
        F.lit(metric_type).alias("metric_type"),
        F.lit("daily").alias("dimension_type"),
        dim.alias("dimension_value"),
        dbl(value).alias("metric_value"),
        dbl(s1).alias("supporting_metric_1"),
        dbl(s2).alias("supporting_metric_2"),
    )


def _pct(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part).cast("double") / F.col(whole) * F.lit(100.0)) \
        .otherwise(F.lit(0.0))


def _revenue_row() -> Column:
    return _row("transaction_date", "revenue", "total", F.col("total_revenue"),
                F.col("transaction_count"), F.col("avg_transaction_value"))


def _conversion_row() -> Column:
    return _row("transaction_date", "conversion", "success_rate",
                _pct("successful_count", "transaction_count"),
                F.col("successful_count"), F.col("failed_count"))


def _risk_row() -> Column:
    return _row("transaction_date", "risk", "high_risk_percentage",
                _pct("high_risk_count", "transaction_count"),
                F.col("high_risk_count"), F.col("transaction_count"))


def _explode_rows(df: DataFrame, rows: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*rows))).select(*LONG_COLUMNS)


def revenue_metrics(daily: DataFrame) -> DataFrame:
    """value = revenue; supports = count, average."""
    return _explode_rows(daily, [_revenue_row()])


def conversion_metrics(daily: DataFrame) -> DataFrame:
    """value = completed / count x 100; supports = completed, failed."""
    return _explode_rows(daily, [_conversion_row()])


def risk_metrics(daily: DataFrame) -> DataFrame:
    """value = high-risk / count x 100; supports = high-risk, count."""
    return _explode_rows(daily, [_risk_row()])


def acquisition_metrics(daily_cust: DataFrame) -> DataFrame:
    """value = new silver rows; supports = High Value rows, NULL."""
    return _explode_rows(daily_cust, [_row("signup_date", "acquisition", "new_customers",
                                           F.col("new_customers"), F.col("high_value_signups"), None)])


def category_metrics(silver_tx: DataFrame) -> DataFrame:
    """Completed only; per date x category revenue, count, average."""
    agg = (silver_tx.where(F.col("status") == "completed")
           .groupBy("transaction_date", "category")
           .agg(R.exact_sum("amount_usd").alias("revenue"),
                F.count(F.lit(1)).alias("n"),
                R.exact_avg("amount_usd").alias("avg_usd")))
    return _explode_rows(agg, [_row("transaction_date", "category_performance", F.col("category"),
                                    F.col("revenue"), F.col("n"), F.col("avg_usd"))])


def payment_metrics(silver_tx: DataFrame) -> DataFrame:
    """All statuses; value = count; supports = revenue, completed count."""
    agg = (silver_tx.groupBy("transaction_date", "payment_method")
           .agg(F.count(F.lit(1)).alias("n"),
                R.exact_sum("amount_usd").alias("revenue"),
                R.count_when(F.col("status") == "completed").alias("completed")))
    return _explode_rows(agg, [_row("transaction_date", "payment_performance", F.col("payment_method"),
                                    F.col("n"), F.col("revenue"), F.col("completed"))])


def completed_by_day_and_customer(silver_tx: DataFrame) -> DataFrame:
    """(transaction_date, customer_id, revenue, n) of completed transactions; revenue is an exact decimal."""
    return (silver_tx.where(F.col("status") == "completed")
            .groupBy("transaction_date", "customer_id")
            .agg(R.exact_sum("amount_usd", as_double=False).cast("decimal(38,4)").alias("revenue"),
                 F.count(F.lit(1)).alias("n")))


def country_metrics(silver_tx: DataFrame, silver_cust: DataFrame) -> DataFrame:
    """Completed transactions x silver customer rows (inner join, fans out per
    profile row as the reference does); value = revenue; supports = distinct
    customers, joined rows.

    Transactions are first reduced to one row per (date, customer) with an
    exact decimal sum, then joined; re-summing decimals keeps the total exact.
    """
    return _country_rows(completed_by_day_and_customer(silver_tx), silver_cust)


def _country_rows(per_day_customer: DataFrame, silver_cust: DataFrame) -> DataFrame:
    profiles = silver_cust.select("customer_id", "country")
    agg = (per_day_customer.join(profiles, "customer_id")
           .groupBy("transaction_date", "country")
           .agg(F.sum("revenue").cast("double").alias("revenue"),
                F.countDistinct("customer_id").alias("customers"),
                F.sum("n").alias("n")))
    return _explode_rows(agg, [_row("transaction_date", "country_performance", F.col("country"),
                                    F.col("revenue"), F.col("customers"), F.col("n"))])


CUBE_MEASURES = ("transaction_count", "usd", "high_risk_count", "successful_count", "failed_count", "completed_usd")


def daily_cube(silver_tx: DataFrame) -> DataFrame:
    """``CUBE_MEASURES`` per (transaction_date, category, payment_method); sums are exact decimals."""
    completed = F.col("status") == "completed"
    usd = F.col("amount_usd").cast(R.MONEY_BOUNDED)
    return silver_tx.groupBy("transaction_date", "category", "payment_method").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum(usd).cast("decimal(38,4)").alias("usd"),
        R.count_when(F.col("is_high_risk")).alias("high_risk_count"),
        R.count_when(completed).alias("successful_count"),
        R.count_when(F.col("status") == "failed").alias("failed_count"),
        F.sum(F.when(completed, usd)).cast("decimal(38,4)").alias("completed_usd"))


def daily_category_payment_rows(cube: DataFrame) -> DataFrame:
    """B28, B29, B31, B32, B33 from the daily cube.

    GROUPING SETS (date), (date, category), (date, payment_method) over the
    cube's sums; each output row is turned into its long rows by its grouping
    set. Category rows count completed transactions only and keep only groups
    that have one, as the per-grain aggregation does.
    """
    g = (cube
         .groupingSets([["transaction_date"], ["transaction_date", "category"],
                        ["transaction_date", "payment_method"]],
                       "transaction_date", "category", "payment_method")
         .agg(F.grouping("category").alias("g_cat"), F.grouping("payment_method").alias("g_pay"),
              *[F.sum(c).alias(c) for c in CUBE_MEASURES]))
    rev = F.col("usd").cast("double")
    done = F.col("completed_usd").cast("double")
    daily = (F.col("g_cat") == 1) & (F.col("g_pay") == 1)
    by_category = (F.col("g_cat") == 0) & (F.col("successful_count") > 0)
    by_payment = F.col("g_pay") == 0
    rows = (F.when(daily, F.array(
                _row("transaction_date", "revenue", "total", rev, F.col("transaction_count"),
                     rev / F.col("transaction_count")),
                _conversion_row(), _risk_row()))
            .when(by_category, F.array(
                _row("transaction_date", "category_performance", F.col("category"), done,
                     F.col("successful_count"), done / F.col("successful_count"))))
            .when(by_payment, F.array(
                _row("transaction_date", "payment_performance", F.col("payment_method"),
                     F.col("transaction_count"), rev, F.col("successful_count")))))
    return g.where(daily | by_category | by_payment).select(F.inline(rows)).select(*LONG_COLUMNS)


def gold_business_metrics(silver_tx: DataFrame, silver_cust: DataFrame,
                          cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """Union of revenue, conversion, acquisition, risk, category, payment, country rows.

    Silver transactions are scanned twice: once for the daily cube and once for
    the (date, customer) pre-aggregate that feeds the country join.
    """
    return business_metrics(daily_cube(silver_tx), completed_by_day_and_customer(silver_tx), silver_cust, cfg)


def business_metrics(cube: DataFrame, per_day_customer: DataFrame, silver_cust: DataFrame,
                     cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """B35 from the two pre-aggregates, however they were made."""
    parts = [
        daily_category_payment_rows(cube),
        acquisition_metrics(daily_customers(silver_cust)),
        _country_rows(per_day_customer, silver_cust),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("processed_at", R.ts_ntz(cfg.run_timestamp))
