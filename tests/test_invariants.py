"""Cross-table invariants on the shared tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E

from .conftest import SF_SMALL

SF = SF_SMALL.replace("0.001", "0.01")


def q(spark, name):
    return E.queries()[name](spark, SF)


def test_gold_rows_equal_silver_rows_with_transactions(spark):
    silver = q(spark, "silver_customers")
    assert q(spark, "gold_customer_analytics").count() == silver.where("total_transactions > 0").count()


def test_payment_counts_sum_to_daily_counts(spark):
    m = q(spark, "gold_business_metrics")
    pay = (m.where(F.col("metric_type") == "payment_performance").groupBy("metric_date")
           .agg(F.sum("metric_value").alias("n")))
    rev = m.where(F.col("metric_type") == "revenue").select("metric_date", F.col("supporting_metric_1").alias("n"))
    assert pay.exceptAll(rev).count() == 0 and rev.exceptAll(pay).count() == 0


def test_category_revenue_is_completed_revenue(spark):
    m = q(spark, "gold_business_metrics")
    cat = (m.where(F.col("metric_type") == "category_performance").groupBy("metric_date")
           .agg(F.sum(F.col("metric_value").cast("decimal(18,4)")).alias("r")))
    aov = q(spark, "aov_daily").select(F.col("transaction_date").alias("metric_date"),
                                      F.col("revenue_usd").cast("decimal(18,4)").alias("r"))
    assert cat.exceptAll(aov).count() == 0 and aov.exceptAll(cat).count() == 0


def test_closed_stream_sessions_are_batch_sessions(spark):
    cols = ["customer_id", "session_start", "session_end", "n_events"]
    streamed = q(spark, "stream_sessions").select(*cols)
    batch = q(spark, "silver_sessions").select(*cols)
    assert streamed.count() > 0 and streamed.exceptAll(batch).count() == 0


def test_approximate_distinct_counts_are_close(spark):
    from goldvein.operators import gold_customer as GC
    from goldvein.operators import gold_metrics as GM
    from goldvein.plans.catalog import L
    stx = L(spark, SF).silver_tx
    exact = {r.transaction_date: r.unique_customers for r in GM.daily_transactions(stx).collect()}
    approx = {r.transaction_date: r.unique_customers for r in GM.daily_transactions(stx, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[d] - exact[d]) <= max(1, 0.05 * exact[d]) for d in exact)
    a = {r.customer_id: r.transaction_days for r in GC.transaction_metrics(stx, approx=True).collect()}
    e = {r.customer_id: r.transaction_days for r in GC.transaction_metrics(stx).collect()}
    assert all(abs(a[c] - e[c]) <= max(1, 0.05 * e[c]) for c in e)
