"""Registered data-product queries (K1-K10) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import products as P
from ..operators import silver as S
from ..session import scratch_path
from .catalog import L, query, stat6
from .oracle_ctes import cte, with_ctes, xavg, xsum

HUNDRED = "CAST(100.0 AS DOUBLE)"

cte("month_tx", """
SELECT *, CAST(date_trunc('month', transaction_date) AS DATE) AS month FROM completed_tx
""", "completed_tx")


@query("silver_products", with_ctes("""
SELECT a.product_id, l.category, l.latest_price, a.events, a.views, a.add_to_carts, a.removes_from_cart,
  a.purchases, a.reviews, a.units_purchased, a.avg_rating, a.unique_customers, a.first_event_at, a.last_event_at
FROM (SELECT product_id, COUNT(*) AS events,
        COUNT(CASE WHEN action = 'view' THEN 1 END) AS views,
        COUNT(CASE WHEN action = 'add_to_cart' THEN 1 END) AS add_to_carts,
        COUNT(CASE WHEN action = 'remove_from_cart' THEN 1 END) AS removes_from_cart,
        COUNT(CASE WHEN action = 'purchase' THEN 1 END) AS purchases,
        COUNT(CASE WHEN action = 'review' THEN 1 END) AS reviews,
        CAST(COALESCE(SUM(CASE WHEN action = 'purchase' THEN quantity END), 0) AS BIGINT) AS units_purchased,
        AVG(rating) AS avg_rating, COUNT(DISTINCT customer_id) AS unique_customers,
        MIN(ts) AS first_event_at, MAX(ts) AS last_event_at
      FROM (SELECT *, CAST(timestamp AS TIMESTAMP) AS ts FROM bronze_product_events WHERE product_id IS NOT NULL) p
      GROUP BY product_id) a
JOIN (SELECT product_id, category, price AS latest_price FROM (
        SELECT product_id, category, price, ROW_NUMBER() OVER (PARTITION BY product_id
          ORDER BY CAST(timestamp AS TIMESTAMP) DESC, event_id DESC, price DESC, category DESC) AS rn
        FROM bronze_product_events WHERE product_id IS NOT NULL) x WHERE rn = 1) l
  ON a.product_id = l.product_id""", "bronze_product_events"))
def q_silver_products(spark, sf_dir):
    return P.silver_products(L(spark, sf_dir).bronze.product_events)


@query("silver_sessions", with_ctes("""
SELECT customer_id, first_event AS session_start, last_event + INTERVAL 30 MINUTE AS session_end, n_events,
  first_event, last_event, CAST(date_diff('microsecond', first_event, last_event) AS DOUBLE) / CAST(1000000.0 AS DOUBLE) AS duration_seconds,
  n_actions, device_type
FROM (
  SELECT customer_id, sid, COUNT(*) AS n_events, MIN(ts) AS first_event, MAX(ts) AS last_event,
    COUNT(DISTINCT action) AS n_actions, MIN(device_type) AS device_type
  FROM (
    SELECT *, SUM(new_session) OVER (PARTITION BY customer_id ORDER BY ts
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
    FROM (
      SELECT customer_id, ts, action, device_type,
        CASE WHEN LAG(ts) OVER (PARTITION BY customer_id ORDER BY ts) IS NULL
               OR ts - LAG(ts) OVER (PARTITION BY customer_id ORDER BY ts) > INTERVAL 30 MINUTE
             THEN 1 ELSE 0 END AS new_session
      FROM (SELECT customer_id, action, device_type, CAST(timestamp AS TIMESTAMP) AS ts
            FROM bronze_customer_events WHERE customer_id IS NOT NULL) e) g) s
  GROUP BY customer_id, sid) x""", "bronze_customer_events"))
def q_silver_sessions(spark, sf_dir):
    layers = L(spark, sf_dir)
    return P.silver_sessions(layers.bronze.customer_events, layers.cfg.session_gap)


@query("cohort_retention", with_ctes(f"""
SELECT k.cohort_month, k.months_since, k.active_customers, s.cohort_size,
  CAST(k.active_customers AS DOUBLE) / s.cohort_size * {HUNDRED} AS retention_pct
FROM (SELECT c.cohort_month,
        CAST((year(a.month) - year(c.cohort_month)) * 12 + month(a.month) - month(c.cohort_month) AS INTEGER) AS months_since,
        COUNT(*) AS active_customers
      FROM (SELECT DISTINCT customer_id, month FROM month_tx) a
      JOIN (SELECT customer_id, MIN(month) AS cohort_month FROM month_tx GROUP BY customer_id) c
        ON a.customer_id = c.customer_id
      GROUP BY 1, 2) k
JOIN (SELECT cohort_month, COUNT(*) AS cohort_size FROM
        (SELECT customer_id, MIN(month) AS cohort_month FROM month_tx GROUP BY customer_id) z
      GROUP BY cohort_month) s ON k.cohort_month = s.cohort_month""", "month_tx"))
def q_cohort_retention(spark, sf_dir):
    return P.cohort_retention(L(spark, sf_dir).silver_tx)


@query("revenue_attribution", with_ctes(f"""
SELECT transaction_date, COALESCE(dev, 'unknown') AS device_type, {xsum('amount_usd')} AS revenue_usd,
  COUNT(*) AS transactions, COUNT(DISTINCT customer_id) AS customers
FROM (
  SELECT *, LAST_VALUE(device_type IGNORE NULLS) OVER (PARTITION BY customer_id ORDER BY ts, kind, tb
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dev
  FROM (
    SELECT customer_id, CAST(timestamp AS TIMESTAMP) AS ts, 0 AS kind, event_id AS tb, device_type,
      CAST(NULL AS DOUBLE) AS amount_usd, CAST(NULL AS DATE) AS transaction_date
    FROM bronze_customer_events WHERE customer_id IS NOT NULL
    UNION ALL
    SELECT customer_id, transaction_timestamp, 1, NULL, NULL, amount_usd, transaction_date FROM completed_tx) u) f
WHERE kind = 1
GROUP BY 1, 2""", "bronze_customer_events", "completed_tx"))
def q_revenue_attribution(spark, sf_dir):
    layers = L(spark, sf_dir)
    return P.revenue_attribution(layers.silver_tx, layers.bronze.customer_events)


@query("aov_daily", with_ctes(f"""
SELECT transaction_date, {xsum('amount_usd')} AS revenue_usd, COUNT(*) AS orders,
  {xsum('amount_usd')} / COUNT(*) AS aov
FROM completed_tx GROUP BY transaction_date""", "completed_tx"))
def q_aov_daily(spark, sf_dir):
    return P.aov_daily(L(spark, sf_dir).silver_tx)


@query("revenue_growth", with_ctes(f"""
SELECT m.month, m.revenue_usd, p.revenue_usd AS prev_month_revenue,
  CASE WHEN p.revenue_usd > 0 THEN (m.revenue_usd - p.revenue_usd) / p.revenue_usd * {HUNDRED} END AS mom_growth_pct,
  y.revenue_usd AS prev_year_revenue,
  CASE WHEN y.revenue_usd > 0 THEN (m.revenue_usd - y.revenue_usd) / y.revenue_usd * {HUNDRED} END AS yoy_growth_pct
FROM (SELECT month, {xsum('amount_usd')} AS revenue_usd FROM month_tx GROUP BY month) m
LEFT JOIN (SELECT month, {xsum('amount_usd')} AS revenue_usd FROM month_tx GROUP BY month) p
  ON m.month = CAST(p.month + INTERVAL 1 MONTH AS DATE)
LEFT JOIN (SELECT month, {xsum('amount_usd')} AS revenue_usd FROM month_tx GROUP BY month) y
  ON m.month = CAST(y.month + INTERVAL 12 MONTH AS DATE)""", "month_tx"))
def q_revenue_growth(spark, sf_dir):
    return P.revenue_growth(L(spark, sf_dir).silver_tx)


@query("mrr_monthly", with_ctes("""
SELECT month,
  CAST(COALESCE(SUM(CASE WHEN rep THEN rev END), 0) AS DOUBLE) AS mrr,
  COUNT(CASE WHEN rep THEN 1 END) AS recurring_customers,
  COUNT(*) AS active_customers,
  CAST(SUM(rev) AS DOUBLE) AS total_revenue_usd
FROM (SELECT cm.*, p.customer_id IS NOT NULL AS rep
      FROM (SELECT customer_id, month, SUM(CAST(amount_usd AS DECIMAL(18,4))) AS rev FROM month_tx GROUP BY 1, 2) cm
      LEFT JOIN (SELECT DISTINCT customer_id, month FROM month_tx) p
        ON cm.customer_id = p.customer_id AND cm.month = CAST(p.month + INTERVAL 1 MONTH AS DATE)) j
GROUP BY month""", "month_tx"))
def q_mrr_monthly(spark, sf_dir):
    return P.mrr_monthly(L(spark, sf_dir).silver_tx)


@query("churn_by_segment", with_ctes(f"""
SELECT s.customer_segment, COUNT(*) AS customers,
  COUNT(CASE WHEN l.last_date < DATE '2024-01-01' THEN 1 END) AS churned,
  CAST(COUNT(CASE WHEN l.last_date < DATE '2024-01-01' THEN 1 END) AS DOUBLE) / COUNT(*) * {HUNDRED} AS churn_rate_pct
FROM (SELECT customer_id, MAX(transaction_date) AS last_date FROM completed_tx GROUP BY customer_id) l
JOIN (SELECT customer_id, CASE WHEN SUM(amount) >= 1000 THEN 'High Value' WHEN SUM(amount) >= 100 THEN 'Medium Value'
        ELSE 'Low Value' END AS customer_segment
      FROM bronze_transaction_events WHERE customer_id IS NOT NULL GROUP BY customer_id) s ON l.customer_id = s.customer_id
GROUP BY s.customer_segment""", "completed_tx", "bronze_transaction_events"))
def q_churn_by_segment(spark, sf_dir):
    layers = L(spark, sf_dir)
    return P.churn_by_segment(layers.silver_tx, S.customer_transaction_summary(layers.bronze.transaction_events, layers.cfg),
                              layers.cfg)


@query("rfm_segments", with_ctes(f"""
SELECT rfm_segment, COUNT(*) AS customers, MIN(t) AS min_total, MAX(t) AS max_total,
  {xsum('total_revenue_usd')} AS revenue_usd
FROM (SELECT *, recency_score + frequency_score + monetary_score AS t,
        CASE WHEN recency_score + frequency_score + monetary_score >= 13 THEN 'Champions'
             WHEN recency_score + frequency_score + monetary_score >= 10 THEN 'Loyal'
             WHEN recency_score + frequency_score + monetary_score >= 7 THEN 'Potential'
             WHEN recency_score + frequency_score + monetary_score >= 5 THEN 'At Risk'
             ELSE 'Hibernating' END AS rfm_segment
      FROM (SELECT DISTINCT customer_id, recency_score, frequency_score, monetary_score, total_revenue_usd
            FROM gold_customer_analytics) pc) l
GROUP BY rfm_segment""", "gold_customer_analytics"))
def q_rfm_segments(spark, sf_dir):
    return P.rfm_segments(L(spark, sf_dir).gold_cust)


@query("system_log_metrics", with_ctes(f"""
SELECT service, date_trunc('hour', CAST(timestamp AS TIMESTAMP)) AS hour, COUNT(*) AS requests,
  COUNT(CASE WHEN level = 'ERROR' THEN 1 END) AS errors,
  COUNT(CASE WHEN status_code >= 500 THEN 1 END) AS server_errors,
  {xavg('response_time_ms', 'DECIMAL(38,0)')} AS avg_response_ms,
  CAST(CAST(quantile_cont(response_time_ms, 0.95) AS DECIMAL(20,6)) AS DOUBLE) AS p95_response_ms,
  CAST(COUNT(CASE WHEN level = 'ERROR' THEN 1 END) AS DOUBLE) / COUNT(*) * {HUNDRED} AS error_rate_pct,
  CAST(COUNT(CASE WHEN status_code >= 500 THEN 1 END) AS DOUBLE) / COUNT(*) * {HUNDRED} AS server_error_rate_pct
FROM bronze_system_logs GROUP BY 1, 2""", "bronze_system_logs"))
def q_system_log_metrics(spark, sf_dir):
    df = P.system_log_metrics(L(spark, sf_dir).bronze.system_logs)
    return df.select(*[stat6(c) if c == "p95_response_ms" else c for c in df.columns])


@query("latency_sketches", with_ctes("""
SELECT service, CAST(CAST(timestamp AS TIMESTAMP) AS DATE) AS day, COUNT(*) AS requests, true AS within_error
FROM bronze_system_logs GROUP BY 1, 2""", "bronze_system_logs"))
def q_latency_sketches(spark, sf_dir):
    """Daily latencies from stored hourly sketches; each one's true rank is within twice the sketch's error."""
    logs = L(spark, sf_dir).bronze.system_logs
    store = scratch_path(spark, "latency")
    P.latency_sketches(logs).write.parquet(store)
    at, error = (0.5, 0.95, 0.99), 2 * 0.0165
    days = P.latency_by_day(spark.read.parquet(store), at)
    rows = logs.select("service", F.to_date(R.to_ts("timestamp")).alias("day"), "response_time_ms").join(days, ["service", "day"])
    ms = F.col("response_time_ms")
    near = [(F.count(F.when(ms <= F.col("latencies")[i], 1)) >= (q - error) * F.count(ms))
            & (F.count(F.when(ms < F.col("latencies")[i], 1)) <= (q + error) * F.count(ms)) for i, q in enumerate(at)]
    return rows.groupBy("service", "day").agg(F.max("requests").alias("requests"), (near[0] & near[1] & near[2]).alias("within_error"))


@query("rfm_quintiles", with_ctes("""
SELECT customer_id, r_quintile, f_quintile, m_quintile, r_quintile + f_quintile + m_quintile AS rfm_quintile_total
FROM (SELECT customer_id,
        CAST(NTILE(5) OVER (ORDER BY last_transaction_date, customer_id) AS INTEGER) AS r_quintile,
        CAST(NTILE(5) OVER (ORDER BY total_transactions_detailed, customer_id) AS INTEGER) AS f_quintile,
        CAST(NTILE(5) OVER (ORDER BY total_revenue_usd, customer_id) AS INTEGER) AS m_quintile
      FROM transaction_metrics) q""", "transaction_metrics"))
def q_rfm_quintiles(spark, sf_dir):
    return P.rfm_quintiles(L(spark, sf_dir).tx_metrics)
