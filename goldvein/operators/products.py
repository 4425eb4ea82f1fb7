"""Data products the reference names without code (K1-K10); definitions are ours
(SURVEY §2.12) and written down in each docstring.

Scale notes: every per-customer product is reduced to at most one row per
(customer, day) or (customer, month) before any join, so a hot customer costs
a bounded number of rows after the map-side combine. Month-over-month and
previous-month lookups read their source once.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import PipelineConfig
from ..functions import rules as R
from .asof import asof_latest
from .ranking import global_ntiles
from .sessions import sessionize


def silver_products(bronze_prod: DataFrame, tolerant: bool = False) -> DataFrame:
    """K1: per product_id - latest category and price (latest by event time, then
    event_id, price, category), event counts per action, units purchased,
    average rating, distinct customers, first and last event time."""
    # The latest row is a struct with texts, which only a sorting aggregation can hold, so it is found apart
    # from the counters, which are hashed per (product, customer) first and then added up. Both sides are
    # dealt by product_id, so their join moves nothing.
    rows = bronze_prod.where(F.col("product_id").isNotNull()).withColumn("_ts", R.to_ts("timestamp", tolerant))
    latest = rows.groupBy("product_id").agg(F.max(F.struct(F.col("_ts"), "event_id", "price", "category")).alias("latest"))
    act = F.col("action")
    actions = {"views": "view", "add_to_carts": "add_to_cart", "removes_from_cart": "remove_from_cart",
               "purchases": "purchase", "reviews": "review"}
    by_customer = rows.groupBy("product_id", "customer_id").agg(
        F.count(F.lit(1)).alias("events"), *[R.count_when(act == a).alias(n) for n, a in actions.items()],
        F.sum(F.when(act == "purchase", F.col("quantity"))).alias("units"),
        F.sum("rating").alias("ratings"), F.count("rating").alias("rated"),
        F.min("_ts").alias("first_event_at"), F.max("_ts").alias("last_event_at"))
    counters = by_customer.groupBy("product_id").agg(
        F.sum("events").alias("events"), *[F.sum(n).alias(n) for n in actions],
        F.coalesce(F.sum("units"), F.lit(0)).alias("units_purchased"),
        F.try_divide(F.sum("ratings").cast("double"), F.sum("rated")).alias("avg_rating"),
        F.count("customer_id").alias("unique_customers"),
        F.min("first_event_at").alias("first_event_at"), F.max("last_event_at").alias("last_event_at"))
    return counters.join(latest, "product_id").select(
        "product_id", F.col("latest.category").alias("category"), F.col("latest.price").alias("latest_price"), "events", *actions,
        "units_purchased", "avg_rating", "unique_customers", "first_event_at", "last_event_at")


def silver_sessions(bronze_cust: DataFrame, gap: str = "30 minutes", tolerant: bool = False) -> DataFrame:
    """K2 (batch): per customer, events closer than ``gap`` (inclusive) form one
    session; session end = last event + gap. Uses the skew-safe ``sessionize``
    (sums per time slice, joined to sessions)."""
    ev = bronze_cust.withColumn("event_ts", R.to_ts("timestamp", tolerant))
    s = sessionize(ev, "customer_id", "event_ts", gap)
    return s.select(
        "customer_id", "session_start", "session_end", "n_events", "first_event", "last_event",
        (F.timestamp_diff("MICROSECOND", F.col("first_event"), F.col("last_event")).cast("double")
         / F.lit(1e6)).alias("duration_seconds"),
        F.size("actions").cast("bigint").alias("n_actions"), "device_type")


def _completed(silver_tx: DataFrame) -> DataFrame:
    return silver_tx.where(F.col("status") == "completed")


def _month(c: str) -> F.Column:
    return F.trunc(F.col(c), "month")


def cohort_retention(silver_tx: DataFrame) -> DataFrame:
    """K3: cohort = month of a customer's first completed transaction; per cohort
    and months since, the customers active (>= 1 completed transaction) and
    their share of the cohort.

    After the (customer, month) dedup a customer has at most one row per month,
    and a cohort at most one row per month offset, so both windows below are
    bounded by calendar length, not by data volume (no self-joins needed).
    """
    active = _completed(silver_tx).select("customer_id", _month("transaction_date").alias("month")).distinct()
    with_cohort = active.withColumn("cohort_month", F.min("month").over(Window.partitionBy("customer_id")))
    since = F.months_between("month", "cohort_month").cast("int")
    counts = (with_cohort.groupBy("cohort_month", since.alias("months_since"))
              .agg(F.count(F.lit(1)).alias("active_customers")))
    size = F.max(F.when(F.col("months_since") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month"))
    return counts.withColumn("cohort_size", size).select(
        "cohort_month", "months_since", "active_customers", "cohort_size",
        (F.col("active_customers").cast("double") / F.col("cohort_size") * F.lit(100.0)).alias("retention_pct"))


def revenue_attribution(silver_tx: DataFrame, bronze_cust: DataFrame, tolerant: bool = False) -> DataFrame:
    """K4: completed USD revenue credited to the device_type of the customer's
    latest customer event at or before the transaction ('unknown' if none);
    ties on event time go to the largest event_id. Per date and device:
    revenue, transactions, customers."""
    probes = _completed(silver_tx).select("customer_id", "transaction_timestamp", "transaction_date", "amount_usd")
    facts = bronze_cust.select("customer_id", R.to_ts("timestamp", tolerant).alias("event_ts"), "event_id", "device_type")
    hit = asof_latest(probes, facts, "customer_id", "transaction_timestamp", "event_ts", "device_type",
                      "event_id", out="device")
    return (hit.groupBy("transaction_date", F.coalesce(F.col("device"), F.lit("unknown")).alias("device_type"))
            .agg(R.exact_sum("amount_usd").alias("revenue_usd"),
                 F.count(F.lit(1)).alias("transactions"),
                 F.countDistinct("customer_id").alias("customers")))


def aov_daily(silver_tx: DataFrame) -> DataFrame:
    """K5: average order value per day = completed revenue / completed count."""
    return (_completed(silver_tx).groupBy("transaction_date")
            .agg(R.exact_sum("amount_usd").alias("revenue_usd"), F.count(F.lit(1)).alias("orders"))
            .withColumn("aov", F.col("revenue_usd") / F.col("orders")))


def _growth(cur: str, prev: str) -> F.Column:
    return F.when(F.col(prev) > 0, (F.col(cur) - F.col(prev)) / F.col(prev) * F.lit(100.0))


def revenue_growth(silver_tx: DataFrame) -> DataFrame:
    """K6: completed revenue per calendar month against the month before and the
    same month a year before (growth in percent, NULL without a base)."""
    monthly = (_completed(silver_tx).groupBy(_month("transaction_date").alias("month"))
               .agg(R.exact_sum("amount_usd").alias("revenue_usd")))
    # one scan: each month is also offered to the months that look back at it (3 rows a month)
    offers = monthly.select(F.explode(F.array(*[
        F.struct(F.add_months("month", n).alias("month"), F.lit(n).alias("back"), "revenue_usd") for n in (0, 1, 12)])).alias("o"))
    of = lambda n: F.max(F.when(F.col("o.back") == n, F.col("o.revenue_usd")))
    j = (offers.groupBy(F.col("o.month").alias("month"))
         .agg(of(0).alias("revenue_usd"), of(1).alias("prev_month_revenue"), of(12).alias("prev_year_revenue"))
         .where("revenue_usd is not null"))
    return j.select("month", "revenue_usd", "prev_month_revenue",
                    _growth("revenue_usd", "prev_month_revenue").alias("mom_growth_pct"),
                    "prev_year_revenue",
                    _growth("revenue_usd", "prev_year_revenue").alias("yoy_growth_pct"))


def mrr_monthly(silver_tx: DataFrame) -> DataFrame:
    """K7: per month, completed revenue from customers who also bought in the
    previous month (MRR), those customers, and all active customers/revenue."""
    cm = (_completed(silver_tx).groupBy("customer_id", _month("transaction_date").alias("month"))
          .agg(R.exact_sum("amount_usd", as_double=False).alias("rev")))
    # a customer has at most one row a month here, so the window is bounded by the calendar
    before = F.lag("month").over(Window.partitionBy("customer_id").orderBy("month"))
    j = cm.withColumn("repeat", F.add_months(before, 1) == F.col("month"))
    repeat = F.coalesce(F.col("repeat"), F.lit(False))
    return j.groupBy("month").agg(
        F.coalesce(F.sum(F.when(repeat, F.col("rev"))), F.lit(0).cast("decimal(28,4)")).cast("double").alias("mrr"),
        R.count_when(repeat).alias("recurring_customers"),
        F.count(F.lit(1)).alias("active_customers"),
        F.sum("rev").cast("double").alias("total_revenue_usd"))


def churn_by_segment(silver_tx: DataFrame, spending: DataFrame, cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """K8: among customers with a completed transaction, the share whose last one
    is older than ``active_customer_days`` before as_of, per customer segment.

    ``spending`` is the customer transaction summary (B9): the segment depends
    on spend alone, so customers without a valid profile count too.
    """
    last = _completed(silver_tx).groupBy("customer_id").agg(F.max("transaction_date").alias("last_date"))
    seg = spending.select("customer_id", R.customer_segment("total_spent").alias("customer_segment"))
    cutoff = R.date_lit(R.days_before(cfg.as_of, cfg.active_customer_days))
    churned = F.col("last_date") < cutoff
    return (last.join(seg, "customer_id").groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("customers"), R.count_when(churned).alias("churned"))
            .withColumn("churn_rate_pct", F.col("churned").cast("double") / F.col("customers") * F.lit(100.0)))


# Fixed labels of our RFM segmentation (sum of the three 1-5 scores).
RFM_SEGMENTS = (("Champions", 13), ("Loyal", 10), ("Potential", 7), ("At Risk", 5))  # else Hibernating


def rfm_segments(gold_cust: DataFrame) -> DataFrame:
    """K9: per customer the R+F+M total and its segment label, then customers per
    segment with their score range and revenue."""
    per_customer = gold_cust.select("customer_id", "recency_score", "frequency_score", "monetary_score",
                                    "total_revenue_usd").distinct()
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    labelled = per_customer.withColumn("rfm_total", total).withColumn(
        "rfm_segment", R.tier("rfm_total", RFM_SEGMENTS, "Hibernating"))
    return labelled.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("rfm_total").alias("min_total"), F.max("rfm_total").alias("max_total"),
        R.exact_sum("total_revenue_usd").alias("revenue_usd"))


def rfm_quintiles(tx_metrics: DataFrame, partitions: int | None = None) -> DataFrame:
    """K9, ntile variant: per customer with a completed transaction, quintiles 1-5
    of recency (last transaction date), frequency (completed count) and monetary
    value (USD revenue); ties are broken by customer_id. Exact global tiles
    without a single-task window, all three in one pass (``ranking.global_ntiles``)."""
    tiles = global_ntiles(tx_metrics, "customer_id", {
        "r_quintile": F.unix_date("last_transaction_date"), "f_quintile": F.col("total_transactions_detailed"),
        "m_quintile": F.col("total_revenue_usd")}, 5, partitions)
    return tiles.withColumn("rfm_quintile_total", F.col("r_quintile") + F.col("f_quintile") + F.col("m_quintile"))


def system_log_metrics(bronze_logs: DataFrame, tolerant: bool = False) -> DataFrame:
    """Per service and hour - requests, error share (level ERROR), 5xx share,
    average and exact 95th-percentile response time.

    Rows are first counted per response time, so the percentile weighs distinct
    values instead of holding rows, and a hot service's hour is spread.
    """
    hour = R.hour_start(R.to_ts("timestamp", tolerant))
    ms = F.col("response_time_ms")
    per_value = (bronze_logs.groupBy("service", hour.alias("hour"), "response_time_ms")
                 .agg(F.count(F.lit(1)).alias("n"),
                      R.count_when(F.col("level") == "ERROR").alias("n_errors"),
                      R.count_when(F.col("status_code") >= 500).alias("n_server_errors")))
    timed = F.sum(F.when(ms.isNotNull(), F.col("n")))
    return (per_value.groupBy("service", "hour")
            .agg(R.safe_div(F.sum(ms.cast("decimal(38,0)") * F.col("n").cast("decimal(20,0)")), timed).alias("avg_response_ms"),
                 F.percentile("response_time_ms", 0.95, F.col("n")).alias("p95_response_ms"),
                 F.sum("n").alias("requests"), F.sum("n_errors").alias("errors"), F.sum("n_server_errors").alias("server_errors"))
            .select("service", "hour", "requests", "errors", "server_errors", "avg_response_ms", "p95_response_ms")
            .withColumn("error_rate_pct", F.col("errors").cast("double") / F.col("requests") * F.lit(100.0))
            .withColumn("server_error_rate_pct",
                        F.col("server_errors").cast("double") / F.col("requests") * F.lit(100.0)))


LATENCY_K = 200  # of the sketches: a rank error of about 1.65 % (99 % of the time)


def latency_sketches(bronze_logs: DataFrame, tolerant: bool = False) -> DataFrame:
    """(service, hour, requests, latency): a mergeable quantile sketch of each hour's response times.

    A sketch has a fixed size, so hours can be stored and merged to days or weeks
    without the rows (``latency_by_day``). An hour without response times has no sketch.
    """
    hour = R.hour_start(R.to_ts("timestamp", tolerant))
    return bronze_logs.groupBy("service", hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.kll_sketch_agg_bigint(F.col("response_time_ms"), F.lit(LATENCY_K)).alias("latency"))


def latency_by_day(sketches: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """(service, day, requests, latencies) from stored hours: about the response times at ``quantiles``."""
    merged = sketches.groupBy("service", F.to_date("hour").alias("day")).agg(
        F.sum("requests").alias("requests"), F.kll_merge_agg_bigint("latency").alias("latency"))
    return merged.select("service", "day", "requests", F.when(
        F.kll_sketch_get_n_bigint("latency") > 0,  # else the day had no response time
        F.kll_sketch_get_quantile_bigint("latency", F.array(*[F.lit(q) for q in quantiles]))).alias("latencies"))
