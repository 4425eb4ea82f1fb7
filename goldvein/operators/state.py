"""Mergeable state of the layers, so that a run costs what its batch brought.

A ``State`` is a table of partial results: ``delta`` makes them from new rows,
``merge`` says how two partial results of one key become one. Everything kept
is exact and does not depend on the order of the batches: counts, decimal
sums, smallest and largest values, sums of squares in whole units (for the
standard deviation), sets of days or products, counts per payment method and
category (for the modes); one state keeps a sketch of each day's customers.

The tables are partitioned, by day or month or by a slot of the customer's hash, and
``apply`` rewrites the partitions that the batch touches, with
``partitionOverwriteMode=dynamic``; the others keep their files. Every
partition carries the number of the last batch in it, so a batch that is
applied again after a crash skips what it had finished and counts nothing twice.

``transaction_metrics``, ``silver_customers`` and the gold tables are then
read from the states instead of from all history.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import PipelineConfig
from ..functions import rules as R
from ..schemas import BRONZE_SCHEMAS
from ..session import path_exists
from . import gold_customer as GC
from . import gold_metrics as GM
from . import silver as S

UNITS = "decimal(38,0)"  # money in units of its last decimal, for exact squares
SUM, RAW_SUM, SCORE_SUM = "decimal(38,4)", R.MONEY_RAW, R.SCORE
PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
SKETCH_LG_K = 12  # the sketch of a day's customers: 2^12 registers, a standard error of 1.6 %


# ---- how partial results merge ------------------------------------------------------------

def union_of(sets: Column) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(sets)))


def summed_counts(lists: Column) -> Column:
    """Lists of (value, n) as one, a value once with its sum; its length is the number of distinct values."""
    rows = F.flatten(lists)
    values = F.array_sort(F.array_distinct(F.transform(rows, lambda r: r["value"])))
    return F.transform(values, lambda v: F.struct(v.alias("value"), F.aggregate(
        F.filter(rows, lambda r: r["value"] == v), F.lit(0).cast("long"), lambda n, r: n + r["n"]).alias("n")))


MERGE: dict[str, Callable[[str], Column]] = {
    "sum": lambda c: F.sum(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "set": lambda c: union_of(F.collect_list(c)),
    "counts": lambda c: summed_counts(F.collect_list(c)),
    "sketch": lambda c: F.hll_union_agg(c),
}


@dataclass(frozen=True)
class State:
    name: str
    keys: tuple[str, ...]
    partition: str  # "slot" of the customer, or "period" of the date
    measures: dict[str, str]  # column -> one of MERGE
    delta: Callable[[DataFrame, PipelineConfig], DataFrame]

    def new(self, rows: DataFrame, cfg: PipelineConfig) -> DataFrame:
        """The partial results of new rows, with their partition."""
        made = self.delta(rows, cfg)
        if self.partition == "slot":
            return made.withColumn("slot", F.pmod(F.xxhash64("customer_id"), F.lit(cfg.state_slots)).cast("int"))
        return made.withColumn("period", F.date_format("transaction_date", PERIODS[cfg.state_period]))

    def merged(self, partials: DataFrame) -> DataFrame:
        """One row a key. A sum keeps its type, whatever the number of merges."""
        types = dict(partials.dtypes)
        return partials.groupBy(*self.keys, self.partition).agg(
            *[MERGE[how](c).cast(types[c]).alias(c) if how in ("sum", "counts") else MERGE[how](c).alias(c) for c, how in self.measures.items()])


def _counted(value: str) -> Column:
    """The (value, n) of rows that were counted before; no null values."""
    return summed_counts(F.collect_list(F.when(F.col(value).isNotNull(), F.array(F.struct(F.col(value).alias("value"), F.col("cell_rows").alias("n"))))))


# ---- the states ---------------------------------------------------------------------------

def _metrics_delta(silver_tx: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Completed rows to (customer, date, payment method, category) first: a hot customer is spread and shrinks before it is merged."""
    usd = F.col("amount_usd").cast(R.MONEY_BOUNDED)
    units = (usd * 10000).cast("decimal(19,0)")
    cube = silver_tx.where(F.col("status") == "completed") \
        .groupBy("customer_id", "transaction_date", "payment_method", "category").agg(
            F.count(F.lit(1)).alias("cell_rows"), F.sum(usd).cast(SUM).alias("usd"), F.count(usd).alias("usd_n"),
            F.sum(units).cast(UNITS).alias("units"), F.sum(units * units).cast(UNITS).alias("squares"),
            R.count_when(F.col("is_high_risk")).alias("high_risk"), F.sum(F.col("fraud_score").cast(R.SCORE)).cast(SCORE_SUM).alias("fraud"),
            F.count("fraud_score").alias("fraud_n"), R.count_when(F.col("time_of_day") == "Night").alias("night"),
            R.count_when(F.col("day_type") == "Weekend").alias("weekend"), R.count_when(F.col("amount_category") == "High").alias("high_value"))
    sums = ("usd", "usd_n", "units", "squares", "high_risk", "fraud", "fraud_n", "night", "weekend", "high_value")
    types = dict(cube.dtypes)
    return cube.groupBy("customer_id").agg(
        F.sum("cell_rows").alias("n"), *[F.sum(c).cast(types[c]).alias(c) for c in sums],
        F.min("transaction_date").alias("first_day"), F.max("transaction_date").alias("last_day"),
        F.array_sort(F.collect_set("transaction_date")).alias("days"),
        _counted("payment_method").alias("payments"), _counted("category").alias("categories"))


def _spend_delta(bronze_tx: DataFrame, cfg: PipelineConfig) -> DataFrame:
    amount = F.col("amount").cast(R.MONEY_RAW)
    return bronze_tx.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).cast(RAW_SUM).alias("spent"), F.count("amount").alias("spent_n"),
        F.max("amount").alias("largest"), R.count_when(F.col("status") == "completed").alias("completed"),
        R.count_when(F.col("fraud_score") > cfg.fraud_score_threshold).alias("high_risk"),
        F.max(R.to_ts("timestamp", cfg.tolerant_casts)).alias("last_seen"))


def _activity_delta(bronze_cust: DataFrame, cfg: PipelineConfig) -> DataFrame:
    ts = R.to_ts("timestamp", cfg.tolerant_casts)
    return S.valid_customers(bronze_cust).groupBy("customer_id", "email", "country", "device_type").agg(
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_set(F.to_date(ts))).alias("days"))


def _product_delta(bronze_prod: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """A row a (customer, product): distinct products are rows, so no set grows with them."""
    return bronze_prod.where(F.col("customer_id").isNotNull()).groupBy("customer_id", "product_id").agg(
        R.count_when(F.col("action") == "purchase").alias("purchases"),
        F.sum(F.col("rating").cast(R.SCORE)).cast(SCORE_SUM).alias("rating"), F.count("rating").alias("rating_n"))


def _country_delta(silver_tx: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return GM.completed_by_day_and_customer(silver_tx)


def _day_delta(silver_tx: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return silver_tx.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("customer_id", F.lit(SKETCH_LG_K)).alias("customers"))


METRICS = State("customer_metrics", ("customer_id",), "slot",
                dict.fromkeys(("n", "usd", "usd_n", "units", "squares", "high_risk", "fraud", "fraud_n", "night", "weekend", "high_value"), "sum")
                | {"first_day": "min", "last_day": "max", "days": "set", "payments": "counts", "categories": "counts"}, _metrics_delta)
SPEND = State("customer_spend", ("customer_id",), "slot",
              dict.fromkeys(("n", "spent", "spent_n", "completed", "high_risk"), "sum") | {"largest": "max", "last_seen": "max"},
              _spend_delta)
ACTIVITY = State("customer_activity", ("customer_id", "email", "country", "device_type"), "slot",
                 {"first_seen": "min", "last_seen": "max", "n": "sum", "days": "set"}, _activity_delta)
PRODUCTS = State("customer_products", ("customer_id", "product_id"), "slot",
                 dict.fromkeys(("purchases", "rating", "rating_n"), "sum"), _product_delta)
CUBE = State("daily_cube", ("transaction_date", "category", "payment_method"), "period",
             dict.fromkeys(GM.CUBE_MEASURES, "sum"), lambda rows, cfg: GM.daily_cube(rows))
COUNTRY = State("daily_customer_revenue", ("transaction_date", "customer_id"), "period", {"revenue": "sum", "n": "sum"}, _country_delta)
DAYS = State("daily_customers_sketch", ("transaction_date",), "period", {"n": "sum", "customers": "sketch"}, _day_delta)
#: Which bronze or silver table each state is made from.
SOURCES = {"bronze_transaction_events": (SPEND,), "bronze_customer_events": (ACTIVITY,), "bronze_product_events": (PRODUCTS,),
           "silver_transactions": (METRICS, CUBE, COUNTRY, DAYS)}


# ---- storage ------------------------------------------------------------------------------

BATCH = "last_batch"


def _schema(state: State, delta: DataFrame):
    """Columns of the stored table, the partition last."""
    return delta.withColumn(BATCH, F.lit(0).cast("long")).select(*state.keys, *state.measures, BATCH, state.partition).schema


def _in(column: str, values: list) -> Column:
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


def apply(spark: SparkSession, state: State, root: str, rows: DataFrame, batch: int, cfg: PipelineConfig = C.DEFAULT) -> list:
    """Merges the new ``rows`` into the state below ``root``; returns the partitions that were rewritten.

    ``batch`` numbers ascend. What goes through the driver are the touched
    partition values: dates or slots.
    """
    path, new = f"{root}/{state.name}", f"{root}/_new/{state.name}"
    state.new(rows, cfg).write.mode("overwrite").parquet(new)  # aggregated once
    delta = spark.read.parquet(new)
    schema = _schema(state, delta)
    touched = [r[0] for r in delta.select(state.partition).distinct().collect()]
    partials = delta.withColumn(BATCH, F.lit(batch).cast("long"))
    if path_exists(spark, path):
        old = spark.read.schema(schema).parquet(path).where(_in(state.partition, touched))
        done = [r[0] for r in old.where(F.col(BATCH) >= batch).select(state.partition).distinct().collect()]
        touched = [t for t in touched if t not in done]  # finished by an earlier try of this batch
        partials = partials.unionByName(old).where(_in(state.partition, touched))
    if touched:
        out = state.merged(partials.drop(BATCH)).withColumn(BATCH, F.lit(batch).cast("long")).select(*schema.fieldNames())
        out.hint("rebalance", state.partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(state.partition).parquet(path)
    return touched


def read(spark: SparkSession, state: State, root: str) -> DataFrame:
    """The state without its bookkeeping; no rows where no batch brought any."""
    if not path_exists(spark, f"{root}/{state.name}"):
        table = next(t for t, states in SOURCES.items() if state in states)
        empty = spark.createDataFrame([], BRONZE_SCHEMAS.get(table, BRONZE_SCHEMAS["bronze_transaction_events"]))
        return state.merged(state.new(empty if table in BRONZE_SCHEMAS else S.silver_transactions(empty), C.DEFAULT)).drop(state.partition)
    return spark.read.parquet(f"{root}/{state.name}").drop(BATCH, state.partition)


# ---- layers from states -------------------------------------------------------------------

def _most(counts: str) -> Column:
    """The value counted most often, the smallest of several; null without any."""
    return F.get(F.array_sort(F.transform(counts, lambda r: F.struct((-r["n"]).alias("n"), r["value"].alias("value")))), F.lit(0))["value"]


def _deviation() -> Column:
    """Sample standard deviation from whole sums: n * squares - sum^2 is exact while it fits 38 digits."""
    n = F.col("usd_n")
    exact = F.try_subtract(F.try_multiply(n.cast(UNITS), F.col("squares")), F.try_multiply(F.col("units"), F.col("units"))).cast("double")
    rough = n * F.col("squares").cast("double") - F.col("units").cast("double") * F.col("units").cast("double")
    return F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), F.coalesce(exact, rough)) / (n.cast("double") * (n - 1))) / F.lit(10000.0))


def metrics_from(state: DataFrame) -> DataFrame:
    """``gold_customer.transaction_metrics`` of a METRICS state."""
    return state.select(
        "customer_id", F.col("n").alias("total_transactions_detailed"), F.col("usd").cast("double").alias("total_revenue_usd"),
        R.safe_div(F.col("usd"), F.col("usd_n")).alias("avg_transaction_usd"), _deviation().alias("transaction_stddev"),
        F.size("days").cast("long").alias("transaction_days"), F.col("last_day").alias("last_transaction_date"),
        F.col("first_day").alias("first_transaction_date"), F.col("high_risk").alias("high_risk_transactions"),
        R.safe_div(F.col("fraud"), F.col("fraud_n")).alias("avg_fraud_score"), F.col("night").alias("night_transactions"),
        F.col("weekend").alias("weekend_transactions"), F.col("high_value").alias("high_value_transactions"),
        _most("payments").alias("preferred_payment_method"), F.size("payments").cast("long").alias("payment_methods_used"),
        _most("categories").alias("preferred_category"), F.size("categories").cast("long").alias("categories_purchased"))


def silver_customers_from(activity: DataFrame, spend: DataFrame, products: DataFrame, cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    """``silver.silver_customers`` of the states."""
    ce = activity.select("customer_id", "email", "country", "device_type", "first_seen", "last_seen", F.col("n").alias("total_events"),
                         F.size("days").cast("long").alias("active_days"))
    ct = spend.select("customer_id", F.col("n").alias("total_transactions"), F.col("spent").cast("double").alias("total_spent"),
                      R.safe_div(F.col("spent"), F.col("spent_n")).alias("avg_transaction_value"), F.col("largest").alias("max_transaction_value"),
                      F.col("completed").alias("successful_transactions"), F.col("high_risk").alias("high_risk_transactions"),
                      F.col("last_seen").alias("last_transaction_date"))
    cp = products.groupBy("customer_id").agg(F.count("product_id").alias("unique_products_viewed"), F.sum("purchases").alias("products_purchased"),
                                             R.safe_div(F.sum("rating"), F.sum("rating_n")).alias("avg_rating_given"))
    return S.profiles(ce, ct, cp, cfg)


def gold_customer_analytics_from(silver_cust: DataFrame, metrics: DataFrame, cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    return GC.customer_360(silver_cust, metrics_from(metrics), cfg)


def gold_business_metrics_from(cube: DataFrame, country: DataFrame, silver_cust: DataFrame, cfg: PipelineConfig = C.DEFAULT) -> DataFrame:
    return GM.business_metrics(cube, country, silver_cust, cfg)


def customers_by_month(days: DataFrame) -> DataFrame:
    """(month, transactions, customers): about how many customers bought in a month, from the sketches of its days."""
    return days.groupBy(F.date_format("transaction_date", "yyyy-MM").alias("month")).agg(
        F.sum("n").alias("transactions"), F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"))
