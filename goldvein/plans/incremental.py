"""The hourly run (T1, T8, S9) at the cost of its batch.

``run_increment`` takes the new bronze events of one run. Silver transactions
are appended, each batch in a folder of its own below its date, so a batch
that is run again replaces its own files only. Customers and daily figures are
merged into the states of ``operators.state``; the gold tables are read from
those. History is not read: a run costs its batch, the states' partitions it
touches, and the gold tables it writes.

Layout under ``out_dir``::

    silver/silver_transactions/[transaction_date=<date>/]batch=<n>/   one folder a batch
    state/<name>/slot=<n>/ or period=<day or month>/                  see operators.state
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import PipelineConfig
from ..operators import quality as Q
from ..operators import silver as S
from ..operators import state as ST
from ..schemas import STREAMS
from ..streaming import ingest as I
from .pipeline import write_table


def append_silver(spark: SparkSession, rows: DataFrame, path: str, batch: int, partition_by: str | None) -> DataFrame:
    """Silver rows of one batch, written once and read back."""
    by = [c for c in (partition_by, "batch") if c]
    out = rows.withColumn("batch", F.lit(batch))
    out = out.hint("rebalance", partition_by) if partition_by else out
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return spark.read.schema(out.schema).parquet(path).where(F.col("batch") == batch).select(*rows.columns)


def run_increment(spark: SparkSession, out_dir: str, bronze: dict[str, DataFrame], batch: int,
                  cfg: PipelineConfig = C.DEFAULT) -> dict[str, list]:
    """Applies the new rows of bronze tables; returns the partitions of every state that were rewritten.

    ``batch`` numbers ascend from run to run. A run that broke off is run again
    with its number: what it had finished is not counted twice.
    """
    touched: dict[str, list] = {}

    def merge(rows: DataFrame, states: Iterable[ST.State]) -> None:
        for state in states:
            touched[state.name] = ST.apply(spark, state, f"{out_dir}/state", rows, batch, cfg)

    for table in ("bronze_transaction_events", "bronze_customer_events", "bronze_product_events"):
        if table in bronze:
            merge(bronze[table], ST.SOURCES[table])
    if "bronze_transaction_events" in bronze:
        silver = S.silver_transactions(bronze["bronze_transaction_events"], cfg)
        silver = append_silver(spark, silver, f"{out_dir}/silver/silver_transactions", batch, cfg.silver_partition_by)
        merge(silver, ST.SOURCES["silver_transactions"])
    return touched


def hourly_run(spark: SparkSession, out_dir: str, landing_root: str, cfg: PipelineConfig = C.DEFAULT, gate: bool = True,
               max_files_per_trigger: int | None = None) -> dict[str, str]:
    """Ingest, gate, increment, gold: one scheduled run over what landed since the last one.

    The run's rows are those that the ingest stamped with its ``run_ts``, which
    also numbers the batch; so each run has a later ``run_ts`` than the one
    before, and a broken run is repeated with its own. The gate (DQ1, DQ2)
    judges these rows. Returns the tables written.
    """
    roots = I.ingest_all(spark, landing_root, f"{out_dir}/bronze", f"{out_dir}/_checkpoints", cfg, max_files_per_trigger=max_files_per_trigger)
    stamp = F.col("processed_at") == cfg.run_ts_string()
    new = {t: I.read_bronze(spark, roots[t], schema).where(stamp) for t, schema in STREAMS.values()}
    arrived = {t: df for t, df in new.items() if not df.isEmpty()}  # a quiet stream is no failure
    found = Q.validate_bronze(spark, arrived, cfg)
    if gate:
        Q.quality_gate(found)
    run_increment(spark, out_dir, arrived, int(cfg.run_timestamp.timestamp()), cfg)
    return Layers(spark, out_dir, cfg).write_gold(out_dir)


class Layers:
    """The layers as the states below ``out_dir`` give them; nothing is computed before it is asked for."""

    def __init__(self, spark: SparkSession, out_dir: str, cfg: PipelineConfig = C.DEFAULT):
        self.cfg, self.read = cfg, lambda state: ST.read(spark, state, f"{out_dir}/state")

    def silver_customers(self) -> DataFrame:
        return ST.silver_customers_from(self.read(ST.ACTIVITY), self.read(ST.SPEND), self.read(ST.PRODUCTS), self.cfg)

    def transaction_metrics(self) -> DataFrame:
        return ST.metrics_from(self.read(ST.METRICS))

    def gold_customer_analytics(self) -> DataFrame:
        return ST.gold_customer_analytics_from(self.silver_customers(), self.read(ST.METRICS), self.cfg)

    def gold_business_metrics(self) -> DataFrame:
        return ST.gold_business_metrics_from(self.read(ST.CUBE), self.read(ST.COUNTRY), self.silver_customers(), self.cfg)

    def customers_by_month(self) -> DataFrame:
        return ST.customers_by_month(self.read(ST.DAYS))

    def write_gold(self, out_dir: str) -> dict[str, str]:
        """The gold tables, as ``run_pipeline`` writes them."""
        return {"silver_customers": write_table(self.silver_customers(), f"{out_dir}/silver/silver_customers"),
                "gold_customer_analytics": write_table(self.gold_customer_analytics(), f"{out_dir}/gold/gold_customer_analytics"),
                "gold_business_metrics": write_table(self.gold_business_metrics(), f"{out_dir}/gold/gold_business_metrics", "metric_type")}
