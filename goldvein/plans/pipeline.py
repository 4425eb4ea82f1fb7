"""End-to-end run (T8, T9): ingest -> validate -> gate -> silver -> tests -> gold -> tests.

Plain Python ordering of Spark jobs; no scheduler. Each layer is written as
Parquet and the next layer reads it back, which cuts lineage (a lost executor
recomputes from the last written layer, not from the raw stream) and lets the
silver scans prune columns and partitions.

Layout under ``out_dir``::

    bronze/<table>/stream/record_status=valid/        append-only raw events of the stream
    bronze/<table>/stream/record_status=quarantined/  rejected records with a reason
    bronze/<table>/batch/               events appended in batch
    silver/silver_transactions/         partitioned by transaction_date (configurable)
    silver/silver_customers/
    silver/silver_products/             K1
    silver/silver_sessions/             K2
    gold/gold_customer_analytics/
    customers/<table>/b<buckets>/       silver_customers, customer_metrics and gold_customer_analytics instead,
                                        where the config asks for bucketed tables
    gold/gold_business_metrics/         partitioned by metric_type
    gold/gold_cohort_analysis/          K3
    gold/gold_revenue_attribution/      K4
    quality/<check>/run=<timestamp>/    results of every check, one folder per run
    _checkpoints/                       streaming offsets and state
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import PipelineConfig
from ..operators import gold_customer as GC
from ..operators import gold_metrics as GM
from ..operators import quality as Q
from ..operators.observed import write_checked
from ..operators import silver as S
from ..operators import products as P
from ..schemas import STREAMS, with_lineage
from ..streaming import ingest as I
from .layout import CustomerTables

# Columns that must be filled (DQ4) in each written table.
REQUIRED_COLUMNS = {
    "silver_transactions": ["transaction_id", "customer_id", "amount_usd", "transaction_date"],
    "silver_customers": ["customer_id", "email", "created_at"],
    "gold_customer_analytics": ["customer_id", "email"],
}
# Layer tests that stop a run when they fail. ``known`` failures of a run's data are named by its caller.
TESTS = ("silver_row_checks", "silver_uniqueness", "silver_referential", "gold_uniqueness", "gold_referential")


@dataclass
class RunResult:
    paths: dict[str, str] = field(default_factory=dict)
    ingest_counts: dict[str, dict] = field(default_factory=dict)
    quality: dict[str, str] = field(default_factory=dict)
    failed_checks: list[str] = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def phase(self, name: str):
        t = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = round(time.perf_counter() - t, 3)


def _laid_out(df: DataFrame, partition_by: str | None) -> DataFrame:
    """Rows of one partition value together; AQE splits a hot one into several files instead of one huge task."""
    return df.hint("rebalance", partition_by) if partition_by else df


def _written(df: DataFrame, path: str, partition_by: str | None) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Full rebuild of a layer table."""
    return _written(_laid_out(df, partition_by), path, partition_by)


def write_and_check(df: DataFrame, path: str, checks: dict[str, Q.Check], partition_by: str | None = None) -> dict[str, DataFrame]:
    """``write_table`` with checks on the rows as they are written."""
    return write_checked(_laid_out(df, partition_by), lambda rows: _written(rows, path, partition_by), checks)


def append_bronze(frames: dict[str, DataFrame], bronze_root: str) -> dict[str, str]:
    """Batch form of the bronze sink (S4): append each frame to bronze/<table>/batch."""
    schemas = dict(STREAMS.values())
    paths = {}
    for table, df in frames.items():
        paths[table] = f"{bronze_root}/{table}"
        I.append_bronze(df, paths[table], schemas[table])
    return paths


def _quality_path(out_dir: str, name: str, cfg: PipelineConfig) -> str:
    return f"{out_dir}/quality/{name}/run={cfg.run_timestamp:%Y-%m-%dT%H-%M-%S}"


def _record(spark: SparkSession, result: RunResult, out_dir: str, name: str, df: DataFrame,
            cfg: PipelineConfig, enforce: bool) -> None:
    path = _quality_path(out_dir, name, cfg)
    df.write.mode("overwrite").parquet(path)
    result.quality[name] = path
    failed = spark.read.parquet(path).where(F.col("status") != "PASS").count()
    if failed:
        result.failed_checks.append(name)
        if enforce:
            raise ValueError(f"quality check {name} failed on {failed} row(s); see {path}")


def run_pipeline(spark: SparkSession, out_dir: str, cfg: PipelineConfig = C.DEFAULT,
                 landing_root: str | None = None, bronze_frames: dict[str, DataFrame] | None = None,
                 gate: bool = True, enforce_tests: bool = True, known_failures: tuple[str, ...] = (),
                 max_files_per_trigger: int | None = None) -> RunResult:
    """Run every layer once.

    Bronze comes from the landing folders (streaming ingest, ``landing_root``)
    and/or from ready DataFrames (``bronze_frames``, appended in batch). The
    gate (DQ2) stops the run before silver when a bronze table fails DQ1 or is missing.
    Layer tests (DQ3, DQ6, DQ7) stop the run when they fail, but for the
    ``known_failures`` that the caller names (all with ``enforce_tests=False``);
    completeness, volume and freshness (DQ4, DQ5, DQ8) are recorded. Row checks and
    completeness are gathered while a table is written. A quiet
    stream is a table without new rows, not an error. ``max_files_per_trigger``
    bounds the ingest's micro-batches.
    """
    out_dir = out_dir.rstrip("/")
    result = RunResult()
    bronze_root = f"{out_dir}/bronze"
    with result.phase("ingest"):
        if landing_root:
            result.paths.update(I.ingest_all(spark, landing_root, bronze_root, f"{out_dir}/_checkpoints", cfg,
                                             counts=result.ingest_counts, max_files_per_trigger=max_files_per_trigger))
        if bronze_frames:
            result.paths.update(append_bronze(bronze_frames, bronze_root))

    with result.phase("validate_and_gate"):
        readers = {t: partial(I.read_bronze, spark, result.paths[t], schema)
                   for t, schema in STREAMS.values() if t in result.paths}
        validation = Q.validate_bronze(spark, readers, cfg, expected=tuple(t for t, _ in STREAMS.values()))
        vpath = _quality_path(out_dir, "bronze_validation", cfg)
        validation.write.mode("overwrite").parquet(vpath)
        result.quality["bronze_validation"] = vpath
        if gate:
            Q.quality_gate(spark.read.parquet(vpath))
        bronze = {t: readers[t]() if t in readers else spark.createDataFrame([], with_lineage(schema))
                  for t, schema in STREAMS.values()}
        record = lambda name, df: _record(spark, result, out_dir, name, df, cfg,
                                          enforce_tests and name in TESTS and name not in known_failures)
        union = lambda parts: reduce(DataFrame.unionByName, parts)
        complete = lambda t: Q.completeness_check(t, REQUIRED_COLUMNS[t], cfg.max_null_percentage)
        record("bronze_volume", union([Q.volume(df, "timestamp", t, cfg.min_row_count, cfg.max_volume_change_pct, cfg.tolerant_casts)
                                       for t, df in bronze.items()]))
        record("bronze_freshness", union([Q.freshness(df, "processed_at", t, cfg.run_timestamp, cfg.freshness_hours, cfg.tolerant_casts)
                                          for t, df in bronze.items()]))

    with result.phase("silver"):
        silver_tx = S.silver_transactions(bronze["bronze_transaction_events"], cfg)
        silver_cust = S.silver_customers(bronze["bronze_customer_events"], bronze["bronze_transaction_events"],
                                         bronze["bronze_product_events"], cfg)
        for t in ("silver_transactions", "silver_customers"):
            result.paths[t] = f"{out_dir}/silver/{t}"
        tx_checks = write_and_check(silver_tx, result.paths["silver_transactions"], {"complete": complete("silver_transactions")},
                                    cfg.silver_partition_by)
        profile_checks = {"rows": Q.row_check(cfg.run_timestamp), "complete": complete("silver_customers")}
        tables = CustomerTables(spark, f"{out_dir}/customers", cfg.customer_buckets, cfg.table_prefix, cfg) if cfg.customer_buckets else None
        if tables:
            result.paths["silver_customers"] = tables.path("silver_customers")
            cust_checks = write_checked(silver_cust, lambda rows: tables.put("silver_customers", rows), profile_checks)
        else:
            cust_checks = write_and_check(silver_cust, result.paths["silver_customers"], profile_checks)
        result.paths["silver_products"] = write_table(
            P.silver_products(bronze["bronze_product_events"], cfg.tolerant_casts), f"{out_dir}/silver/silver_products")
        result.paths["silver_sessions"] = write_table(
            P.silver_sessions(bronze["bronze_customer_events"], cfg.session_gap, tolerant=cfg.tolerant_casts),
            f"{out_dir}/silver/silver_sessions")
    stx = spark.read.parquet(result.paths["silver_transactions"])
    scu = tables.get("silver_customers") if tables else spark.read.parquet(result.paths["silver_customers"])

    with result.phase("silver_tests"):  # T9
        record("silver_row_checks", cust_checks["rows"])
        record("silver_uniqueness", union([
            Q.uniqueness(stx, "silver_transactions", ["transaction_id"]),
            Q.uniqueness(scu, "silver_customers", ["customer_id"]),
            Q.uniqueness(scu, "silver_customers", ["email"]),
        ]))
        record("silver_referential", Q.referential(stx, scu, "customer_id", "silver_transactions", "silver_customers"))
        record("silver_completeness", union([tx_checks["complete"], cust_checks["complete"]]))

    with result.phase("gold"):
        result.paths["gold_customer_analytics"] = f"{out_dir}/gold/gold_customer_analytics"
        whole = {"complete": complete("gold_customer_analytics")}
        if tables:
            result.paths["customer_metrics"] = tables.put_metrics(stx)
            result.paths["gold_customer_analytics"] = tables.path("gold_customer_analytics")
            gold_checks = write_checked(tables.gold_customer_analytics(),
                                        lambda rows: tables.put("gold_customer_analytics", rows, placed=True), whole)
        else:
            gold_checks = write_and_check(GC.gold_customer_analytics(scu, stx, cfg), result.paths["gold_customer_analytics"], whole)
        result.paths["gold_business_metrics"] = write_table(
            GM.gold_business_metrics(stx, scu, cfg), f"{out_dir}/gold/gold_business_metrics", "metric_type")
        result.paths["gold_cohort_analysis"] = write_table(P.cohort_retention(stx), f"{out_dir}/gold/gold_cohort_analysis")
        result.paths["gold_revenue_attribution"] = write_table(
            P.revenue_attribution(stx, bronze["bronze_customer_events"], tolerant=cfg.tolerant_casts),
            f"{out_dir}/gold/gold_revenue_attribution")
    gca = tables.get("gold_customer_analytics") if tables else spark.read.parquet(result.paths["gold_customer_analytics"])

    with result.phase("gold_tests"):  # T9
        record("gold_uniqueness", Q.uniqueness(gca, "gold_customer_analytics", ["customer_id"]))
        record("gold_referential", Q.referential(gca, scu, "customer_id", "gold_customer_analytics", "silver_customers"))
        record("gold_completeness", gold_checks["complete"])
    return result
