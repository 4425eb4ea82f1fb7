"""Data-quality operators (DQ1-DQ8).

Every check is a distributed aggregation returning a small result DataFrame
(one row per table, column, day or key set). Only the gate (DQ2) collects, and
what it collects is that small result: one row per bronze table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..config import PipelineConfig
from ..functions import rules as R

VALIDATION_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("duplicates", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])


def _validate_one(name: str, df: DataFrame, as_of: date, tolerance: float, tolerant: bool) -> DataFrame:
    processed_day = F.to_date(R.to_ts("processed_at", tolerant))
    agg = df.agg(
        R.count_when(processed_day == R.date_lit(as_of)).alias("count"),
        (F.count(F.lit(1)) - F.countDistinct("event_id")).alias("duplicates"),
        F.count(F.lit(1)).alias("total"))
    allowed = F.floor(F.col("total") * F.lit(float(tolerance)))
    return agg.select(
        F.lit(name).alias("table_name"), "count", "duplicates",
        F.when((F.col("count") > 0) & (F.col("duplicates") <= allowed), "PASS").otherwise("FAIL").alias("status"),
        F.lit(None).cast("string").alias("error"))


def validate_bronze(spark: SparkSession, tables: dict[str, DataFrame | str | Callable[[], DataFrame]],
                    cfg: PipelineConfig = C.DEFAULT, expected: tuple[str, ...] = ()) -> DataFrame:
    """DQ1: rows processed on ``as_of`` and duplicate event ids over the whole table.

    PASS iff count > 0 and duplicates = 0 (or within ``cfg.duplicate_tolerance``);
    a table that cannot be read, resolved or aggregated gives an ERROR row with
    the message, and so does one of ``expected`` that is not there at all. Values
    of ``tables`` are DataFrames, Parquet paths or functions that read one.
    All tables are checked here in one job, one row each; only if it fails does
    each run by itself, so that one failing table leaves the others their results.
    """
    rows: list[tuple] = [(name, None, None, "ERROR", "the table is missing") for name in expected if name not in tables]
    checks: dict[str, DataFrame] = {}
    for name, src in tables.items():
        try:
            df = spark.read.parquet(src) if isinstance(src, str) else src() if callable(src) else src
            checks[name] = _validate_one(name, df, cfg.as_of, cfg.duplicate_tolerance, cfg.tolerant_casts)
        except Exception as e:  # noqa: BLE001 - isolate each table, as the reference does
            rows.append((name, None, None, "ERROR", str(e)))
    try:
        if checks:
            rows += [tuple(r) for r in reduce(DataFrame.unionAll, checks.values()).collect()]  # a row a table
    except Exception:  # noqa: BLE001 - the rows of some table can't be aggregated: find out which
        for name, check in checks.items():
            try:
                rows.append(tuple(check.first()))
            except Exception as e:  # noqa: BLE001
                rows.append((name, None, None, "ERROR", str(e)))
    return spark.createDataFrame(rows, VALIDATION_SCHEMA)


def quality_gate(results: DataFrame) -> bool:
    """DQ2: raise listing every table whose status is not PASS; else True.

    ``results`` holds one row per bronze table, so collecting it is bounded.
    """
    failed = sorted(r["table_name"] for r in results.where(F.col("status") != "PASS")
                    .select("table_name").collect())
    if failed:
        raise ValueError(f"Data quality failed: {failed}")
    return True


@dataclass(frozen=True)
class Check:
    """A check that needs one row of aggregates: what to aggregate, and the result rows made of it.

    ``on`` reads a table for it; ``observed.write_checked`` gathers the aggregates while the table is written.
    """
    aggregates: tuple[Column, ...]
    finish: Callable[[DataFrame], DataFrame]

    def on(self, df: DataFrame) -> DataFrame:
        return self.finish(df.agg(*self.aggregates))


def row_check(now: datetime, table_name: str = "silver_customers") -> Check:
    bad_email = ~F.col("email").like("%@%")
    negative = F.col("total_spent") < 0
    future = F.col("created_at") > R.ts_ntz(now)
    return Check((
        R.count_when(bad_email | negative | future).alias("failed_records"),
        R.count_when(bad_email).alias("bad_email"),
        R.count_when(negative).alias("negative_spend"),
        R.count_when(future).alias("future_created_at"),
        F.count(F.lit(1)).alias("total_rows"),
    ), lambda found: found.select(F.lit(table_name).alias("table_name"), "*", F.when(
        F.col("failed_records") == 0, "PASS").otherwise("FAIL").alias("status")))


def row_checks(silver_cust: DataFrame, now: datetime, table_name: str = "silver_customers") -> DataFrame:
    """DQ3: rows with an email lacking '@', negative spend, or a future created_at."""
    return row_check(now, table_name).on(silver_cust)


def completeness_check(table_name: str, columns: list[str], max_null_fraction: float = C.MAX_NULL_PERCENTAGE) -> Check:
    def finish(wide: DataFrame) -> DataFrame:
        long = wide.unpivot("total_rows", list(columns), "column_name", "null_count")
        frac = R.safe_div(F.col("null_count"), F.col("total_rows"))
        return long.select(
            F.lit(table_name).alias("table_name"), "column_name", "null_count", "total_rows",
            frac.alias("null_fraction"),
            F.when(F.coalesce(frac, F.lit(0.0)) <= max_null_fraction, "PASS").otherwise("FAIL").alias("status"))
    return Check((F.count(F.lit(1)).alias("total_rows"),
                  *[R.count_when(F.col(c).isNull()).alias(c) for c in columns]), finish)


def completeness(df: DataFrame, table_name: str, columns: list[str],
                 max_null_fraction: float = C.MAX_NULL_PERCENTAGE) -> DataFrame:
    """DQ4: NULL share per required column in one pass, un-pivoted to one row per column."""
    return completeness_check(table_name, columns, max_null_fraction).on(df)


def volume(df: DataFrame, ts_col: str, table_name: str, min_rows: int = C.MIN_ROW_COUNT,
           max_change_pct: float = 50.0, tolerant: bool = False) -> DataFrame:
    """DQ5: rows per day >= ``min_rows`` and change vs the previous calendar day within
    +-``max_change_pct`` percent (a day without a previous day only needs the minimum).

    One scan: each day's count is also offered to the next day (two rows a day). Rows
    without a day (``tolerant`` casts) are counted as a day of their own, null.
    """
    daily = (df.groupBy(F.to_date(R.to_ts(ts_col, tolerant)).alias("day"))
             .agg(F.count(F.lit(1)).alias("row_count")))
    offers = daily.select(F.explode(F.array(*[
        F.struct(F.date_add("day", n).alias("day"), F.lit(n).alias("back"), "row_count") for n in (0, 1)])).alias("o"))
    of = lambda n: F.max(F.when(F.col("o.back") == n, F.col("o.row_count")))
    j = (offers.groupBy(F.col("o.day").alias("day")).agg(of(0).alias("row_count"), of(1).alias("prev_day_count"))
         .where("row_count is not null").withColumn("prev_day_count", F.when(F.col("day").isNotNull(), F.col("prev_day_count"))))
    change = F.when(F.col("prev_day_count") > 0,
                    (F.col("row_count") - F.col("prev_day_count")).cast("double")
                    / F.col("prev_day_count") * F.lit(100.0))
    ok = (F.col("row_count") >= min_rows) & (change.isNull() | (F.abs(change) <= max_change_pct))
    return j.select(F.lit(table_name).alias("table_name"), "day", "row_count", "prev_day_count",
                    change.alias("change_pct"), F.when(ok, "PASS").otherwise("FAIL").alias("status"))


def referential(child: DataFrame, parent: DataFrame, key: str, child_name: str, parent_name: str,
                parent_key: str | None = None) -> DataFrame:
    """DQ6: non-NULL child keys with no parent row.

    Child keys are counted per key first (map-side combine), so a hot key costs
    one row in the anti-join regardless of its frequency.
    """
    keys = (child.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n")))
    parents = parent.select(F.col(parent_key or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    orphans = keys.join(parents, key, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("orphan_keys"),
                       F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")).select(
        F.lit(f"{child_name}.{key} -> {parent_name}.{parent_key or key}").alias("check_name"),
        "orphan_keys", "orphan_rows",
        F.when(F.col("orphan_keys") == 0, "PASS").otherwise("FAIL").alias("status"))


def uniqueness(df: DataFrame, table_name: str, keys: list[str]) -> DataFrame:
    """DQ7: duplicate key values (NULL keys are reported apart, as a unique index allows them)."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    # NULL keys form their own groups here; one pass over the per-key counts.
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    keyed = ~has_null
    stats = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_key_rows"),
        R.count_when(keyed).alias("distinct_keys"),
        R.count_when(keyed & (F.col("n") > 1)).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(keyed, F.col("n") - 1)), F.lit(0)).alias("excess_rows"))
    return stats.select(
        F.lit(table_name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
        "total_rows", "null_key_rows", "distinct_keys", "duplicated_keys", "excess_rows",
        F.when(F.col("duplicated_keys") == 0, "PASS").otherwise("FAIL").alias("status"))


def freshness_check(ts_col: str, table_name: str, now: datetime, max_age_hours: int = C.FRESHNESS_HOURS, tolerant: bool = False) -> Check:
    ts = R.to_ts(ts_col, tolerant)
    lag_us = F.timestamp_diff("MICROSECOND", F.col("newest"), R.ts_ntz(now))
    limit = R.ts_ntz(now - timedelta(hours=max_age_hours))
    return Check((F.max(F.when(ts <= R.ts_ntz(now), ts)).alias("newest"),), lambda newest: newest.select(
        F.lit(table_name).alias("table_name"), "newest",
        (lag_us.cast("double") / F.lit(60e6)).alias("lag_minutes"),
        F.when(F.col("newest") >= limit, "PASS").otherwise("FAIL").alias("status")))


def freshness(df: DataFrame, ts_col: str, table_name: str, now: datetime,
              max_age_hours: int = C.FRESHNESS_HOURS, tolerant: bool = False) -> DataFrame:
    """DQ8: the newest row not after ``now`` must be within ``max_age_hours`` of it.

    Rows dated after ``now`` (one wrong date would hide a stale table) don't
    count as fresh; a table that has only such rows fails.
    """
    return freshness_check(ts_col, table_name, now, max_age_hours, tolerant).on(df)
