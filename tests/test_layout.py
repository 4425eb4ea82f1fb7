"""Bucketed customer tables: no exchange in joins and checks by customer, the same rows as from plain folders."""

import glob
import uuid

from pyspark.sql import functions as F

from goldvein.config import PipelineConfig
from goldvein.operators import gold_customer as GC
from goldvein.operators import quality as Q
from goldvein.operators import silver as S
from goldvein.plans.layout import CustomerTables, buckets_for, colocated
from goldvein.plans.pipeline import run_pipeline
from goldvein.sources.driver_tables import load_bronze

from .conftest import SF_SMALL

CFG = PipelineConfig()


def layers(spark, limit=None):
    b = load_bronze(spark, SF_SMALL)
    cut = lambda df: df if limit is None else df.limit(limit)
    tx = cut(b.transaction_events)
    return S.silver_customers(cut(b.customer_events), tx, cut(b.product_events), CFG), S.silver_transactions(tx, CFG)


def stored(spark, root, scu, stx, buckets=4):
    tables = CustomerTables(spark, root, buckets, f"t{uuid.uuid4().hex[:10]}_", CFG)
    tables.put_silver(scu, stx)
    return tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_gold_has_no_exchange_and_the_same_rows(spark, tmp_dir):
    scu, stx = layers(spark)
    tables = stored(spark, tmp_dir, scu, stx)
    gold = tables.gold_customer_analytics()
    assert "Exchange" not in plan(gold) and "SortMergeJoin" in plan(gold)
    expected = rows(GC.gold_customer_analytics(scu, stx, CFG))
    assert len(expected) > 10 and rows(gold) == expected
    assert rows(tables.put_gold()) == expected
    for table in ("silver_customers", "customer_metrics", "gold_customer_analytics"):  # the third is written where its rows lie
        assert 1 <= len(glob.glob(f"{tables.path(table)}/part-*")) <= 4


def test_checks_by_customer_shuffle_no_rows(spark, tmp_dir):
    tables = stored(spark, tmp_dir, *layers(spark))
    per_customer = tables.get("silver_customers").groupBy("customer_id").count()
    assert "Exchange" not in plan(per_customer)
    known = tables.get("customer_metrics").join(colocated(per_customer), "customer_id", "left_anti")
    assert "Exchange" not in plan(known)
    assert Q.uniqueness(tables.get("customer_metrics"), "customer_metrics", ["customer_id"]).first()["status"] == "PASS"


def test_opened_by_another_session(spark, tmp_dir):
    tables = stored(spark, tmp_dir, *layers(spark))
    before = rows(tables.gold_customer_analytics())
    for table in ("silver_customers", "customer_metrics"):
        spark.sql(f"DROP TABLE {tables.prefix}{table}")  # the files stay, as for a session that never knew the table
    again = tables.gold_customer_analytics()
    assert "Exchange" not in plan(again) and rows(again) == before


def test_repeated_writes_replace_the_table(spark, tmp_dir):
    scu, stx = layers(spark)
    tables = stored(spark, tmp_dir, scu, stx)
    tables.put_silver(scu.where(F.lit(False)), stx)
    assert tables.gold_customer_analytics().count() == 0
    tables.put_silver(scu, stx)
    assert rows(tables.gold_customer_analytics()) == rows(GC.gold_customer_analytics(scu, stx, CFG))


def test_empty_and_sizes(spark, tmp_dir):
    scu, stx = layers(spark, 0)
    tables = stored(spark, tmp_dir, scu, stx)
    assert tables.put_gold().count() == 0
    assert (buckets_for(0), buckets_for(100 << 30), buckets_for((256 << 20) * 9 + 1)) == (8, 400, 10)


def test_whole_run_with_bucketed_tables(spark, tmp_dir):
    frames = load_bronze(spark, SF_SMALL).by_table()
    runs = [run_pipeline(spark, f"{tmp_dir}/{n}", PipelineConfig(duplicate_tolerance=0.5, silver_partition_by=None, customer_buckets=n,
                                                                 table_prefix=f"t{uuid.uuid4().hex[:10]}_"),
                         bronze_frames=frames, gate=False, enforce_tests=False) for n in (None, 4)]
    for table in ("silver_customers", "gold_customer_analytics", "gold_business_metrics"):
        plain, bucketed = (rows(spark.read.parquet(r.paths[table])) for r in runs)
        assert plain and plain == bucketed
    assert runs[0].failed_checks == runs[1].failed_checks
