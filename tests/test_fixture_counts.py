"""The bronze mapping reproduces the expected counts of FIXTURES.md §5 (sf0.01)."""

from pyspark.sql import functions as F

from goldvein.plans.catalog import L
from goldvein.session import cluster_conf

SF = "/root/testdata/sf0.01"


def counts(df, col):
    r = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("d"),
               F.count(col).alias("nn")).first()
    return (r.n, r.d, r.nn)


def test_bronze_counts(spark):
    b = L(spark, SF).bronze
    assert counts(b.customer_events, "customer_id") == (10000, 10000, 9952)
    assert counts(b.transaction_events, "customer_id") == (15000, 15000, 14984)
    assert counts(b.product_events, "rating") == (60000, 45832, 15993)
    assert counts(b.system_logs, "user_id") == (10000, 10000, 7000)
    tx = b.transaction_events.agg(
        F.count(F.when(F.col("amount") >= 100000, 1)).alias("big"), F.count(F.when(F.col("amount") <= 0, 1)).alias("zero"),
        F.count(F.when(F.col("customer_id").isNull(), 1)).alias("nul"),
        F.count(F.when(F.col("fraud_score") == 0.7, 1)).alias("edge")).first()
    assert (tx.big, tx.zero, tx.nul, tx.edge) == (118, 15, 16, 13)
    sc = L(spark, SF).silver_cust
    assert (sc.count(), sc.select("customer_id").distinct().count()) == (217, 145)


def test_cluster_conf_scales_with_input():
    conf = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(10 * 1024 ** 2, 8)["spark.sql.shuffle.partitions"] == "24"
