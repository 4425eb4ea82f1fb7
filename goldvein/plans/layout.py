"""Customer tables as bucketed, sorted catalog tables (J1-J3, S10): joined and checked without an exchange.

A table is stored in ``buckets`` files by the hash of ``customer_id``, each
sorted by it. Tables of one bucket count join, group and count by customer
inside a bucket, so a task reads bucket i of both sides and nothing is
shuffled; the tables that come of such joins are written the same way without
a shuffle either.

Only tables with a row a customer (or a profile) are stored so. Transactions
are not: a bucket is one task's work, and one customer may hold a third of all
transactions. They are first summed per customer, inside the tasks that read
them, and their summary is bucketed.

The count of buckets is part of a table's folder (``<root>/<table>/b<buckets>``),
so a table is never read with another count than it was written with;
``open_table`` names it again in a session whose catalog doesn't know it. Aim at
a bucket of 256 MB: ``buckets_for``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..config import PipelineConfig
from ..operators import gold_customer as GC

KEY = "customer_id"


def buckets_for(table_bytes: int, target_bytes: int = 256 << 20, at_least: int = 8) -> int:
    """Buckets of about ``target_bytes`` for a table of that size."""
    return max(at_least, -(-table_bytes // target_bytes))


def folder(root: str, table: str, buckets: int) -> str:
    return f"{root.rstrip('/')}/{table}/b{buckets}"


def store(df: DataFrame, name: str, path: str, buckets: int, placed: bool = False) -> DataFrame:
    """``df`` as the bucketed table ``name`` in ``path``, read back.

    ``placed``: its rows already lie by bucket (it joins tables of this bucket
    count with ``colocated``); otherwise they are shuffled once, which also
    makes one file a bucket.
    """
    rows = df if placed else df.repartition(buckets, KEY)
    rows.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(name)
    return df.sparkSession.table(name)


def open_table(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """The table that ``store`` wrote into ``path``, by another session."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def colocated(table: DataFrame) -> DataFrame:
    """One side of a join that stays inside the buckets, whatever the tables' size."""
    return table.hint("merge")


class CustomerTables:
    """The customer tables of a run below ``root``, named ``<prefix><table>`` in the catalog."""

    def __init__(self, spark: SparkSession, root: str, buckets: int, prefix: str = "", cfg: PipelineConfig = C.DEFAULT):
        self.spark, self.root, self.buckets, self.prefix, self.cfg = spark, root, buckets, prefix, cfg

    def path(self, table: str) -> str:
        return folder(self.root, table, self.buckets)

    def put(self, table: str, df: DataFrame, placed: bool = False) -> str:
        store(df, self.prefix + table, self.path(table), self.buckets, placed)
        return self.path(table)

    def get(self, table: str) -> DataFrame:
        return open_table(self.spark, self.prefix + table, self.path(table), self.buckets)

    def put_silver(self, silver_customers: DataFrame, silver_transactions: DataFrame) -> None:
        """Profiles, and the metrics of completed transactions by customer."""
        self.put("silver_customers", silver_customers)
        self.put_metrics(silver_transactions)

    def put_metrics(self, silver_transactions: DataFrame) -> str:
        return self.put("customer_metrics", GC.transaction_metrics(silver_transactions))

    def gold_customer_analytics(self) -> DataFrame:
        """B25 from the stored tables: no exchange."""
        return GC.customer_360(self.get("silver_customers"), colocated(self.get("customer_metrics")), self.cfg)

    def put_gold(self) -> DataFrame:
        self.put("gold_customer_analytics", self.gold_customer_analytics(), placed=True)
        return self.get("gold_customer_analytics")
