"""Bronze event tables derived from the shared TPC-H-style tables.

The reference fills bronze from random event generators; we derive the four
event streams deterministically from ``events``, ``orders``, ``lineitem``,
``customer``, ``part`` and ``nation`` so that every rule branch is exercised
(NULL ids, outliers, exact-threshold scores, repeated event ids, inactive
customers). The mapping is FIXTURES.md §3 (given as SQL that runs unchanged in Spark and
DuckDB); the oracle queries use the same text as leading CTEs, so the mapping
is an input definition, and everything after it is checked independently.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..schemas import BRONZE_SCHEMAS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class TableReader:
    """Reads each driver table once (file listing and footers) per plan family."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._frames = spark, sf_dir, {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.sf_dir, name)
        return self._frames[name]


# Offset that moves the 1995-2001 order dates into 2017-2024.
DATE_SHIFT_DAYS = 8216

# The FIXTURES.md §3 mapping, one Spark SQL expression per bronze column (each
# string is parsed once in the JVM; building the same columns call by call
# costs thousands of driver round trips per plan).
CUSTOMER_EVENT_COLUMNS = {
    "event_id": "'ce_' || CAST(event_id AS STRING)",
    "event_type": "'customer_event'",
    "timestamp": "CAST(CASE WHEN user_id % 5 = 4 THEN ts - INTERVAL '60' DAY ELSE ts END AS STRING)",
    "customer_id": "CASE WHEN event_id % 211 = 0 THEN NULL ELSE 'cust_' || CAST(user_id AS STRING) END",
    "action": "event_type",
    "email": "CASE WHEN event_id % 199 = 0 THEN NULL WHEN user_id % 29 = 7 THEN 'user' || CAST(user_id AS STRING)"
             " ELSE 'user' || CAST(user_id AS STRING) || '@example.com' END",
    "country": "n_name",
    "device_type": "CASE WHEN user_id % 2 = 0 THEN 'mobile' WHEN event_id % 2 = 0 THEN 'desktop' ELSE 'tablet' END",
    "session_id": "'sess_' || CAST(event_id % 5000 AS STRING)",
    "ip_address": "'sess_ip_' || CAST(user_id AS STRING)",
    "user_agent": "'agent'",
    "kinesis_sequence_number": "CAST(event_id AS STRING)",
    "kinesis_partition_key": "'cust_' || CAST(user_id AS STRING)",
    "processed_at": "CAST(CASE WHEN user_id % 5 = 4 THEN ts - INTERVAL '60' DAY ELSE ts END AS STRING)",
}

TRANSACTION_EVENT_COLUMNS = {
    "event_id": "'te_' || CAST(o_orderkey AS STRING)",
    "event_type": "'transaction_event'",
    "timestamp": f"CAST(o_orderdate + INTERVAL '{DATE_SHIFT_DAYS}' DAY"
                 " + CAST(o_orderkey % 24 AS INT) * INTERVAL '1' HOUR AS STRING)",
    "transaction_id": "'txn_' || CAST(o_orderkey AS STRING)",
    "customer_id": "CASE WHEN o_orderkey % 983 = 0 THEN NULL"
                   " WHEN o_orderkey % 3 = 0 THEN 'cust_' || CAST(o_custkey % 10 AS STRING)"
                   " WHEN o_orderkey % 3 = 1 THEN 'cust_' || CAST(o_custkey % 100 AS STRING)"
                   " ELSE 'cust_' || CAST(o_custkey AS STRING) END",
    "amount": "CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice WHEN o_orderkey % 991 = 0 THEN 0.0D"
              " WHEN o_custkey % 7 = 3 THEN FLOOR(o_totalprice / 100) / 100 ELSE FLOOR(o_totalprice) / 100 END",
    "currency": "CASE o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'BRL' ELSE 'GBP' END",
    "status": "CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'failed'"
              " WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'cancelled' END",
    "payment_method": "CASE (o_orderkey * 31 + o_custkey) % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card'"
                      " WHEN 2 THEN 'paypal' ELSE 'bank_transfer' END",
    "merchant_id": "'merchant_' || CAST(o_orderkey % 900 + 100 AS STRING)",
    "category": "CASE o_orderpriority WHEN '1-URGENT' THEN 'electronics' WHEN '2-HIGH' THEN 'clothing'"
                " WHEN '3-MEDIUM' THEN 'food' WHEN '5-LOW' THEN 'books' ELSE 'travel' END",
    "fraud_score": "CASE WHEN o_custkey % 13 = 5 THEN CAST(850 + o_orderkey % 151 AS DOUBLE) / 1000"
                   " WHEN o_custkey % 11 = 2 THEN CAST(o_orderkey % 51 AS DOUBLE) / 1000"
                   " ELSE CAST((o_orderkey * 7919) % 1001 AS DOUBLE) / 1000 END",
    "kinesis_sequence_number": "CAST(o_orderkey AS STRING)",
    "kinesis_partition_key": "'cust_' || CAST(o_custkey AS STRING)",
    "processed_at": f"CAST(o_orderdate + INTERVAL '{DATE_SHIFT_DAYS}' DAY AS STRING)",
}

PRODUCT_EVENT_COLUMNS = {
    "event_id": "'pe_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING)",
    "event_type": "'product_event'",
    "timestamp": f"CAST(l_shipdate + INTERVAL '{DATE_SHIFT_DAYS}' DAY AS STRING)",
    "product_id": "'prod_' || CAST(l_partkey AS STRING)",
    "customer_id": "'cust_' || CAST(o_custkey AS STRING)",
    "action": "CASE l_returnflag WHEN 'N' THEN 'purchase' WHEN 'R' THEN 'review' ELSE CASE l_linenumber % 3"
              " WHEN 0 THEN 'view' WHEN 1 THEN 'add_to_cart' ELSE 'remove_from_cart' END END",
    "category": "p_type",
    "price": "l_extendedprice / l_quantity",
    "quantity": "CAST(l_quantity AS BIGINT)",
    "rating": "CASE WHEN l_returnflag = 'R' AND o_custkey % 5 <> 0 THEN CAST(l_partkey % 5 + 1 AS DOUBLE) END",
    "session_id": "'sess_' || CAST(l_orderkey % 5000 AS STRING)",
    "kinesis_sequence_number": "CAST(l_orderkey AS STRING)",
    "kinesis_partition_key": "'cust_' || CAST(o_custkey AS STRING)",
    "processed_at": f"CAST(l_shipdate + INTERVAL '{DATE_SHIFT_DAYS}' DAY AS STRING)",
}

SYSTEM_LOG_COLUMNS = {
    "event_id": "'sl_' || CAST(event_id AS STRING)",
    "event_type": "'system_log'",
    "timestamp": "CAST(ts AS STRING)",
    "service": "CASE event_id % 4 WHEN 0 THEN 'api-gateway' WHEN 1 THEN 'user-service'"
               " WHEN 2 THEN 'payment-service' ELSE 'inventory-service' END",
    "level": "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'DEBUG' WHEN 'click' THEN 'WARN'"
             " ELSE 'INFO' END",
    "message": "'message ' || CAST(event_id AS STRING)",
    "request_id": "'req_' || CAST(event_id AS STRING)",
    "response_time_ms": "CAST(FLOOR(value * 10) AS BIGINT) + 10",
    "status_code": "CASE WHEN event_type = 'error' THEN CAST(500 AS BIGINT) ELSE CAST(200 AS BIGINT) END",
    "endpoint": "'/api/v1/' || event_type",
    "user_id": "CASE WHEN event_id % 10 < 3 THEN NULL ELSE 'user_' || CAST(user_id AS STRING) END",
    "kinesis_sequence_number": "CAST(event_id AS STRING)",
    "kinesis_partition_key": "'sl_' || CAST(event_id AS STRING)",
    "processed_at": "CAST(ts AS STRING)",
}


def _project(df: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    """Apply the column expressions and the declared bronze types in one projection."""
    schema = BRONZE_SCHEMAS[table]
    return df.selectExpr(*[f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
                           for f in schema.fields])


def customer_events(read: TableReader) -> DataFrame:
    e = read("events").select("event_id", "ts", "user_id", "event_type")
    c = read("customer").select("c_custkey", "c_nationkey")
    n = read("nation").select("n_nationkey", "n_name")
    j = e.join(c, e.user_id == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return _project(j, "bronze_customer_events", CUSTOMER_EVENT_COLUMNS)


def transaction_events(read: TableReader) -> DataFrame:
    return _project(read("orders"), "bronze_transaction_events", TRANSACTION_EVENT_COLUMNS)


def product_events(read: TableReader) -> DataFrame:
    li = read("lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_shipdate")
    o = read("orders").select("o_orderkey", "o_custkey")
    p = read("part").select("p_partkey", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return _project(j, "bronze_product_events", PRODUCT_EVENT_COLUMNS)


def system_logs(read: TableReader) -> DataFrame:
    return _project(read("events"), "bronze_system_logs", SYSTEM_LOG_COLUMNS)


class Bronze:
    """The four bronze tables of one driver-table folder, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.read = TableReader(spark, sf_dir)

    @cached_property
    def customer_events(self) -> DataFrame:
        return customer_events(self.read)

    @cached_property
    def transaction_events(self) -> DataFrame:
        return transaction_events(self.read)

    @cached_property
    def product_events(self) -> DataFrame:
        return product_events(self.read)

    @cached_property
    def system_logs(self) -> DataFrame:
        return system_logs(self.read)

    def by_table(self) -> dict[str, DataFrame]:
        return {
            "bronze_customer_events": self.customer_events,
            "bronze_transaction_events": self.transaction_events,
            "bronze_product_events": self.product_events,
            "bronze_system_logs": self.system_logs,
        }


def load_bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    """All four bronze tables (lazily built) with the declared bronze schemas."""
    return Bronze(spark, sf_dir)
