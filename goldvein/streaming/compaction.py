"""Small stream files rewritten into large ones.

A stream writes some files per micro-batch and status, and its folder is read
through the sink's log, so files can't be replaced there. ``compact`` copies
the rows of files that no run has taken yet to ``merged/run=<n>`` and then
writes the names of these files to ``merged_files/run=<n>``. That list is the
commit: readers take the merged rows of listed runs, and from the stream the
files in no list. A run that broke off before it left rows that nobody reads;
repeated with its number, it replaces them.

The stream may go on all the time. With the sink's ``retention`` its log
forgets old files, which no reader needs once they are merged.

What the driver holds are file names, as Spark itself does to plan a scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists

STREAM, MERGED, LISTS = "stream", "merged", "merged_files"
LIST_SCHEMA = "file string, run long"
_BY = "record_status"


def _lists(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/{LISTS}"
    return spark.read.schema(LIST_SCHEMA).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], LIST_SCHEMA)


def _new_files(spark: SparkSession, root: str, schema: T.StructType, before: int | None = None) -> list[str]:
    """Files of the stream that no run (``before``: no run of a smaller number) has merged."""
    path = f"{root}/{STREAM}"
    if not path_exists(spark, path):
        return []
    lists = _lists(spark, root)
    lists = lists if before is None else lists.where(F.col("run") < before)
    taken = {r.file for r in lists.select("file").toLocalIterator()}
    return sorted(f for f in spark.read.schema(schema).parquet(path).inputFiles() if f not in taken)


def _rows(spark: SparkSession, root: str, schema: T.StructType, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{STREAM}").parquet(*files).select(*schema.fieldNames())


def unmerged(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows of the stream's files that no run has merged; the stream's own folder as long as there was no run."""
    if path_exists(spark, f"{root}/{LISTS}"):
        return _rows(spark, root, schema, _new_files(spark, root, schema))
    path = f"{root}/{STREAM}"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def merged(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows of all runs whose list is written."""
    path = f"{root}/{MERGED}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    runs = [r.run for r in _lists(spark, root).select("run").distinct().collect()]  # one number a run
    with_run = T.StructType([*schema.fields, T.StructField("run", T.LongType())])
    return spark.read.schema(with_run).parquet(path).where(F.col("run").isin(runs)).select(*schema.fieldNames())


def compact(spark: SparkSession, root: str, schema: T.StructType, run: int) -> int:
    """Merges the stream's new files below ``root``; returns how many it took.

    ``schema`` is that of the sink (``ingest.sink_schema``). Run numbers ascend; a run that
    broke off is repeated with its own, a finished one that is repeated changes nothing.
    AQE sizes the files (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    """
    done = [] if not path_exists(spark, f"{root}/{LISTS}") else _lists(spark, root).where(F.col("run") == run).take(1)
    files = [] if done else _new_files(spark, root, schema, run)
    if not files:
        return 0
    overwrite = lambda df: df.withColumn("run", F.lit(run).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic")
    overwrite(_rows(spark, root, schema, files).hint("rebalance", _BY)).partitionBy("run", _BY).parquet(f"{root}/{MERGED}")
    names = spark.createDataFrame([(f,) for f in files], "file string").coalesce(1)  # one file: listed as a whole or not at all
    overwrite(names).partitionBy("run").parquet(f"{root}/{LISTS}")
    return len(files)
