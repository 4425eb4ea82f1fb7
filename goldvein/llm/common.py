"""What several operators share: tables, shared storage, the word rule, components, ranks.

Words, here and in every operator that says "words", are maximal runs of
characters other than U+0020 and U+0009-U+000D.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

#: The same six characters Java's ``\s`` and Python's ``bytes.split()`` mean.
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the plan
    before this point. The folder is the one in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A URI of a new folder in shared storage, for files that tasks write themselves."""
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"llm-{name}")
    return path if ":/" in path else f"file://{path}"


def file_system(uri: str):
    """(pyarrow file system, path) of a URI; works on any executor."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri.replace("file:///", "/") if uri.startswith("file:///") else uri)


def word_count(text: Column) -> Column:
    """Number of words, as a long; null text has 0."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.coalesce(bare, F.lit("")) == "", 0).otherwise(F.size(F.split(bare, SPACE))).cast("long")


def ranked(df: DataFrame, by: str, name: str) -> DataFrame:
    """``df`` with column ``name``: the position from 1 in the order of ``by``, null last.

    Rows are range-partitioned, so no task sorts the whole; the only ordered
    pass over everything is over one row count per partition.
    """
    sliced = saved(df.repartitionByRange(F.col(by).asc_nulls_last()).withColumn("_slice", F.spark_partition_id()), "ranked")
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy("_slice").agg(F.count("*").alias("_n")) \
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(F.col(by).asc_nulls_last()))
    return sliced.join(sizes, "_slice").withColumn(name, F.col("_before") + inside).drop("_slice", "_before")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an undirected graph: (node, root), root = smallest node.

    Alternates the large-star and small-star steps: each hangs every
    neighbour of a node on the smallest one, and after O(log^2 n) rounds each
    component is a star around its minimum. Only per-node minima are
    aggregated, so a node with very many neighbours is never gathered; the
    join that carries the minimum back is one that AQE can split. Nodes
    without an edge don't appear. An empty edge table gives an empty result.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    pairs = saved(pairs, "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                               F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u > v").distinct())
        pairs = saved(small, "stars")
        # the stars no longer change: an order-free digest of the edge set
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
