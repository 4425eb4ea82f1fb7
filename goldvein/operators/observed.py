"""Checks while a table is written (T9 with DQ3, DQ4, DQ8): the table isn't read for them.

The aggregates of all checks are observed on the rows on their way to the files
(``Observation``): every writing task sums its own, and one row reaches the
driver. The observation is the last step before the writer, behind any
shuffle, so a task that is run again after its executor was lost counts once.

Where Spark plans no rows at all (a table known to be empty), nothing is
observed; the checks then aggregate the empty table as written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .quality import Check


def write_checked(df: DataFrame, write: Callable[[DataFrame], str], checks: dict[str, Check]) -> dict[str, DataFrame]:
    """Writes ``df`` by ``write`` (which returns the path) and returns the result rows of each check."""
    spark = df.sparkSession
    named, schemas = [], {}
    for n, (name, check) in enumerate(checks.items()):
        schemas[name] = df.agg(*check.aggregates).schema  # names and types only, no job
        named += [a.alias(f"c{n}_{f.name}") for a, f in zip(check.aggregates, schemas[name].fields)]
    seen = Observation()
    path = write(df.observe(seen, *named) if named else df)
    values = seen.get if named else {}
    results = {}
    for n, (name, check) in enumerate(checks.items()):
        columns = [f"c{n}_{f}" for f in schemas[name].fieldNames()]
        if all(c in values for c in columns):
            results[name] = check.finish(spark.createDataFrame([tuple(values[c] for c in columns)], schemas[name]))
        else:
            results[name] = check.on(spark.read.schema(df.schema).parquet(path))
    return results
