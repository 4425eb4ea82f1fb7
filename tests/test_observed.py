"""Checks gathered while a table is written equal the checks that read it."""

from datetime import datetime

from goldvein.operators import quality as Q
from goldvein.operators.observed import write_checked
from goldvein.plans.pipeline import write_and_check

NOW = datetime(2024, 1, 31, 12)
SCHEMA = "email string, total_spent double, created_at timestamp_ntz, day string"
ROWS = [("a@b", 1.0, datetime(2024, 1, 1), "x"), ("ab", -1.0, datetime(2024, 1, 31, 11), "x"), (None, None, None, "y"), ("c@d", 2.0, datetime(2024, 2, 1), None)]


def checks():
    return {"rows": Q.row_check(NOW, "t"), "complete": Q.completeness_check("t", ["email", "created_at", "day"]), "fresh": Q.freshness_check("created_at", "t", NOW)}


def same(spark, found, path):
    written = spark.read.schema(SCHEMA).parquet(path)
    for name, check in checks().items():
        assert sorted(map(str, found[name].collect())) == sorted(map(str, check.on(written).collect())), name
        assert found[name].schema.names == check.on(written).schema.names


def test_equal_to_reading(spark, tmp_dir):
    df = spark.createDataFrame(ROWS * 50, SCHEMA).repartition(7)
    found = write_and_check(df, f"{tmp_dir}/plain", checks())
    same(spark, found, f"{tmp_dir}/plain")
    assert found["rows"].first().failed_records == 100 and spark.read.parquet(f"{tmp_dir}/plain").count() == 200
    same(spark, write_and_check(df, f"{tmp_dir}/by_day", checks(), "day"), f"{tmp_dir}/by_day")


def test_behind_a_shuffle_and_several_writes(spark, tmp_dir):
    df = spark.createDataFrame(ROWS * 50, SCHEMA).repartition(5).distinct()
    for n in range(2):
        same(spark, write_and_check(df, f"{tmp_dir}/t", checks()), f"{tmp_dir}/t")


def test_empty_table_and_no_checks(spark, tmp_dir):
    same(spark, write_and_check(spark.createDataFrame([], SCHEMA), f"{tmp_dir}/none", checks()), f"{tmp_dir}/none")
    same(spark, write_and_check(spark.createDataFrame(ROWS, SCHEMA).where("false"), f"{tmp_dir}/never", checks()), f"{tmp_dir}/never")
    assert write_checked(spark.createDataFrame(ROWS, SCHEMA), lambda df: df.write.parquet(f"{tmp_dir}/u") or f"{tmp_dir}/u", {}) == {}
    assert spark.read.parquet(f"{tmp_dir}/u").count() == 4
