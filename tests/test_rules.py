"""Unit tests of the row rules on hand-made rows, including every boundary."""

from datetime import date

from pyspark.sql import functions as F

from goldvein.functions import rules as R


def one(spark, expr, value, typ):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_risk_flag_boundary(spark):
    assert one(spark, R.is_high_risk, 0.7, "double") is True
    assert one(spark, R.is_high_risk, 0.699, "double") is False
    assert one(spark, R.is_high_risk, None, "double") is False


def test_amount_category(spark):
    assert [one(spark, R.amount_category, v, "double") for v in (1000.0, 999.99, 100.0, 99.99, None)] == \
        ["High", "Medium", "Medium", "Low", "Low"]


def test_time_of_day_all_hours(spark):
    got = [one(spark, R.time_of_day, h, "int") for h in range(24)]
    assert got == ["Night"] * 6 + ["Morning"] * 7 + ["Afternoon"] * 6 + ["Evening"] * 5


def test_weekday_sunday_zero(spark):
    df = spark.createDataFrame([("2024-01-07 10:00:00",), ("2024-01-06 10:00:00",), ("2024-01-08 10:00:00",)], "t string")
    rows = df.select(R.weekday_sunday0(R.to_ts("t")).alias("d")).collect()
    assert [r.d for r in rows] == [0, 6, 1]  # Sunday, Saturday, Monday
    assert [one(spark, R.day_type, d, "int") for d in (0, 6, 1, 5)] == ["Weekend", "Weekend", "Weekday", "Weekday"]


def test_to_usd(spark):
    df = spark.createDataFrame([(100.0, "EUR"), (100.0, "BRL"), (100.0, "GBP"), (100.0, "USD"), (100.0, None)],
                               "a double, c string")
    got = [r.u for r in df.select(R.to_usd("a", "c").alias("u")).collect()]
    assert got == [100.0 * 1.1, 100.0 * 0.2, 125.0, 100.0, 100.0]


def test_success_rate_rounding_half_up(spark):
    df = spark.createDataFrame([(1, 32), (2, 3), (0, 0), (None, None), (1, 8)], "s bigint, t bigint")
    got = [r.p for r in df.select(R.success_rate_pct("s", "t").alias("p")).collect()]
    assert got == [3.13, 66.67, 0.0, 0.0, 12.5]


def test_customer_status_exactly_30_days(spark):
    as_of = date(2024, 1, 31)
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2023-12-31 23:59:59",)], "t string")
    got = [r.s for r in df.select(R.customer_status(R.to_ts("t"), as_of).alias("s")).collect()]
    assert got == ["Active", "Inactive"]


def test_segment_and_tiers(spark):
    assert [one(spark, R.customer_segment, v, "double") for v in (1000.0, 100.0, 99.0, None)] == \
        ["High Value", "Medium Value", "Low Value", "Low Value"]
    assert [one(spark, R.ltv_category, v, "double") for v in (5000.0, 1000.0, 999.0, None)] == \
        ["High LTV", "Medium LTV", "Low LTV", "Low LTV"]
    assert [one(spark, R.risk_level, v, "double") for v in (0.7, 0.4, 0.39, None)] == \
        ["High Risk", "Medium Risk", "Low Risk", "Low Risk"]


def test_ltv(spark):
    df = spark.createDataFrame([(1000.0, 30), (1000.0, 29), (None, None)], "r double, d bigint")
    got = [r.v for r in df.select(R.estimated_ltv("r", "d").alias("v")).collect()]
    assert got == [1000.0 * (365.0 / 30) * 0.8, 2000.0, None]


def test_composite_risk(spark):
    df = spark.createDataFrame([(0.5, 2, 1, 4, 1000.1), (0.5, 0, 0, 0, None), (None, 1, 1, 1, 1.0)],
                               "f double, h bigint, n bigint, c bigint, s double")
    got = [r.v for r in df.select(R.composite_risk_score("f", "h", "n", "c", "s").alias("v")).collect()]
    assert got[0] == 0.5 * 0.4 + (2 / 4) * 0.3 + (1 / 4) * 0.2 + 0.1
    assert got[1] == 0.5 * 0.4
    assert got[2] is None


def test_engagement_and_rfm(spark):
    as_of = date(2024, 1, 31)
    df = spark.createDataFrame([
        (30, "2024-01-24 00:00:00", "2024-01-01", 50, 5000.0),
        (10, "2024-01-01 00:00:00", "2023-11-02", 20, 1000.0),
        (29, "2024-01-30 00:00:00", "2023-08-04", 10, 500.0),
        (None, None, None, None, None),
    ], "d bigint, a string, l string, n bigint, m double")
    out = df.select(R.engagement_level("d", R.to_ts("a"), as_of).alias("e"),
                    R.recency_score(F.to_date("l"), as_of).alias("r"),
                    R.frequency_score("n").alias("f"), R.monetary_score("m").alias("m")).collect()
    assert [(r.e, r.r, r.f, r.m) for r in out] == [
        ("Highly Engaged", 5, 5, 5), ("Moderately Engaged", 4, 4, 4), ("Moderately Engaged", 3, 3, 3),
        ("Low Engagement", 1, 1, 1)]
