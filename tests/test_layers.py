"""Silver and gold operators on hand-made bronze rows (NULL defaults, fan-out, ELSE branches)."""

from pyspark.sql import functions as F

from goldvein.config import PipelineConfig
from goldvein.operators import gold_customer as GC
from goldvein.operators import gold_metrics as GM
from goldvein.operators import silver as S
from goldvein.schemas import BRONZE_SCHEMAS

CFG = PipelineConfig()


def bronze(spark, table, rows):
    schema = BRONZE_SCHEMAS[table]
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def tx(i, cust, amount, status="completed", cur="USD", fraud=0.1, ts="2024-01-10T10:00:00", pay="paypal", cat="food"):
    return dict(event_id=f"e{i}", transaction_id=f"t{i}", customer_id=cust, amount=amount, currency=cur,
                status=status, payment_method=pay, category=cat, fraud_score=fraud, timestamp=ts,
                processed_at="2024-01-31T00:00:00")


def test_silver_transactions_filters_and_columns(spark):
    rows = [tx(1, "c1", 50.0), tx(2, None, 50.0), tx(3, "c1", 0.0), tx(4, "c1", 100000.0),
            tx(5, "c1", 99999.99, cur="EUR", fraud=0.7, ts="2024-01-06T05:59:59")]
    out = S.silver_transactions(bronze(spark, "bronze_transaction_events", rows), CFG).orderBy("transaction_id").collect()
    assert [r.transaction_id for r in out] == ["t1", "t5"]
    t5 = out[1]
    assert t5.is_high_risk is True and t5.amount_category == "High" and t5.time_of_day == "Night"
    assert t5.day_of_week == 6 and t5.day_type == "Weekend" and t5.amount_usd == 99999.99 * 1.1
    assert str(t5.transaction_date) == "2024-01-06" and t5.transaction_hour == 5


def test_silver_customers_defaults_and_grain(spark):
    ce = bronze(spark, "bronze_customer_events", [
        dict(event_id="a", customer_id="c1", email="x@y", country="BR", device_type="mobile", timestamp="2024-01-20T00:00:00"),
        dict(event_id="b", customer_id="c1", email="x@y", country="BR", device_type="desktop", timestamp="2023-12-01T00:00:00"),
        dict(event_id="c", customer_id="c2", email="nope", country="US", device_type="mobile", timestamp="2024-01-20T00:00:00"),
        dict(event_id="d", customer_id="c3", email="z@y", country="US", device_type="tablet", timestamp="2023-12-31T00:00:00"),
    ])
    te = bronze(spark, "bronze_transaction_events", [tx(1, "c1", 600.0), tx(2, "c1", 500.0, status="failed", fraud=0.7),
                                                     tx(3, "c1", 1.0, fraud=0.71)])
    pe = bronze(spark, "bronze_product_events", [dict(event_id="p", customer_id="c1", product_id="p1", action="purchase",
                                                      rating=4.0, timestamp="2024-01-01T00:00:00")])
    out = {(r.customer_id, r.device_type): r for r in S.silver_customers(ce, te, pe, CFG).collect()}
    assert set(out) == {("c1", "mobile"), ("c1", "desktop"), ("c3", "tablet")}  # c2 has no valid email
    m = out[("c1", "mobile")]
    assert (m.total_transactions, m.successful_transactions, m.high_risk_transactions) == (3, 2, 1)  # '>' 0.7
    assert m.total_spent == 1101.0 and m.customer_segment == "High Value" and m.success_rate_pct == 66.67
    assert m.customer_status == "Active" and out[("c1", "desktop")].customer_status == "Inactive"
    c3 = out[("c3", "tablet")]
    assert (c3.total_transactions, c3.total_spent, c3.success_rate_pct) == (0, 0.0, 0.0)
    assert c3.last_transaction_date is None and c3.avg_rating_given is None
    assert c3.customer_segment == "Low Value" and c3.customer_status == "Inactive"
    assert m.unique_products_viewed == 1 and m.avg_rating_given == 4.0


def test_gold_null_metrics_fall_to_else(spark):
    ce = bronze(spark, "bronze_customer_events", [
        dict(event_id="a", customer_id="c1", email="x@y", country="BR", device_type="mobile", timestamp="2024-01-30T00:00:00"),
        dict(event_id="b", customer_id="c2", email="z@y", country="US", device_type="mobile", timestamp="2024-01-30T00:00:00")])
    te = bronze(spark, "bronze_transaction_events", [
        tx(1, "c1", 10.0, pay="paypal"), tx(2, "c1", 10.0, pay="debit_card"), tx(3, "c1", 10.0, pay="paypal"),
        tx(4, "c1", 3000.0, pay="debit_card", ts="2024-01-11T23:00:00"),
        tx(5, "c2", 10.0, status="pending")])
    pe = bronze(spark, "bronze_product_events", [])
    stx = S.silver_transactions(te, CFG)
    scu = S.silver_customers(ce, te, pe, CFG)
    gold = {r.customer_id: r for r in GC.gold_customer_analytics(scu, stx, CFG).collect()}
    c1, c2 = gold["c1"], gold["c2"]
    assert c1.preferred_payment_method == "debit_card"  # 2-2 tie -> smallest value
    assert c1.total_transactions_detailed == 4 and c1.transaction_days == 2 and c1.high_value_transactions == 1
    assert c1.estimated_ltv == 3030.0 * 2 and c1.ltv_category == "High LTV"
    assert c1.composite_risk_score == 0.1 * 0.4 + 0.0 + 0.0 + 0.1  # stddev > 1000
    assert (c2.total_transactions_detailed, c2.estimated_ltv, c2.composite_risk_score) == (None, None, None)
    assert (c2.ltv_category, c2.risk_level, c2.engagement_level) == ("Low LTV", "Low Risk", "Low Engagement")
    assert (c2.recency_score, c2.frequency_score, c2.monetary_score) == (1, 1, 1)


def test_business_metrics_invariants(spark):
    rows = [tx(i, f"c{i % 3}", 10.0 + i, status=["completed", "failed", "pending"][i % 3],
               pay=["paypal", "debit_card"][i % 2], cat=["food", "books"][i % 2],
               ts=f"2024-01-{1 + i % 4:02d}T10:00:00") for i in range(40)]
    stx = S.silver_transactions(bronze(spark, "bronze_transaction_events", rows), CFG)
    ce = bronze(spark, "bronze_customer_events", [
        dict(event_id=f"a{i}", customer_id=f"c{i}", email="x@y", country="BR", device_type=d,
             timestamp="2024-01-01T00:00:00") for i in range(3) for d in ("mobile", "tablet")])
    scu = S.silver_customers(ce, bronze(spark, "bronze_transaction_events", rows),
                             bronze(spark, "bronze_product_events", []), CFG)
    m = GM.gold_business_metrics(stx, scu, CFG)
    by = lambda t: {(str(r.metric_date), r.dimension_value): r for r in m.where(F.col("metric_type") == t).collect()}
    rev, pay, cat, conv, ctry = by("revenue"), by("payment_performance"), by("category_performance"), \
        by("conversion"), by("country_performance")
    for (d, _), r in rev.items():
        assert sum(p.metric_value for (pd, _), p in pay.items() if pd == d) == r.supporting_metric_1
        completed_rev = sum(c.metric_value for (cd, _), c in cat.items() if cd == d)
        completed_n = sum(c.supporting_metric_1 for (cd, _), c in cat.items() if cd == d)
        assert conv[(d, "success_rate")].supporting_metric_1 == completed_n
        # country rows fan out: every customer has two profile rows in one country
        assert abs(ctry[(d, "BR")].metric_value - 2 * completed_rev) < 1e-6
    assert set(m.select("metric_type").distinct().toPandas().metric_type) == {
        "revenue", "conversion", "acquisition", "risk", "category_performance", "payment_performance",
        "country_performance"}


def test_layer_schemas_follow_the_survey(spark):
    """SURVEY §1.3: 19 silver transaction, 22 silver customer and 30 gold customer columns."""
    from goldvein.plans.catalog import L
    layers = L(spark, "/root/testdata/sf0.001")
    assert tuple(layers.silver_tx.columns) == S.SILVER_TRANSACTION_COLUMNS and len(S.SILVER_TRANSACTION_COLUMNS) == 19
    assert tuple(layers.silver_cust.columns) == S.SILVER_CUSTOMER_COLUMNS and len(S.SILVER_CUSTOMER_COLUMNS) == 22
    assert tuple(layers.gold_cust.columns) == GC.GOLD_CUSTOMER_COLUMNS and len(GC.GOLD_CUSTOMER_COLUMNS) == 30
    kpis = GM.gold_business_metrics(layers.silver_tx, layers.silver_cust)
    assert tuple(kpis.columns) == GM.LONG_COLUMNS + ("processed_at",)
    types = dict(kpis.dtypes)
    assert [types[c] for c in GM.LONG_COLUMNS[4:]] == ["double"] * 3


def test_one_row_per_customer_keeps_latest_profile(spark):
    ce = bronze(spark, "bronze_customer_events", [
        dict(event_id="a", customer_id="c1", email="x@y", country="BR", device_type="mobile", timestamp="2024-01-20T00:00:00"),
        dict(event_id="b", customer_id="c1", email="x@y", country="BR", device_type="desktop", timestamp="2024-01-25T00:00:00"),
        dict(event_id="c", customer_id="c2", email="z@y", country="US", device_type="tablet", timestamp="2024-01-01T00:00:00")])
    te = bronze(spark, "bronze_transaction_events", [tx(1, "c1", 5.0)])
    pe = bronze(spark, "bronze_product_events", [])
    out = S.silver_customers(ce, te, pe, PipelineConfig(one_row_per_customer=True)).collect()
    by = {r.customer_id: r for r in out}
    assert len(out) == 2 and by["c1"].device_type == "desktop" and by["c1"].total_transactions == 1
    assert tuple(r for r in S.silver_customers(ce, te, pe, PipelineConfig(one_row_per_customer=True)).columns) == \
        S.SILVER_CUSTOMER_COLUMNS


def test_tolerant_casts(spark):
    import pytest
    rows = [tx(1, "c1", 50.0), tx(2, "c1", 60.0, ts="not a time")]
    with pytest.raises(Exception):
        S.silver_transactions(bronze(spark, "bronze_transaction_events", rows), CFG).collect()
    out = S.silver_transactions(bronze(spark, "bronze_transaction_events", rows),
                                PipelineConfig(tolerant_casts=True)).orderBy("transaction_id").collect()
    assert [r.transaction_timestamp is None for r in out] == [False, True]
