"""Mergeable states: increments equal one pass, untouched partitions keep their files, a repeated batch changes nothing."""

import os
import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from goldvein.config import PipelineConfig
from goldvein.operators import gold_customer as GC
from goldvein.operators import gold_metrics as GM
from goldvein.operators import silver as S
from goldvein.operators import state as ST
from goldvein.plans.incremental import Layers, hourly_run, run_increment
from goldvein.schemas import BRONZE_SCHEMAS, STREAMS
from goldvein.sources.landing import to_envelope, write_landing

CFG = replace(PipelineConfig(), state_period="day")


def rows(spark, table, n, days, seed):
    rng = random.Random(seed)
    schema, out = BRONZE_SCHEMAS[table], []
    for i in range(n):
        ts = datetime(2024, 1, 1) + timedelta(days=rng.choice(days), minutes=rng.randrange(1440))
        c = rng.choice([None, "hot", "hot", "hot", *[f"c{k}" for k in range(9)]])
        r = {"event_id": f"{seed}-{i}", "timestamp": ts.isoformat(), "processed_at": "2024-01-31 00:00:00", "customer_id": c,
             "email": rng.choice([None, "no", f"{c}@x", f"{c}@x"]), "country": rng.choice(["DE", None]), "device_type": "web",
             "transaction_id": f"t{seed}-{i}", "amount": rng.choice([None, -1.0, 99999.99, 12.34, 1000.0]), "currency": rng.choice(["USD", "EUR"]),
             "status": rng.choice(["completed", "completed", "failed"]), "payment_method": rng.choice([None, "pix", "card"]),
             "category": rng.choice(["a", "b", None]), "fraud_score": rng.choice([None, 0.7, 0.123456789012345]),
             "product_id": rng.choice([None, "p1", "p2"]), "action": rng.choice(["purchase", "view"]), "rating": rng.choice([None, 3.5, 5.0])}
        out.append(tuple(r.get(f.name) for f in schema.fields))
    return spark.createDataFrame(out, schema)


TABLES = ("bronze_transaction_events", "bronze_customer_events", "bronze_product_events")


def same(a, b):
    def shown(df):
        flat = [F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes if c != "processed_at"]
        return sorted(map(str, df.select(*flat).collect()))
    assert a.columns == b.columns
    assert shown(a) == shown(b)


def files(root):
    found = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet") and "/_new/" not in d]
    return {f: os.stat(f).st_mtime_ns for f in found}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("increments"))
    batches = [{t: rows(spark, t, 150, days, 10 * k + j) for j, t in enumerate(TABLES)} for k, days in enumerate(([0, 1, 2], [2, 3], [0, 3]))]
    before = []
    for k, bronze in enumerate(batches):
        before.append(files(f"{out}/state"))
        run_increment(spark, out, bronze, k + 1, CFG)
    whole = {t: batches[0][t].unionByName(batches[1][t]).unionByName(batches[2][t]) for t in TABLES}
    return out, batches, before, whole


def test_increments_equal_one_pass(spark, run):
    out, _, _, whole = run
    layers, tx = Layers(spark, out, CFG), S.silver_transactions(whole[TABLES[0]], CFG)
    customers = S.silver_customers(whole[TABLES[1]], whole[TABLES[0]], whole[TABLES[2]], CFG)
    same(layers.transaction_metrics(), GC.transaction_metrics(tx))
    same(layers.silver_customers(), customers)
    same(layers.gold_customer_analytics(), GC.gold_customer_analytics(customers, tx, CFG))
    same(layers.gold_business_metrics(), GM.gold_business_metrics(tx, customers, CFG))
    months = {r.month: (r.transactions, r.customers) for r in layers.customers_by_month().collect()}
    assert months == {"2024-01": (tx.count(), tx.select("customer_id").distinct().count())}  # so few that a sketch is exact
    assert spark.read.parquet(f"{out}/silver/silver_transactions").count() == tx.count()


def test_only_touched_days_are_written(run):
    out, _, before, _ = run
    second, now = before[2], files(f"{out}/state")
    kept = [f for f in second if now.get(f) == second[f]]
    for name in (ST.CUBE.name, ST.COUNTRY.name, ST.DAYS.name):
        days = {f.split("period=")[1][:10] for f in kept if f"/{name}/" in f}
        assert days == {"2024-01-02", "2024-01-03"}  # the third batch brought the 1st and the 4th
        assert {f.split("period=")[1][:10] for f in now if f"/{name}/" in f} == {f"2024-01-0{d}" for d in (1, 2, 3, 4)}


def test_a_batch_applied_again_changes_nothing(spark, run):
    out, batches, _, whole = run
    before = files(f"{out}/state")
    touched = run_increment(spark, out, batches[2], 3, CFG)
    assert set(touched) == {s.name for states in ST.SOURCES.values() for s in states} and not any(touched.values())
    assert files(f"{out}/state") == before
    assert spark.read.parquet(f"{out}/silver/silver_transactions").count() == S.silver_transactions(whole[TABLES[0]], CFG).count()


def test_a_batch_that_broke_off_is_finished(spark, tmp_dir):
    first, second = (S.silver_transactions(rows(spark, TABLES[0], 80, [0, 1], seed), CFG) for seed in (71, 72))
    ST.apply(spark, ST.CUBE, tmp_dir, first, 1, CFG)
    ST.apply(spark, ST.CUBE, tmp_dir, second.where("transaction_date = '2024-01-01'"), 2, CFG)  # one day was finished
    assert ST.apply(spark, ST.CUBE, tmp_dir, second, 2, CFG) == ["2024-01-02"]
    same(ST.read(spark, ST.CUBE, tmp_dir).select(*sorted(ST.CUBE.measures), *ST.CUBE.keys),
         GM.daily_cube(first.unionByName(second)).select(*sorted(ST.CUBE.measures), *ST.CUBE.keys))


def test_deviation_of_equal_amounts_is_zero(spark, tmp_dir):
    tx = S.silver_transactions(rows(spark, TABLES[0], 5, [0], 5).withColumns({
        "amount": F.lit(99999.99), "customer_id": F.lit("c"), "status": F.lit("completed"), "currency": F.lit("USD")}), CFG)
    ST.apply(spark, ST.METRICS, tmp_dir, tx, 1, CFG)
    assert ST.metrics_from(ST.read(spark, ST.METRICS, tmp_dir)).first().transaction_stddev == 0.0


def test_an_empty_batch(spark, tmp_dir):
    none = spark.createDataFrame([], BRONZE_SCHEMAS[TABLES[0]])
    assert ST.apply(spark, ST.SPEND, tmp_dir, none, 1, CFG) == []


def test_no_row_is_expanded_for_distinct_counts(spark):
    tx = S.silver_transactions(rows(spark, TABLES[0], 5, [0], 6), CFG)
    assert "Expand" not in GC.transaction_metrics(tx)._jdf.queryExecution().executedPlan().toString()
    plan = GM.daily_category_payment_rows(GM.daily_cube(tx))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")  # the cube is summed below the grouping sets


def test_hourly_runs_over_a_landing_folder(spark, tmp_dir):
    cfg = replace(CFG, state_period="year", state_slots=4, silver_partition_by=None, duplicate_tolerance=1.0)
    landed = {}
    for hour, seed in ((1, 31), (2, 41), (3, None)):
        for stream, (table, schema) in STREAMS.items():
            if seed and table in TABLES:
                df = rows(spark, table, 60, [0, 5], seed + TABLES.index(table))
                landed[table] = landed[table].unionByName(df) if table in landed else df
                write_landing(to_envelope(df, schema), f"{tmp_dir}/landing/{stream}", 1)
            elif hour == 1:
                write_landing(to_envelope(spark.createDataFrame([], BRONZE_SCHEMAS[table]), schema), f"{tmp_dir}/landing/{stream}", 1)
        at = replace(cfg, as_of=datetime(2024, 1, 31).date(), run_ts=datetime(2024, 1, 31, hour))
        paths = hourly_run(spark, f"{tmp_dir}/out", f"{tmp_dir}/landing", at)  # nothing new in the third hour
    tx = S.silver_transactions(landed[TABLES[0]], cfg)
    customers = S.silver_customers(landed[TABLES[1]], landed[TABLES[0]], landed[TABLES[2]], cfg)
    read = spark.read.parquet(paths["gold_customer_analytics"])
    same(read.select(*GC.GOLD_CUSTOMER_COLUMNS), GC.gold_customer_analytics(customers, tx, cfg))
    same(spark.read.parquet(paths["gold_business_metrics"]).select(*GM.LONG_COLUMNS, "processed_at"), GM.gold_business_metrics(tx, customers, cfg))


def test_states_without_a_batch_are_empty(spark, tmp_dir):
    assert Layers(spark, tmp_dir, CFG).gold_customer_analytics().count() == 0
    assert Layers(spark, tmp_dir, CFG).customers_by_month().count() == 0
