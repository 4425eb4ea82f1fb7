"""Command line end to end, and exact money sums under any partitioning."""

import json
import os
import random
from decimal import Decimal

from pyspark.sql import functions as F

from goldvein.__main__ import main
from goldvein.functions import rules as R

from .conftest import SF_SMALL


def test_cli_land_run_query(spark, tmp_dir, capsys):
    landing, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "lake")
    main(["land", "--sf", SF_SMALL, "--landing", landing], stop=False)
    assert sorted(os.listdir(landing)) == ["customer-events", "product-events", "system-logs", "transaction-events"]
    capsys.readouterr()
    main(["run", "--out", out, "--landing", landing, "--as-of", "2024-01-31", "--duplicate-tolerance", "0.5", "--no-enforce-tests"],
         stop=False)
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["ingest"]["bronze_system_logs"]["records_read"] == 1000
    assert os.path.isdir(res["paths"]["gold_business_metrics"])
    main(["query", "aov_daily", "--sf", SF_SMALL], stop=False)
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"] > 0


def test_exact_sum_is_partitioning_independent(spark):
    rnd = random.Random(5)
    cents = [rnd.randint(1, 9_999_999) for _ in range(5000)]
    rows = [(c / 100, c % 4) for c in cents]  # doubles like 12345.67, as amounts arrive
    df = spark.createDataFrame(rows, "amount double, cur long").withColumn(
        "usd", R.to_usd("amount", F.when(F.col("cur") == 1, "EUR").when(F.col("cur") == 2, "BRL").otherwise("USD")))
    want_amount = float(sum(Decimal(c) / 100 for c in cents))
    sums = {df.repartition(n).agg(R.exact_sum("amount").alias("s")).first().s for n in (1, 3, 17, 64)}
    assert sums == {want_amount}
    usd = {df.repartition(n, "cur").agg(R.exact_sum("usd").alias("s")).first().s for n in (1, 5, 23)}
    assert len(usd) == 1
