"""As-of lookup against a brute-force answer, with one key holding most rows."""

import random
from datetime import datetime, timedelta

from goldvein.operators.asof import asof_latest


def brute(probes, facts):
    out = {}
    for pid, k, t in probes:
        best = None
        for fk, ft, tb, v in facts:
            if k is not None and fk == k and ft is not None and ft <= t and (best is None or (ft, tb) > (best[0], best[1])):
                best = (ft, tb, v)
        out[pid] = best[2] if best else None
    return out


def test_asof_matches_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    t0 = datetime(2024, 1, 1)
    keys = ["hot"] * 30 + ["k1", "k2", "k3", None]
    probes = [(f"p{i}", rnd.choice(keys), t0 + timedelta(minutes=rnd.randint(0, 600))) for i in range(400)]
    facts = [(rnd.choice(keys), t0 + timedelta(minutes=rnd.randint(0, 600)), f"e{i:04d}", rnd.choice("abcd"))
             for i in range(300)]
    facts.append(("hot", probes[0][2], "zzzz", "tie"))  # same time as a probe: counts as at-or-before
    pdf = spark.createDataFrame(probes, "pid string, k string, t timestamp_ntz")
    fdf = spark.createDataFrame(facts, "k string, t timestamp_ntz, tb string, v string")
    got = {r.pid: r.v for r in asof_latest(pdf, fdf, "k", "t", "t", "v", "tb", out="v").collect()}
    want = brute(probes, facts)
    assert got == want
    assert got[probes[0][0]] == ("tie" if probes[0][1] == "hot" else want[probes[0][0]])


def test_asof_odd_rows(spark):
    t0 = datetime(2024, 1, 1)
    pdf = spark.createDataFrame([("late", "k", t0 + timedelta(days=40)), ("edge", "k", t0 + timedelta(hours=2)), ("early", "k", t0 - timedelta(days=1)),
                                 ("timeless", "k", None), ("keyless", None, t0), ("edge", "k", t0 + timedelta(hours=2))], "pid string, k string, t timestamp_ntz")
    fdf = spark.createDataFrame([("k", t0, "1", "a"), ("k", t0 + timedelta(hours=2), "1", "b"), ("k", t0 + timedelta(hours=2), "0", "c"),
                                 ("k", t0 + timedelta(hours=2), "9", None), ("k", None, "1", "d")], "k string, t timestamp_ntz, tb string, v string")
    hit = asof_latest(pdf, fdf, "k", "t", "t", "v", "tb", out="v")
    assert sorted((r.pid, r.v) for r in hit.collect()) == [("early", None), ("edge", "b"), ("edge", "b"), ("keyless", None), ("late", "b"), ("timeless", None)]
    empty = asof_latest(pdf.limit(0), fdf, "k", "t", "t", "v", "tb")
    assert empty.columns == ["pid", "k", "t", "asof_value"] and empty.collect() == []


def brute_sessions(events, gap_s):
    out = {}
    for k in {e[0] for e in events if e[0] is not None}:
        ts = sorted(e[1] for e in events if e[0] == k)
        cur = [ts[0]]
        for t in ts[1:]:
            if (t - cur[-1]).total_seconds() <= gap_s:
                cur.append(t)
            else:
                out.setdefault(k, []).append((cur[0], cur[-1], len(cur)))
                cur = [t]
        out.setdefault(k, []).append((cur[0], cur[-1], len(cur)))
    return {k: sorted(v) for k, v in out.items()}


def test_sessionize_matches_brute_force_with_hot_key(spark):
    from goldvein.operators.sessions import sessionize
    rnd = random.Random(11)
    t0 = datetime(2024, 1, 1)
    keys = ["hot"] * 40 + ["a", "b", None]
    events = [(rnd.choice(keys), t0 + timedelta(minutes=rnd.choice([rnd.randint(0, 3000), rnd.randint(0, 200)])),
               rnd.choice(["view", "click"]), rnd.choice(["mobile", "tablet"])) for _ in range(600)]
    df = spark.createDataFrame(events, "k string, t timestamp_ntz, action string, device_type string")
    got = {}
    for r in sessionize(df, "k", "t", "30 minutes").collect():
        got.setdefault(r.k, []).append((r.first_event, r.last_event, r.n_events))
        assert r.session_end == r.last_event + timedelta(minutes=30) and r.session_start == r.first_event
    assert {k: sorted(v) for k, v in got.items()} == brute_sessions(events, 1800)


def test_global_ntiles_of_several_measures(spark):
    from pyspark.sql import functions as F

    from goldvein.operators.ranking import global_ntiles
    rnd = random.Random(5)
    for n in (0, 1, 4, 23, 301):
        rows = [(f"c{i:04d}", rnd.choice([1.0, 2.0, None]), rnd.randint(0, 10 ** 12)) for i in range(n)]
        df = spark.createDataFrame(rows, "id string, v double, w long")
        got = {r.id: (r.a, r.b) for r in global_ntiles(df, "id", {"a": F.col("v"), "b": F.col("w")}, 5, partitions=7).collect()}
        df.createOrReplaceTempView("ntiles_rows")
        want = spark.sql("SELECT id, ntile(5) OVER (ORDER BY v, id) AS a, ntile(5) OVER (ORDER BY w, id) AS b FROM ntiles_rows").collect()
        assert got == {r.id: (r.a, r.b) for r in want}, n


def test_global_ntile_matches_sql_ntile(spark):
    from goldvein.operators.ranking import global_ntile
    rnd = random.Random(3)
    for n in (1, 4, 5, 23, 301):
        rows = [(f"c{i:04d}", rnd.choice([1.0, 2.0, 3.0, 7.5])) for i in range(n)]
        df = spark.createDataFrame(rows, "id string, v double")
        got = {r.id: r.t for r in global_ntile(df, ["v", "id"], 5, "t", partitions=7).collect()}
        order = sorted(rows, key=lambda r: (r[1], r[0]))
        q, rem = divmod(n, 5)
        want, pos = {}, 0
        for tile in range(1, 6):
            size = q + (1 if tile <= rem else 0)
            for r in order[pos:pos + size]:
                want[r[0]] = tile
            pos += size
        assert got == want, n
