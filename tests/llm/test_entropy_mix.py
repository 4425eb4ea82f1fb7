"""Entropy balancing: targets, rates and rounding."""

import math
import re
from fractions import Fraction

from pyspark.sql import functions as F

from goldvein.llm import entropy_mix as M
from goldvein.llm.catalog import QUERIES

from ..conftest import SF_SMALL


def reshared(sizes):
    """Targets by passing the excess on, round after round, in exact fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, pot = dict.fromkeys(names, Fraction(0)), Fraction(3, 2) * sum(sizes.values())
    while pot:
        open_ = [s for s in names if target[s] < 2 * sizes[s]]
        if not open_:
            break
        each, pot = pot / sum(weight[s] for s in open_), Fraction(0)
        for s in open_:
            target[s] += each * weight[s]
            if target[s] > 2 * sizes[s]:
                pot += target[s] - 2 * sizes[s]
                target[s] = Fraction(2 * sizes[s])
        if pot < Fraction(1, 10 ** 9):
            break
    return target


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    size = {i: len(re.findall("[^\x20\x09-\x0D]+", r.text or "")) for i, r in docs.items()}
    total, taken = {}, {}
    for i, r in docs.items():
        total[r.source] = total.get(r.source, 0) + size[i]
    goal = reshared(total)
    rows = QUERIES["op5_entropy_mix"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.size, r.source_size) for r in rows} == {i: (size[i], total[r.source]) for i, r in docs.items()}
    for r in rows:
        source = docs[r.doc_id].source
        assert math.isclose(r.target, goal[source], rel_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[source] = taken.get(source, 0) + r.taken
    smallest = {s: min(size[i] for i, r in docs.items() if r.source == s) for s in total}
    for s in total:  # ten documents a source here: near is within what moving one small document could mend
        assert abs(taken[s] - goal[s]) <= max(0.05 * goal[s], smallest[s])


def test_rates_are_exponential_and_meet_the_targets_and_reruns_agree(spark):
    data = [(i, "abc"[i % 3], 1 + (i * 37) % 91) for i in range(300)]
    data += [(1000 + i, None, 10) for i in range(900)] + [(2000, "z", 0)]  # a hot source of equal documents, one of none
    docs = spark.createDataFrame(data, "doc_id long, source string, size long")
    rows = M.mix(docs, size=F.col("size")).collect()
    assert sorted(map(str, rows)) == sorted(map(str, M.mix(docs.repartition(5), size=F.col("size")).collect()))
    assert len(rows) == len(data)
    hot = [r for r in rows if r.source is None]
    assert abs(sum(r.taken for r in hot) - hot[0].target) <= 10
    assert [(r.target, r.taken) for r in rows if r.source == "z"] == [(0.0, 0)]
    for s in "abc":
        own = [r for r in rows if r.source == s and r.size]
        assert math.isclose(sum(r.rate * r.size for r in own), own[0].target, rel_tol=1e-8)
        lams = [math.log(r.rate) / r.size for r in own if r.rate < 2]
        assert not lams or max(lams) - min(lams) < 1e-9 * max(1, max(map(abs, lams)))
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.01 * own[0].target


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "s", 5), (None, "a b", None, 5), (3, " \x0b x\ty\n", "s", 5), (3, " \x0b x\ty\n", "s", 5),
                                  (4, "w " * 50_000, "t", 5), (5, "", "", 5)], "doc_id long, text string, source string, taken int")
    rows = M.mix(docs).collect()
    assert sorted(r["size"] for r in rows) == [0, 0, 2, 2, 2, 50_000]
    assert len({r.copies for r in rows if r.doc_id == 3}) == 1
    assert M.mix(docs).columns == ["doc_id", "text", "source", *M.ADDED]
    assert M.mix(docs.limit(0)).collect() == []
    nothing = M.mix(spark.createDataFrame([(1, None, "s"), (2, " ", None)], "doc_id long, text string, source string")).collect()
    assert [(r.target, r.taken) for r in nothing] == [(0.0, 0)] * 2
