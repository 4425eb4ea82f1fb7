"""Ranked lexical search against a plain count."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from goldvein.llm import lexical_scan as L
from goldvein.llm.catalog import QUERIES

from ..conftest import SF_SMALL

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = {k: k + 32 for k in range(65, 91)}


def terms(text):
    return [t.translate(ASCII) for t in TERM.findall(text or "")]


def brute(docs, items, top=20):
    docs = [(d, Counter(terms(t))) for d, t in docs]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    count, length, df = len(docs), sum(n for _, _, n in docs), Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in set(items):
        weight = {t: math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) for t in terms(text)}
        scored = []
        for d, c, n in docs:
            m = 75 + 25 * n * count // length
            score = sum(weight[t] * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    a = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, score int").repartition(3)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return sorted(map(tuple, L.search(a, b, **options).collect()), key=str)


@pytest.mark.parametrize("options", ({}, {"top": 3}, {"block_chars": 60}))
def test_random_texts(spark, options):
    rng = random.Random(7)
    words = ["a", "b", "ab", "Ab", "ÉT", "ét", "x1", "12", "日本", "zz", "q"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "_", "\x7f", "-"]) for _ in range(rng.randrange(n)))
    docs = [(i // 2, text(40)) for i in range(120)]
    items = [(i, text(12)) for i in range(30)]
    want = brute(docs, items, options.get("top", 20))
    assert len(want) > 60 and got(spark, docs, items, **options) == want


def test_query(spark):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").select(k, "text").collect()]
                   for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert sorted(map(tuple, QUERIES["op13_lexical_scan"](spark, SF_SMALL).collect()), key=str) == brute(docs, items)


def test_odd_rows(spark, monkeypatch):
    docs = [(None, "one two"), (4, "one two"), (4, "one two"), (1, None), (2, ""), (3, " ,.;\x00"), (5, "one " * 5000 + "two"), (6, "ONE\ttwo_two")]
    items = [(1, "One two two"), (1, "One two two"), (2, None), (None, "two"), (3, "!"), (4, "absent"), (5, "onetwo"), (1, "other one")]
    assert got(spark, docs, items) == brute(docs, [i for i in items if i[1]])
    assert got(spark, [], items) == got(spark, docs, []) == []
    whole = L._counted("a b a_b! " * 50, L.Searcher([(0, 0, "a b")]).automaton())
    for stretch in (1, 7, 30):
        monkeypatch.setattr(L, "STRETCH", stretch)
        assert L._counted("a b a_b! " * 50, L.Searcher([(0, 0, "a b")]).automaton()) == whole == (200, {0: 100, 1: 100})


def test_large_scores_are_exact():
    s = L.Searcher([(0, 0, "t " * 1000)])
    tfs, weights = [Counter({0: 3}), Counter({0: 1})], np.array([20_000])
    plain = L._scores(s, weights, np.array([5, 9]), tfs, 10, 100)
    s.most_terms = 1 << 40  # forces the halves
    assert (L._scores(s, weights, np.array([5, 9]), tfs, 10, 100) == plain).all()
