"""Stupid backoff against a direct count over the whole corpus."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from goldvein.llm import backoff_lm as B
from goldvein.llm.catalog import QUERIES

from ..conftest import SF_SMALL


def grams(words, k):
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(texts, order=3, backoff=0.4):
    docs = [re.findall("[^\x20\x09-\x0D]+", (t or "").lower()) for t in texts]
    total = {k: sum((grams(d, k) for d in docs), Counter()) for k in range(1, order + 1)}
    n = sum(map(len, docs))
    out = []
    for d in docs:
        own = {k: grams(d, k) for k in total}
        left = lambda g: total[len(g)][g] - own[len(g)][g]
        logs = 0.0
        for i in range(len(d)):
            factor, value = 1.0, None
            for k in range(min(order, i + 1), 1, -1):
                g = tuple(d[i - k + 1:i + 1])
                if left(g) > 0:
                    value = left(g) / left(g[:-1])
                    break
                factor *= backoff
            if value is None:
                value = max(left((d[i],)), 0.5) / max(1, n - len(d))
            logs += math.log(factor * value)
        out.append((len(d), logs / len(d) if d else None))
    return out


def test_packing():
    values = np.unique(np.random.default_rng(1).integers(0, 2 ** 64, 1000, np.uint64, endpoint=False))
    assert (B._unpack(B._pack(values)) == values).all() and (B._unpack_counts(B._pack_counts(values[:5])) == values[:5].astype(np.int64)).all()


def test_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 7)
    rng = random.Random(8)
    texts = [" ".join(rng.choice("a b c d e the of x y z".split()) for _ in range(rng.randrange(40))) for _ in range(40)]
    texts += [None, "", " \t ", "Alone", "The the THE of", "a b c " * 9000, texts[0], texts[0]]
    df = spark.createDataFrame([(None if i == 3 else i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    want = sorted(((None if i == 3 else i, *x) for i, x in enumerate(brute(texts))), key=str)
    got = sorted(map(tuple, B.score(df.repartition(3)).collect()), key=str)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    for a, b in zip(got, want):
        assert a[2] == b[2] if b[2] is None else a[2] == pytest.approx(b[2], abs=1e-9)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    want = dict(zip((r.doc_id for r in rows), brute([r.text for r in rows])))
    got = {r.doc_id: (r.n_words, r.score) for r in QUERIES["op10_stupid_backoff"](spark, SF_SMALL).collect()}
    assert got.keys() == want.keys()
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1], abs=1e-9) for i in want)


def test_empty(spark):
    assert B.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
