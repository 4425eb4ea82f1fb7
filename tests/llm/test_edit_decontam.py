"""Edit matching against a full dynamic programme."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from goldvein.llm import edit_decontam as D
from goldvein.llm.catalog import QUERIES

from ..conftest import SF_SMALL


def least_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=70), st.text("abc ", max_size=90))
def test_myers(pattern, text):
    assert D.myers(pattern, text) == least_edits(pattern, text)


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdef")
        elif kind == 1:
            out.insert(at, rng.choice("abcdef"))
        else:
            del out[at]
    return "".join(out)


def test_matcher_equals_brute_force():
    rng = random.Random(3)
    sentence = lambda n: D.normal(" ".join("".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 7))) for _ in range(n)))
    items = [(i, sentence(rng.choice((1, 2, 8, 20, 40)))) for i in range(12)]
    matcher = D.Matcher(items, 0.1)
    hits = 0
    for _ in range(60):
        item = rng.choice(items)[1]
        text = D.normal(sentence(15) + " " + changed(rng, item, rng.randrange(len(item) // 6 + 1)) + " " + sentence(15))
        want = {k: e for k, it in enumerate(matcher.items) if (e := least_edits(it.text, text)) <= it.budget}
        assert matcher.found(text) == want
        assert bool(matcher.found(text, first=True)) == bool(want)
        hits += len(want)
    assert hits > 30


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id): 0 for d in docs for i in items if D.normal(i.text) in D.normal(d.text)}
    got = {(r.doc_id, r.item_id): r.errors for r in QUERIES["op6_edit_decontam"](spark, SF_SMALL).collect()}
    assert {k for k, e in got.items() if e == 0} == set(want)


def test_blocks_and_odd_rows(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(120)) for _ in range(9)]
    items = spark.createDataFrame([*enumerate(texts), (0, texts[0]), (77, None), (78, " "), (None, "lonely item here")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(None, 1, None), ("x", 2, ""), ("y", 3, "pre " + texts[4].upper() + " post"), ("z", 4, "clean"),
                                  ("y", 3, "pre " + texts[4].upper() + " post"), ("n", None, "a LONELY  item\nhere"),
                                  ("l", 6, "filler " * 30_000 + texts[7] + " " + texts[2])], "item_id string, doc_id long, text string")
    for size in (10 ** 6, 300):
        got = sorted(map(tuple, D.contaminated(docs, items, block_chars=size).select("doc_id", "item_id").collect()), key=str)
        assert got == sorted([(3, 4), (6, 2), (6, 7), (None, None)], key=str)
        clean = D.decontaminated(docs, items, block_chars=size)
        assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2, 4]
    none = items.limit(0)
    assert D.contaminated(docs, none).count() == 0 and D.decontaminated(docs, none).count() == 7
    assert D.contaminated(docs.limit(0), items).count() == 0


def test_repetitive_text_takes_time_in_proportion():
    import time
    item = "ab " * 110 + "a different end of the item"
    matcher = D.Matcher([(1, item), (2, "ab " * 60 + "ac " * 60)], 0.1)
    texts = {n: "ab " * n for n in (1000, 30_000)}
    began = time.perf_counter()
    found = {n: matcher.found(t) for n, t in texts.items()}
    assert time.perf_counter() - began < 5
    for n, t in texts.items():  # the same as one search over the whole text
        want = {k: e for k, i in enumerate(matcher.items) if (e := D.myers(i.text, D.normal(t))) <= i.budget}
        assert found[n] == want
