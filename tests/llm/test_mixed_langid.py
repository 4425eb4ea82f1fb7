"""Language identification: held-out accuracy, Viterbi against brute force, odd rows."""

import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from goldvein.llm import mixed_langid as I
from goldvein.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(4)
    counts = np.array([0, 1, 5, 3, 0, 6])
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    scores = rng.normal(size=(counts.sum(), 3)).astype(np.float32) * 3
    labels = I.viterbi(scores, starts, counts, 2.0)
    for s, n in zip(starts, counts):
        value = lambda p: sum(float(scores[s + i, k]) for i, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        if n:
            best = max(value(p) for p in itertools.product(range(3), repeat=int(n)))
            assert abs(value(tuple(labels[s:s + n])) - best) < 1e-4


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_mixed_language_id"](spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    out = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert sum(out) / len(out) > 0.98


def small_model(spark):
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randrange(2, 8)))
    sets = {"aa": "abcdefg", "bb": "tuvwxyz", "ru": "абвгдежз", "uk": "абвгіїєж"}
    rows = [(lang, " ".join(word(s) for _ in range(300))) for lang, s in sets.items() for _ in range(3)]
    rows += [(None, "zzz"), ("aa", None), ("bb", "")]
    return I.train(spark.createDataFrame(rows, "lang string, text string")), sets, word


def test_spans_scripts_and_odd_rows(spark):
    model, sets, word = small_model(spark)
    assert model.langs == ["aa", "bb", "ru", "uk"]
    first, second = " ".join(word(sets["aa"]) for _ in range(30)), " ".join(word(sets["ru"]) for _ in range(10))
    texts = [None, "", "123 !?", "́", first + " — " + second, "中文", "İx " + first.upper(), "gab " * 60_000]
    df = spark.createDataFrame([(i, t, "old", 3) for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string, n int")
    out = I.predict(df, model)
    assert out.columns == ["doc_id", "text", "n", "lang_pred", "score", "spans"]
    rows = {r.doc_id: r for r in out.collect()}
    assert [(rows[i].lang_pred, rows[i].score, rows[i].spans) for i in range(4)] == [("und", 0.0, [])] * 4
    mixed = rows[4]
    assert mixed.lang_pred == "aa" and [s.lang for s in mixed.spans] == ["aa", "ru"]
    assert [texts[4][s.start:s.end] for s in mixed.spans] == [first, second]
    assert rows[5].lang_pred in model.langs and rows[6].lang_pred == "aa" and rows[7].lang_pred == "aa"
    assert [s.lang for s in rows[7].spans] == ["aa"]


def test_no_training_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    model = I.train(df.withColumn("lang", F.lit(None).cast("string")))
    assert model is None
    assert [r.lang_pred for r in I.predict(df, model).collect()] == ["und"]
    assert I.predict(df.limit(0), small_model(spark)[0]).collect() == []


def test_languages_without_letters_learn_nothing(spark):
    docs = spark.createDataFrame([("aa", "abc def"), ("bb", "12 34"), ("cc", None)], "lang string, text string").repartition(3)
    model = I.train(docs)
    assert model.langs == ["aa"]


def test_split_batches_agree(spark, monkeypatch):
    model, sets, word = small_model(spark)
    texts = [" ".join(word(sets[k]) for _ in range(n)) for k, n in (("aa", 3), ("ru", 40), ("bb", 0), ("uk", 9), ("aa", 25))]
    whole = I.label(texts, model).to_pylist()
    for part, group in ((50, 120), (7, 30)):  # the second cuts single texts
        monkeypatch.setattr(I, "_PART_CHARS", part)
        monkeypatch.setattr(I, "_GROUP_CHARS", group)
        assert I.label(texts, model).to_pylist() == whole
