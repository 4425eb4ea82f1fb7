"""The pipeline's stages against brute force, each on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from goldvein.llm import edit_decontam
from goldvein.llm.common import saved, table

from . import test_fuzzy_lines as lines
from . import test_simhash_gray as prints

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    out, docs = [table(spark, SF, "documents")], table(spark, SF, "documents")
    for name, stage in P.STAGES:
        docs = saved(stage(spark, docs, SF), "stage")
        out.append(docs)
    return [{r.doc_id: r for r in d.collect()} for d in out], [d.columns for d in out], [d.count() for d in out]


def test_columns_and_rows(steps):
    rows, columns, counts = steps
    assert all(c == COLUMNS for c in columns[:-1]) and columns[-1][:5] == COLUMNS
    assert [len(r) for r in rows] == counts
    assert all(len(b) <= len(a) for a, b in zip(rows, rows[1:]))


def test_language_id_keeps_all_texts_with_letters(steps):
    before, after = steps[0][:2]
    assert {i for i, r in before.items() if any(c.isalpha() for c in r.text or "")} == set(after)


def test_line_dedup(steps):
    before, after = steps[0][1:3]
    judged = lines.brute([(i, r.text) for i, r in before.items()])
    for i, r in before.items():
        text = "\n".join(t for n, t in enumerate(r.text.split("\n")) if judged.get((i, n), (0, 0, True))[2])
        assert (after[i].text, after[i].n_chars) == (text, len(text))


def test_near_dedup(steps):
    before, after = steps[0][2:4]
    roots = prints.brute_components({i: prints.brute_print(r.text) for i, r in before.items()}, 4)
    assert set(after) == set(roots.values()) and len(after) < len(before)


def test_decontamination(spark, steps):
    before, after = steps[0][3:5]
    matcher = edit_decontam.Matcher([tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()], 0.1)
    assert set(before) - set(after) == {i for i, r in before.items() if matcher.found(r.text)}


def test_mixing(steps):
    before, after = steps[0][4:6]
    assert set(after) <= set(before) and all(r.copies in (1, 2) and r.taken == r.copies * r["size"] for r in after.values())
    for source in {r.source for r in after.values()}:
        own = [r for r in after.values() if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(0.1 * own[0].target, 10)


def test_run_and_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "aa", "s", 0), (2, "gab dab fab\nx", None, None, None),
                                  (3, "gab dab fab\nx", "aa", "s", 9), (3, "gab dab fab\nx", "aa", "s", 9), (6, "12 !", "aa", "s", 3),
                                  (7, "an ITEM that  leaked into a text", "aa", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    items = spark.createDataFrame([(1, "item that leaked into"), (None, None)], "item_id long, text string")
    for name, rows in (("some", docs), ("none", docs.limit(0))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        items.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    # 1 and 6 have no letter, 7 holds the item; 3 repeats the lines of 2: one row of it stays, with an empty text
    assert sorted((r.doc_id, r.text) for r in P.run(spark, f"{tmp_path}/some").collect()) == [(2, "gab dab fab\nx"), (3, "")]
    assert P.run(spark, f"{tmp_path}/none").collect() == []


def test_unlike_rows_of_one_id_stay(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta epsilon\nsame line here"), (1, "same line here\nrho sigma tau upsilon phi chi"),
                                  (1, "same line here\nrho sigma tau upsilon phi chi"), (2, "same line here\nzeta eta theta iota kappa")],
                                 "doc_id long, text string").withColumn("n_chars", F.length("text"))
    lines_out = saved(P.line_dedup(spark, docs, SF), "stage")
    assert sorted((r.doc_id, r.text) for r in lines_out.collect()) == [
        (1, "alpha beta gamma delta epsilon"), (1, "same line here\nrho sigma tau upsilon phi chi"),
        (1, "same line here\nrho sigma tau upsilon phi chi"), (2, "zeta eta theta iota kappa")]
    assert sorted((r.doc_id, r.text) for r in P.near_dedup(spark, lines_out, SF).collect()) == [
        (1, "alpha beta gamma delta epsilon"), (1, "same line here\nrho sigma tau upsilon phi chi"), (2, "zeta eta theta iota kappa")]


def test_each_copy_is_a_row(spark):
    named = spark.createDataFrame([(1, 2, "x")], "doc_id long, copies int, copy string")
    assert sorted(tuple(r) for r in P.copied(named).collect()) == [(1, 2, 1), (1, 2, 2)]
    docs = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "doc_id long, copies int")
    assert sorted(tuple(r) for r in P.copied(docs).collect()) == [(2, 1, 1), (3, 2, 1), (3, 2, 2)]


def test_registered_query_emits_the_copies(monkeypatch, spark):
    import __spark_entry__ as entry
    monkeypatch.setattr(P, "run", lambda s, d: s.createDataFrame([(1, 2), (2, 1)], "doc_id long, copies int"))
    assert sorted(r.doc_id for r in entry.queries()["pipeline"](spark, "").collect()) == [1, 1, 2]
