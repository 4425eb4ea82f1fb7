"""Fuzzy line dedup against brute force."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from goldvein.llm import fuzzy_lines as L

SCHEMA = "doc_id long, text string, id string, norm string"


def norm(line):
    return " ".join(re.findall(r"[^\W_]+", line.lower()))


def simhash(text):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in set(text.split(" "))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def brute(docs):
    lines = [(d, n, norm(t)) for d, text in docs if text is not None for n, t in enumerate(text.split("\n"))]
    lines = [x for x in lines if x[2]]
    forms = sorted({x[2] for x in lines})
    sims, root = {f: simhash(f) for f in forms}, {f: f for f in forms}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(forms):
        for b in forms[:i]:
            if (sims[a] ^ sims[b]).bit_count() <= L.MAX_BITS and edits(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9):
                root[find(a)] = find(b)
    first = {}
    for d, n, f in sorted(lines, key=lambda x: x[:2]):
        first.setdefault(find(f), (d, n))
    return {(d, n): (*first[find(f)], first[find(f)] == (d, n)) for d, n, f in lines}


def made(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    base = [[rng.choice(words) for _ in range(rng.choice((1, 3, 12, 60)))] for _ in range(12)]
    docs = []
    for d in range(n):
        text = []
        for _ in range(rng.randrange(6)):
            line = list(rng.choice(base)) if rng.random() < 0.8 else [rng.choice(words) for _ in range(9)]
            for _ in range(rng.choice((0, 0, 1, 2))):
                line[rng.randrange(len(line))] = rng.choice(words)
            text.append(rng.choice((" ", "  ", ", ")).join(line).capitalize() + rng.choice((".", "", " !")))
        docs.append((d, "\n".join(text)))
    return docs


def got(spark, docs, **options):
    df = spark.createDataFrame([(d, t, "x", None) for d, t in docs], SCHEMA)
    return {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no, r.kept) for r in L.judged_lines(df, **options).collect()}


def test_equals_brute_force(spark):
    docs = made(5, 120)
    want = brute(docs)
    assert sum(not k for *_, k in want.values()) > 20
    assert got(spark, docs) == want


def test_close_pairs_in_large_buckets(spark):
    # many variants of one long line share buckets; some link only through each other
    rng = random.Random(9)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    docs = []
    for d in range(40):
        own = list(words)
        for _ in range(d // 4):
            own[rng.randrange(150)] = f"v{rng.randrange(40)}"
        docs.append((d, " ".join(own)))
    assert got(spark, docs) == brute(docs)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "\n...\nA b\n\na B!"), (3, "\n...\nA b\n\na B!"), (None, "a b\nnew line"), (5, "a  b\n***")]
    rows = got(spark, docs)
    assert rows == {(3, 2): (3, 2, True), (3, 4): (3, 2, False), (None, 0): (3, 2, False), (None, 1): (None, 1, True),
                    (5, 0): (3, 2, False)}
    df = spark.createDataFrame([(d, t, "x", None) for d, t in docs], SCHEMA)
    out = L.without_duplicate_lines(df)
    assert out.columns == df.columns
    texts = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert texts == sorted([(1, None), (2, ""), (3, "\n...\nA b\n"), (3, "\n...\nA b\n"), (None, "a b\nnew line"), (5, "***")], key=str)


def test_empty_and_long(spark):
    assert got(spark, []) == {}
    long = " ".join(f"w{i % 997}" for i in range(40_000)) + " "
    rows = got(spark, [(1, long), (2, long + "more"), (3, "x\n" * 3000), (3, "x\n" * 3000)])
    assert rows[2, 0] == (1, 0, False) and rows[3, 2999] == (3, 0, False)


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = L.simhashes(L.lines(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and F is not None


def test_one_changed_word_is_found(spark):
    # against edit similarity alone: lines of 40 words with one word changed
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(3, 9))) for _ in range(2000)]
    docs = []
    for d in range(0, 400, 2):
        line = rng.sample(words, 40)
        docs.append((d, " ".join(line)))
        line[rng.randrange(40)] = rng.choice(words)
        docs.append((d + 1, " ".join(line)))
    assert all(edits(docs[d][1], docs[d + 1][1]) <= 0.2 * len(docs[d][1]) for d in range(0, 400, 2))
    rows = got(spark, docs)
    assert sum(rows[d + 1, 0] == (d, 0, False) for d in range(0, 400, 2)) >= 0.7 * 200
    assert all(rows[d, 0][2] for d in range(0, 400, 2))


def test_punctuation_and_spaces_do_not_count(spark):
    rows = got(spark, [(1, "Two words."), (2, "two  words"), (3, "Two, words!"), (4, "two word s")])
    assert [rows[d, 0][2] for d in (1, 2, 3, 4)] == [True, False, False, True]


def test_edits_are_judged_exactly(spark):
    # replaced, added and removed words, at the limit of edits and one beyond it
    rng = random.Random(12)
    pairs = []
    for _ in range(150):
        a = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 40))]
        b = list(a)
        for _ in range(rng.randrange(1, 9)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9)))] * rng.randrange(2)
        pairs.append((" ".join(a), " ".join(b) or "x"))
    texts = spark.createDataFrame([(2 * n + m, t) for n, p in enumerate(pairs) for m, t in enumerate(p)], "id long, norm string")
    both = spark.createDataFrame([(2 * n, 2 * n + 1) for n in range(len(pairs))], "a long, b long")
    got = {r.a // 2: r.alike for r in L._alike(both, texts, 0.8).collect()}
    want = {n: edits(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9) for n, (a, b) in enumerate(pairs)}
    assert got == want and 20 < sum(want.values()) < 130


def test_no_band_of_edits_is_tried_twice(spark):
    # short lines that aren't alike: the widest band is the first one
    pairs, texts = spark.createDataFrame([(1, 2)], "a long, b long"), spark.createDataFrame([(1, "a b"), (2, "c d")], "id long, norm string")
    plan = L._alike(pairs, texts, 0.8)._jdf.queryExecution().analyzed().toString()
    assert "> 64" in plan and "> 1024" in plan and "zip_with" in plan


def test_simhash_at_block_limits(spark):
    # lines of as many distinct words as fill a block, all blocks or a part, and one word less or more
    sizes = [1, 2, 3, 31, 32, 33, 64, 127, 128, 129, 254, 255, 256, 257, 258, 381, 382, 600]
    texts = {n: " ".join(f"w{(i * 7919 + n * 31) % 10 ** 6}" for i in range(n)) for n in sizes}
    texts |= {1000 + n: f"{texts[n]} {texts[n]}" for n in (2, 33, 256)}  # repeats count once
    sims = L.simhashes(L.lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    got = {r.doc_id: r.sim % 2 ** 64 for r in sims.select("doc_id", "sim").collect()}
    assert got == {d: simhash(t) for d, t in texts.items()}


def test_words_of_usual_lines_are_not_looped_over(spark):
    # one interpreted loop over words that hashes them; counting loops only over the parts of very long lines
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = L.simhashes(L.lines(df))._jdf.queryExecution().optimizedPlan().toString()
    assert f"> {L.BLOCK * L.BLOCKS})" in plan and "^" in plan
    # the filter of lines doesn't hold the normal form, which would be computed twice
    assert not any("regexp_replace" in x for x in plan.split("\n") if x.strip(" :+-").startswith("Filter"))


def test_equal_ends_are_left_out_of_edits(spark):
    texts = spark.createDataFrame([(1, "x"), (2, "x y"), (3, "a b c d e f g h x i j"), (4, "a b c d e f g h i j"), (5, "b a b"), (6, "b")], "id long, norm string")
    pairs = [(1, 2), (3, 4), (5, 6)]
    got = {(r.a, r.b): r.alike for r in L._alike(spark.createDataFrame(pairs, "a long, b long"), texts, 0.8).collect()}
    assert got == {(1, 2): False, (3, 4): True, (5, 6): False}
    plan = L._alike(spark.createDataFrame(pairs, "a long, b long"), texts, 0.8)._jdf.queryExecution().analyzed().toString()
    assert "array_position" in plan and "least(_most" in plan
