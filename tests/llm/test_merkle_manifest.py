"""Merkle manifest against a plain recursive tree."""

import hashlib
import random
import zlib

import pytest

from goldvein.llm import merkle_manifest as M
from goldvein.llm.catalog import QUERIES

from ..conftest import SF_SMALL

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, add=0):
    d, s, lang, n, t = row
    n = None if n is None else n + add
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, s, lang, n, t)])


def climb(nodes):
    """(root, path of every node); a path is a list of (left, right)."""
    paths, level, where = [[] for _ in nodes], nodes, list(range(len(nodes)))
    while len(level) > 1:
        for k, at in enumerate(where):
            paths[k].append((level[at - 1], "") if at % 2 else ("", level[at + 1] if at + 1 < len(level) else ""))
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
        where = [at // 2 for at in where]
    return level[0], paths


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
    low = {lang: climb([leaf(r) for r in trees[lang]]) for lang in langs}
    root, above = climb([low[lang][0] for lang in langs])
    out = []
    for lang, upper in zip(langs, above):
        for r, path in zip(trees[lang], low[lang][1]):
            path = path + upper
            add = int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
            at = leaf(r, add)
            for left, right in path:
                at = h(left, at, right)
            out.append((r[0], leaf(r), low[lang][0], root, h(*[x + y for x, y in path]), at, at == root))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, M.verified(M.document_manifest(df)).collect()), key=str)


@pytest.mark.parametrize("n", (1, 5, 300, 1100))
def test_trees_of_many_sizes(spark, n, monkeypatch):
    monkeypatch.setattr(M, "BITS", 2)  # blocks of 16: several rounds
    rng = random.Random(n)
    langs = [None, "aa", "zz", "é", ""] + [f"l{k}" for k in range(n // 20)]
    rows = [(i * 3 - 7, rng.choice(["s", None]), langs[0] if i % 3 else rng.choice(langs), rng.choice([i, None]), f"text {i}") for i in range(n)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = QUERIES["op12_merkle_manifest"](spark, SF_SMALL)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (3, "", "", 2 ** 63 - 1, ""), (3, "", "", 4, "é€😀"),
            (3, "", "", 4, "é€😀"), (7, "tree", "aa", -1, "x" * 300_000), (-9, "s", "aa", 0, "a:b-")]
    df = spark.createDataFrame([(*r, "t", 1, "h") for r in rows], SCHEMA + ", tree string, pos int, h string")
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []


def test_a_hot_language_of_equal_rows(spark):
    rows = [(1, "s", "hot", 5, "same")] * 700 + [(i, "s", "cold", 5, "t") for i in range(40)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
