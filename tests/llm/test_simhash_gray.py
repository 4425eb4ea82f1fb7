"""SimHash operator against brute force."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from goldvein.llm import simhash_gray as G
from goldvein.llm.catalog import QUERIES

from ..conftest import SF_SMALL


def brute_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for i in ids:
        for j in ids:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprint_cases():
    cases = [None, "", " \t\n", "one", "A b", "a B c d", "a b c d e", "É é x y z É", "x y z", "a " * 9000,
             "the Cat\x0bsat\x0con\rthe mat " * 40000]
    for text in cases:
        assert G.fingerprint(text) == brute_print(text)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: brute_print(r.text) for r in rows}
    roots = brute_components(fps, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash_gray"](spark, SF_SMALL).collect()}
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in fps}


def near_codes(seed, n, spread):
    rng = random.Random(seed)
    bases = [rng.getrandbits(64) for _ in range(n // 20)]
    out = {rng.getrandbits(64) for _ in range(n // 4)} | {0, 2 ** 64 - 1}
    while len(out) < n:
        code = rng.choice(bases)
        for _ in range(rng.randrange(spread)):
            code ^= 1 << rng.randrange(64)
        out.add(code)
    return np.array(sorted(out), np.uint64)


def test_index_finds_every_neighbour():
    codes = near_codes(1, 1500, 7)
    codes = codes[np.argsort(G.gray_rank(codes))]
    q, hit = G.neighbours(codes, codes, 4)
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    assert set(zip(q.tolist(), hit.tolist())) == set(zip(*map(list, np.nonzero(apart <= 4))))


def test_gray_rank_is_the_inverse_of_the_gray_code():
    r = near_codes(2, 200, 3)
    assert (G.gray_rank(r ^ (r >> np.uint64(1))) == r).all()


def test_crowded_nodes_are_split_without_losing_links(spark):
    codes = near_codes(3, 600, 6)
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    want = brute_components({i: int(c) for i, c in enumerate(codes)}, 4)
    want = {int(codes[i]): int(codes[r]) for i, r in want.items()}
    for limit in (10_000, 40, 6):
        from goldvein.llm.common import components
        tree = components(G.links(df, 4, node_limit=limit), "a", "b").collect()
        got = {r.node % 2 ** 64: r.root for r in tree}
        groups = {}
        for c, r in want.items():
            groups.setdefault(r, set()).add(c)
        found = {}
        for c, r in got.items():
            found.setdefault(r, set()).add(c)
        assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_odd_rows(spark):
    schema = "text string, doc_id long, fp string, component_id int"
    docs = spark.createDataFrame([(None, 7, "x", 1), ("", 3, None, None), ("a b c d e f", 9, "", 2),
                                  ("a b c d e f", 9, "", 2), ("A B C D E F", 4, "", 0)], schema)
    got = sorted((r.doc_id, r.component_id) for r in G.near_duplicates(docs).collect())
    assert got == [(3, 3), (4, 4), (7, 3), (9, 4), (9, 4)]
    kept = G.keep_one(docs.unionByName(spark.createDataFrame([("a b c d e f", None, "", 0)], schema)))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 3), (False, 4), (True, None)]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert G.near_duplicates(docs).select(F.hex("fp")).collect() == []
    assert G.keep_one(docs).collect() == []
