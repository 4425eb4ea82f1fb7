"""Separator scan against direct tokenization and a plain split."""

import numpy as np
import pytest

from goldvein.llm import token_scan as T
from goldvein.llm.catalog import QUERIES
from goldvein.llm.common import file_system, shared_folder

from ..conftest import SF_SMALL


def plain(ids):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == T.EOD:
            out.append((len(out), start, i - start, True))
            start = i + 1
    return out + ([(len(out), start, len(ids) - start, False)] if start < len(ids) else [])


@pytest.mark.parametrize("block", (1, 3, 7, 64))
def test_documents_across_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(T, "SUPER", 4)
    rng = np.random.default_rng(3)
    files = {"a": rng.choice([1, 2, T.EOD], 90, p=[.45, .45, .1]), "b": np.array([T.EOD] * 9), "c": np.ones(70), "d": np.zeros(0),
             "e": np.concatenate((np.ones(60), [T.EOD], np.ones(3), [T.EOD, T.EOD]))}
    folder = shared_folder(spark, "tokens")
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    for name, ids in files.items():
        with fs.open_output_stream(f"{path}/{name}") as f:
            f.write(ids.astype(T.DTYPE).tobytes())
    table = T.token_files(spark.createDataFrame([(n,) for n in files], "file string"), folder)
    got = {}
    for r in T.scan(table, folder, block_tokens=block).collect():
        got.setdefault(r.file, []).append((r.ordinal, r.start, r.n_tokens, r.closed))
    assert {k: sorted(v) for k, v in got.items()} == {k: plain(v) for k, v in files.items() if len(v)}


def test_query_equals_direct_counts(spark):
    encoder = T._encoder(T.TOKENIZER)
    want = {r.doc_id: len(encoder.encode_ordinary(r.text or "")) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op8_token_separator_scan"](spark, SF_SMALL).collect()} == want


def test_odd_rows(spark):
    texts = [None, "", "<|endoftext|>", "a b c", "a b c", "word " * 50_000]
    docs = spark.createDataFrame([(None if i == 3 else min(i, 4), t, "f") for i, t in enumerate(texts)], "doc_id long, text string, file string")
    encoder = T._encoder(T.TOKENIZER)
    got = T.token_counts(docs, shared_folder(spark, "tokens"), block_tokens=1000).collect()
    want = [(None if i == 3 else min(i, 4), len(encoder.encode_ordinary(t or ""))) for i, t in enumerate(texts)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert T.token_counts(docs.limit(0), shared_folder(spark, "tokens")).collect() == []
