"""rANS token files: exact round trips against the tokenizer itself."""

import io
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from goldvein.llm import rans_tokens as R
from goldvein.llm.catalog import QUERIES
from goldvein.llm.common import shared_folder

from ..conftest import SF_SMALL


def plain(text):
    return R._encoder(R.default_tokenizer()).tokenizer.encode(text or "", add_special_tokens=False).ids


def brute(rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*plain(text), R.END], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


class Memory(io.BytesIO):
    def read_at(self, n, at):
        return self.getbuffer()[at:at + n].tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abZ'’sTé́İß12 ½.,!\"-_<|>\t\n\x0b\x01\x1f\xa0жЖй中文̇²") | st.characters(exclude_categories=["Cs"]), max_size=40))
def test_pieces_give_the_ids_of_the_whole_text(text):
    assert R._encoder(R.default_tokenizer()).ids(text).tolist() == plain(text)


def test_special_strings_contractions_and_long_texts(monkeypatch):
    encoder = R._encoder(R.default_tokenizer())
    texts = ["a <|endoftext|> b", "<|ENDOFTEXT|> x", "don't we'LL ''s '' x'S, (\"'d\") 3rd 12,5%", "wörter, und; mehr... "] * 2
    monkeypatch.setattr(R, "STRETCH", 50)
    monkeypatch.setattr(R, "MEMO", 3)
    for t in [*texts, " ".join(texts * 30), "x" * 500]:
        assert encoder.ids(t).tolist() == plain(t)


@pytest.mark.parametrize("n, symbols, block, lanes", [(1, 1, 64, 4), (1000, 1, 64, 4), (5000, 7, 333, 16), (40_000, 20_000, 9000, 1024), (999, 999, 2000, 8)])
def test_files(n, symbols, block, lanes):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), symbols).astype(np.uint32) if symbols < 999 else rng.permutation(n).astype(np.uint32) % symbols
    starts = np.unique(np.concatenate(([0], rng.integers(0, n, 20))))
    doc_ids = [None if k % 5 == 4 else k - 3 for k in range(len(starts))]
    out = Memory()
    blocks = R.write_file(out, ids, doc_ids, starts, block, lanes)
    raw = out.getvalue()
    f = R.File(out, len(raw))
    got, at, named = [], [], []
    for k in reversed(range(blocks)):  # any order, each alone
        part, where, names = f.block(k)
        got.insert(0, part)
        at.insert(0, where + int(f.index[k]["ids_before"]))
        named = names + named
    assert (np.concatenate(got) == ids).all() and (np.concatenate(at) == starts).all() and named == doc_ids
    damaged = Memory(raw[:int(f.index[0]["offset"]) + 20] + b"\0\1\2\3" + raw[int(f.index[0]["offset"]) + 24:])
    with pytest.raises(ValueError):
        R.File(damaged, len(raw)).block(0)


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.02, 1 << 18), 400).astype(np.uint32)
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    out = Memory()
    R.write_file(out, ids, [1], np.array([0]))
    assert len(out.getvalue()) * 8 < 1.08 * len(ids) * -(p * np.log2(p)).sum()


def test_combined_checksums():
    a, b = random.Random(3).randbytes(1000), random.Random(4).randbytes(77)
    assert R._combined(zlib.crc32(a), len(b), zlib.crc32(b)) == zlib.crc32(a + b)
    assert R._combined(zlib.crc32(a), 0, 0) == zlib.crc32(a)


def test_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op11_rans_tokens"](spark, SF_SMALL).collect())) == brute(map(tuple, rows))


def test_odd_rows_and_documents_over_many_blocks(spark):
    texts = [(7, None), (3, ""), (5, "a b c"), (5, "a b c"), (5, "other words"), (1, "word " * 3000 + "x"), (None, "no id"), (9, "\"1 \x01 é")]
    docs = spark.createDataFrame([(d, t, "f", 1) for d, t in texts], "doc_id long, text string, file string, n long").repartition(4)
    known = [r for r in sorted(texts, key=lambda r: (r[0] is None, r[0] or 0)) if r[0] != 5]
    for block, file_ids in ((7, 1 << 20), (64, 10), (1 << 18, 1 << 24)):
        got = sorted(R.roundtrip(docs, shared_folder(spark, "rans"), block_ids=block, file_ids=file_ids).collect(), key=lambda r: r.start)
        assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(r[2:] for r in brute(texts))
        assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
        assert [r.doc_id for r in got] == [1, 3, 5, 5, 5, 7, 9, None]
        assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id != 5] == [(r[0], *r[2:]) for r in brute(known)]
    assert R.roundtrip(docs.limit(0), shared_folder(spark, "rans")).collect() == []
