"""WARC writer and reader: exact round trips."""

import hashlib

import zstandard
from pyspark.sql import functions as F

from goldvein.llm import warc_zstd as W
from goldvein.llm.catalog import ORACLES, QUERIES
from goldvein.llm.common import file_system, shared_folder

from ..conftest import SF_SMALL
from ..oracle_compare import compare, duck

SCHEMA = "page_id long, url string, html string, refers_to string"


def test_round_trip_of_odd_rows(spark):
    big = "<p>é</p>" * 400
    rows = [(1, "http://a/", big, "x"), (5, None, big, None), (3, "http://b/\r\nX: y", big, ""), (None, "u", big, "x"),
            (7, "http://c/", None, "x"), (8, "http://c/", "", "x"), (9, "s", "short", "x"), (10, "s", "short", "x"),
            (11, "l", "WARC/1.1\r\n\r\n" * 200_000, "x"), (12, "z", "y" * 1000, "x"), (12, "z", "y" * 1000, "x"), (2, "z", "y" * 1000, "x"),
            (13, "w", "y" * 999, "x"), (14, "w", "y" * 999, "x")]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    manifest = W.write_archives(pages, shared_folder(spark, "warc"), archive_bytes=1500)
    got = W.read_archives(manifest, with_html=True).collect()
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) and manifest.count() > 3
    revisit = {1: 5, 3: 5, 2: 12}
    want = [(i, (u or "").replace("\r", "%0D").replace("\n", "%0A") if u else None, len(p := (h or "").encode()), hashlib.sha1(p).hexdigest(),
             "revisit" if i in revisit else "response", revisit.get(i), None if i in revisit else p.decode()) for i, u, h, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_archive_format(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    uri = W.write_archives(pages, shared_folder(spark, "warc")).first().archive
    fs, path = file_system(uri)
    with fs.open_input_stream(path) as f:
        data = f.read()
    assert data[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(data[4:8], "little")
    dictionary, rest, n = zstandard.ZstdCompressionDict(data[8:8 + size]), data[8 + size:], 0
    assert 0 < size <= W.DICTIONARY_BYTES
    while rest:  # each record is a frame of its own
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        text = one.decompress(rest)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")
        rest, n = one.unused_data, n + 1
    assert n > 5


def test_query_equals_oracle(spark):
    ok, msg = compare(spark, duck(SF_SMALL), "op7_warc_zstd_dict", QUERIES["op7_warc_zstd_dict"](spark, SF_SMALL), ORACLES["op7_warc_zstd_dict"])
    assert ok, msg


def test_empty(spark):
    manifest = W.write_archives(spark.createDataFrame([], SCHEMA), shared_folder(spark, "warc"))
    assert manifest.collect() == [] and W.read_archives(manifest).collect() == []
