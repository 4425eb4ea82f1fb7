"""WARC archives compressed with a Zstandard dictionary: writer and reader.

An archive starts with a skippable frame that holds the dictionary, followed
by one Zstandard frame per record, so any record can be read on its own. The
dictionary is trained on a bounded sample of the records that are archived
(``SAMPLE_RECORDS`` by hash of their id, up to ``SAMPLE_BYTES``); where the
sample is too small to train on, its records are the dictionary.

Of records with equal payloads of at least ``REVISIT_BYTES``, the one with the
largest page_id is a response and the others are revisits that refer to it.
Payload digests and the choice of the response are made by Spark before
writing: only digests are grouped, and html travels to the join with them
once; a payload that fills a third of the table is split by the skew join.

Each task streams its rows into archives of its own, named by partition and
task attempt and closed at ``ARCHIVE_BYTES``; the manifest lists those of
successful attempts only, so a lost executor leaves no trace in the result.

Defined cases: null html is an empty payload; null url becomes a urn of the
page; a page without an id is always a response; rows with the same page_id
and payload are each archived, the largest ones as responses; line breaks in
urls are escaped; very long payloads are one record; an empty table gives no
archive and an empty result. Other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import file_system, saved

REVISIT_BYTES, ARCHIVE_BYTES, LEVEL = 1000, 1 << 30, 3
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 4 << 20, 64 << 10
# Fixed values of the format: the dictionary frame's magic number and the profile of a revisit.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "archive string, records long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _urn(page_id: int | None, url: str, digest: str) -> str:
    name = f"page:{page_id}" if page_id is not None else f"page-without-id:{url}:{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One uncompressed WARC record; a revisit has the HTTP headers but not the payload."""
    uri = (url or f"urn:page:{page_id}").replace("\r", "%0D").replace("\n", "%0A")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _urn(page_id, uri, digest),
        "WARC-Target-URI": uri,
        "WARC-Date": date,
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "X-Payload-Length": str(len(payload)),
    }
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    if url is None:
        head["X-No-URI"] = "true"
    if refers_to is not None:
        head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _urn(refers_to, "", ""), "X-Refers-To-Page-ID": str(refers_to)}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def judged(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, refers_to) of every page; refers_to is set for revisits."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
                        F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(html).alias("payload_digest"))
    repeated = rows.where(F.col("payload_bytes") >= revisit_bytes).groupBy("payload_digest", "payload_bytes") \
        .agg(F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1 and _last is not null").drop("_n")
    out = rows.join(repeated, ["payload_digest", "payload_bytes"], "left")
    return out.withColumn("refers_to", F.when(F.col("page_id") < F.col("_last"), F.col("_last"))) \
        .select("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to")


def _dictionary(sample: list[bytes]) -> bytes:
    import zstandard
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        return b"".join(sample)[:DICTIONARY_BYTES]


def _zstd_dictionary(data: bytes):
    import zstandard
    return zstandard.ZstdCompressionDict(data) if data else None


class Archive:
    """One open archive file."""

    def __init__(self, folder: str, name: str, dictionary: bytes):
        import zstandard
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        self.uri, self.records = f"{folder}/{name}", 0
        self.out = fs.open_output_stream(f"{path}/{name}")
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zstd_dictionary(dictionary))
        self.bytes = self.out.write(DICTIONARY_MAGIC.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary)

    def add(self, data: bytes) -> None:
        self.bytes += self.out.write(self.compressor.compress(data))
        self.records += 1

    def close(self) -> tuple[str, int]:
        self.out.close()
        return self.uri, self.records


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", revisit_bytes: int = REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives below ``folder`` and returns the manifest (archive, records), stored."""
    first = pages.orderBy(F.xxhash64("page_id", "url")).limit(SAMPLE_RECORDS).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).where(F.length("html") < SAMPLE_BYTES // 8)
    running = F.sum(F.length("html")).over(Window.orderBy(F.xxhash64("page_id", "url")).rowsBetween(Window.unboundedPreceding, 0))
    chosen = first.withColumn("run", running).where(F.col("run") <= SAMPLE_BYTES).collect()  # SAMPLE_BYTES at most
    dictionary = _dictionary([record(r.page_id, r.url, p := r.html.encode(), hashlib.sha1(p).hexdigest(), None, date) for r in chosen])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done, archive = TaskContext.get(), [], None
        for b in batches:
            for row in b.to_pylist():
                if archive is None:
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.zst"
                    archive = Archive(folder, name, dictionary)
                archive.add(record(row["page_id"], row["url"], row["html"].encode(), row["payload_digest"], row["refers_to"], date))
                if archive.bytes >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in done]), pa.array([n for _, n in done], pa.int64())],
                                             names=["archive", "records"])

    rows = judged(pages, revisit_bytes).select("page_id", "url", "html", "payload_digest", "refers_to")
    return saved(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def read_records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of one archive, streamed."""
    import zstandard
    fs, path = file_system(uri)
    with fs.open_input_stream(path) as raw:
        head, dictionary = raw.read(8), b""
        if int.from_bytes(head[:4], "little") == DICTIONARY_MAGIC:
            dictionary, head = raw.read(int.from_bytes(head[4:], "little")), b""
        source = io.BufferedReader(_Joined(head, raw), 1 << 20)
        stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=_zstd_dictionary(dictionary)).stream_reader(
            source, read_across_frames=True), 1 << 20)
        while version := stream.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError(f"{uri}: no WARC record where one should start")
            headers = {}
            while (line := stream.readline()) not in (b"\r\n", b""):
                k, _, v = line.decode().rstrip("\r\n").partition(": ")
                headers[k] = v
            block = stream.read(int(headers["Content-Length"]))
            if stream.read(4) != b"\r\n\r\n":
                raise ValueError(f"{uri}: a record is cut off")
            yield headers, block


class _Joined(io.RawIOBase):
    """Bytes already read, then the rest of a stream."""

    def __init__(self, head: bytes, rest):
        self.head, self.rest = head, rest

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.head[:len(buffer)] or self.rest.read(len(buffer))
        self.head = self.head[len(buffer):]
        buffer[:len(data)] = data
        return len(data)


def read_archives(manifest: DataFrame, with_html: bool = False) -> DataFrame:
    """One row per record of the archives, read back from the files; payloads of responses are checked by digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.string()] * with_html
        names = [c.split()[0] for c in schema.split(", ")]
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows, size = [], 0
                for head, block in read_records(uri):
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if head["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{uri}: {head['WARC-Record-ID']} does not match its digest")
                    page, of = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
                    rows.append((page and int(page), None if "X-No-URI" in head else head["WARC-Target-URI"], int(head["X-Payload-Length"]),
                                 digest, head["WARC-Type"], of and int(of), payload.decode() if of is None else None)[:len(names)])
                    size += with_html * len(payload)
                    if len(rows) == 4096 or size >= 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = RECORDS + ", html string" * with_html
    files = manifest.select("archive").repartition(max(1, manifest.count()))  # archives, not records, are counted
    return files.mapInArrow(run, schema)
