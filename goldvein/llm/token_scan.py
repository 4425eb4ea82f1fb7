"""Token counts of documents in flat, unindexed token files, by separator scan.

A token file is nothing but identifiers, ``DTYPE`` little endian, each document
followed by the end-of-document identifier. Documents are found again by
scanning: files are cut into blocks of fixed size, each block is searched for
separators in one vectorised comparison, and the blocks are stitched by a
prefix scan - the last separator and the number of separators before each
block - so documents may span any number of blocks. The scan over the blocks
has two levels (``SUPER`` blocks each), so no task sees all blocks of a file.

``write_token_files`` makes such files from texts with a public tokenizer
whose path is a parameter (nothing is trained). Tasks write files of their own
and return, in file order, the ids of the documents; a retried task writes new
files and only the successful attempt's are listed.

Defined cases: null or empty text is a document of 0 tokens; the separator
never comes from text; repeated rows are separate documents; identifiers after
the last separator are an open document (``closed`` false); empty files and
tables have no documents; a very long document is scanned in blocks as any
other. Other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import file_system, saved

DTYPE, EOD = np.dtype("<u2"), 50_256
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
BLOCK_TOKENS, SUPER, FILE_BYTES = 1 << 21, 1024, 1 << 30


@functools.cache
def _encoder(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if EOD in ranks.values() or max(ranks.values()) > np.iinfo(DTYPE).max:
        raise ValueError(f"{path}: {EOD} must be free and identifiers must fit {DTYPE}")
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                      file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes token files below ``folder``; returns (doc_id, file, ordinal), stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, fs_path = _encoder(tokenizer), TaskContext.get(), file_system(folder)
        fs, path = fs_path
        fs.create_dir(path, recursive=True)
        out, written, files, ordinal, name = None, 0, 0, 0, ""
        end = np.array([EOD], DTYPE).tobytes()
        for b in batches:
            places = []
            for text in b.column(1):
                if out is None:
                    name = f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}-{files:04d}.bin"
                    out, written, ordinal = fs.open_output_stream(f"{path}/{name}"), 0, 0
                ids = encoder.encode_to_numpy(text.as_py() or "").astype(DTYPE)
                written += out.write(ids.tobytes() + end)
                places.append((name, ordinal))
                ordinal += 1
                if written >= file_bytes:
                    out.close()
                    out, files = None, files + 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f for f, _ in places], pa.string()),
                                              pa.array([o for _, o in places], pa.int64())], names=["doc_id", "file", "ordinal"])
        if out is not None:
            out.close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return saved(rows.mapInArrow(run, "doc_id long, file string, ordinal long"), "token-manifest")


def token_files(df: DataFrame, folder: str) -> DataFrame:
    """(file, tokens) of the distinct values of column ``file`` below ``folder``: sizes only, nothing is read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        for b in batches:
            names = b.column(0).to_pylist()
            sizes = [i.size // DTYPE.itemsize for i in fs.get_file_info([f"{path}/{n}" for n in names])] if names else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=["file", "tokens"])

    return df.select("file").distinct().mapInArrow(run, "file string, tokens long")


def scan(files: DataFrame, folder: str, block_tokens: int = BLOCK_TOKENS, eod: int = EOD) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of every document in the files (file, tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        for b in batches:
            for file, block, tokens in zip(*(c.to_pylist() for c in b.columns)):
                start = block * block_tokens
                with fs.open_input_file(f"{path}/{file}") as f:
                    ids = np.frombuffer(f.read_at(min(block_tokens, tokens - start) * DTYPE.itemsize, start * DTYPE.itemsize), DTYPE)
                ends = np.flatnonzero(ids == eod) + start
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                                                 names=["file", "block", "ends"])

    blocks = files.where("tokens > 0").select("file", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / block_tokens))).alias("block"), "tokens")
    found = saved(blocks.repartition("file", "block").mapInArrow(run, "file string, block long, ends array<long>"), "token-blocks")
    found = found.withColumn("super", F.floor(F.col("block") / SUPER))
    count, last = F.size("ends").cast("long"), F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1)
    inner = Window.partitionBy("file", "super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("file").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    supers = found.groupBy("file", "super").agg(F.sum(count).alias("c"), F.max(last).alias("l")).select(
        "file", "super", F.coalesce(F.sum("c").over(outer), F.lit(0)).alias("_count"), F.max("l").over(outer).alias("_last"))
    stitched = found.withColumn("_c", F.coalesce(F.sum(count).over(inner), F.lit(0))).withColumn("_l", F.max(last).over(inner)) \
        .join(supers, ["file", "super"]).select("file", "ends", (F.col("_c") + F.col("_count")).alias("before"),
                                                F.coalesce("_l", "_last", F.lit(-1)).alias("left"))
    docs = stitched.select("file", "before", "left", "ends", F.posexplode("ends").alias("i", "end")) \
        .withColumn("start", F.when(F.col("i") == 0, F.col("left")).otherwise(F.element_at("ends", F.greatest("i", F.lit(1)))) + 1) \
        .select("file", (F.col("before") + F.col("i")).alias("ordinal"), "start", (F.col("end") - F.col("start")).alias("n_tokens"),
                F.lit(True).alias("closed"))
    whole = found.groupBy("file").agg(F.sum(count).alias("ordinal"), (F.coalesce(F.max(last), F.lit(-1)) + 1).alias("start"))
    tail = files.join(whole, "file").where("tokens > start").select(
        "file", "ordinal", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    return docs.unionByName(tail)


def token_counts(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens): texts are tokenized into flat files below ``folder``, which are then scanned."""
    places = write_token_files(docs, folder, tokenizer=tokenizer)
    found = scan(saved(token_files(places, folder), "token-files"), folder, block_tokens)
    return places.join(found.select("file", "ordinal", "n_tokens"), ["file", "ordinal"]).select("doc_id", "n_tokens")
