"""Stupid-backoff scores: n-gram count tables partitioned by hash, joined to exploded n-grams.

Score of a word after its history: relative frequency of the longest n-gram
(up to ``ORDER`` words) that occurs elsewhere in the corpus, times ``BACKOFF``
for each word the history was shortened by; a word that occurs nowhere else
counts as half an occurrence. Counts are over all documents and, when a
document is scored, less its own occurrences, so a text never predicts itself.
A document's score is the mean natural logarithm over its words.

The join is relational, at the grain (block of documents, n-gram):

1. ``blocks``: documents are written once to shared storage; each file is one
   block, whose n-grams are exploded, hashed to 64 bits and counted (the
   map-side sum), and sent to the bucket their hash falls in, sorted and
   delta-coded.
2. ``count table``: a bucket adds up the counts of all its blocks. Any n-gram,
   however frequent, arrives once per block. The bucket then joins its total
   counts back to each block that has the n-gram.
3. A block meets its joined counts, applies the back-off at every position
   and sums per document. Nothing is held but one block or one bucket; the
   numbers of blocks and buckets grow with the input.

Words are lower-cased. Defined cases: null text or text
without words has 0 words and a null score; other columns are ignored; rows of
one doc_id repeated are separate documents; a very long text is one block's
work; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import file_system, saved, shared_folder

ORDER, BACKOFF = 3, 0.4
BLOCK_ROWS, BUCKETS_PER_BLOCK = 4096, 2  # documents of a block at most; buckets follow the number of blocks
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _pack(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as deltas, byte planes, compressed."""
    import zstandard
    deltas = np.diff(values, prepend=np.zeros(1, values.dtype)) if len(values) else values
    return zstandard.ZstdCompressor(level=1).compress(deltas.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _pack_counts(values: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_counts(data: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


class Block:
    """The n-grams of a list of texts: per order the distinct ones, their counts, and each position's index among them."""

    def __init__(self, texts: list[str | None], order: int):
        import xxhash
        words = [(t or "").lower().encode().split() for t in texts]
        self.sizes = np.array([len(w) for w in words], np.int64)
        digest = xxhash.xxh3_64_intdigest
        first = np.fromiter((digest(w) for text in words for w in text), np.uint64, int(self.sizes.sum()))
        del words
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.sizes)
        self.place = np.arange(len(first)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.distinct, self.counts, self.at = [], [], []
        h = first
        for k in range(order):
            if k:  # (history, this word), kept at the place of the last word
                h = np.concatenate(([np.uint64(0)], h[:-1])) if len(h) else h
                h = (h * _ODD ^ first) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(k)
                h ^= h >> np.uint64(32)
            where = np.flatnonzero(self.place >= k)  # an n-gram lies inside one document
            values, inverse, counts = np.unique(h[where], return_inverse=True, return_counts=True)
            at = np.full(len(first), -1, np.int32)
            at[where] = inverse
            self.distinct.append(values)
            self.counts.append(counts)
            self.at.append(at)

    def elsewhere(self, k: int, totals: np.ndarray) -> np.ndarray:
        """For each position, how often its n-gram of order k + 1 occurs in other documents."""
        at = self.at[k]
        _, inverse, own = np.unique(self.doc * np.int64(len(totals) + 1) + at + 1, return_inverse=True, return_counts=True)
        known = at >= 0
        out = np.zeros(len(at), np.int64)
        out[known] = totals[at[known]] - own[inverse[known]]
        return out

    def scores(self, totals: list[np.ndarray], backoff: float) -> tuple[np.ndarray, np.ndarray]:
        """Per text: sum of log scores with unigrams as plain counts, and the number of unigrams so used.

        The caller subtracts the logarithm of the number of other words for each of the latter.
        """
        order, step = len(self.at), np.log(backoff)
        left = self.elsewhere(0, totals[0])
        reach = np.minimum(order - 1, self.place)  # the longest history there is
        log, used = np.log(np.maximum(left, 0.5)) + step * reach, np.zeros(len(left), np.int8)
        for k in range(1, order):
            history = np.concatenate(([1], left[:-1])) if len(left) else left  # ends one word earlier
            left = self.elsewhere(k, totals[k])
            hit = np.flatnonzero(left > 0)
            log[hit] = np.log(left[hit] / history[hit]) + step * (reach[hit] - k)
            used[hit] = k
        n = len(self.sizes)
        return np.bincount(self.doc, log, n), np.bincount(self.doc, used == 0, n).astype(np.int64)


def _split(values: np.ndarray, buckets: int) -> np.ndarray:
    """Cuts of ascending hashes into ``buckets`` equal ranges of the hash space."""
    bounds = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    return np.concatenate(([0], np.searchsorted(values, bounds), [len(values)]))


def _read(file: str) -> pa.Table:
    import pyarrow.parquet as pq
    fs, path = file_system(file)
    return pq.read_table(path, filesystem=fs, columns=["doc_id", "text"], partitioning=None)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
          backoff: float = BACKOFF) -> DataFrame:
    """(doc_id, n_words, score) of every row."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "lm-blocks")
    docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .write.option("compression", "zstd").option("maxRecordsPerFile", BLOCK_ROWS).parquet(folder)
    files = sorted(spark.read.schema("doc_id long, text string").parquet(folder).inputFiles())
    buckets = max(1, BUCKETS_PER_BLOCK * len(files))
    blocks = spark.createDataFrame([(f,) for f in files], "block string").repartition(max(1, len(files)))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary())
        for b in batches:
            for file in b.column(0).to_pylist():
                block = Block(_read(file).column("text").to_pylist(), order)
                for k in range(order):
                    cuts = _split(block.distinct[k], buckets)
                    rows = [(k, i, file, _pack(block.distinct[k][x:y]), _pack_counts(block.counts[k][x:y]))
                            for i, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                         names=["k", "bucket", "block", "grams", "counts"])

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        grams = [_unpack(x) for x in rows["grams"]]
        table, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([_unpack_counts(x) for x in rows["counts"]]), len(table)).astype(np.int64)
        cuts = np.cumsum([0, *map(len, grams)])
        return pd.DataFrame({"k": rows["k"], "bucket": rows["bucket"], "block": rows["block"],
                             "totals": [_pack_counts(total[inverse[a:b]]) for a, b in zip(cuts, cuts[1:])]})

    def finish(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        table = _read(key[0])
        block = Block(table.column("text").to_pylist(), order)
        totals = []
        for k in range(order):
            own = rows[rows["k"] == k].sort_values("bucket")
            totals.append(np.concatenate([np.zeros(0, np.int64), *map(_unpack_counts, own["totals"])]))
            if len(totals[k]) != len(block.distinct[k]):
                raise ValueError(f"{key[0]}: {len(totals[k])} counts for {len(block.distinct[k])} n-grams")
        logs, plain = block.scores(totals, backoff)
        ids = table.column("doc_id").to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        return pd.DataFrame({"doc_id": ids, "n_words": block.sizes, "logs": logs, "plain": plain})

    exploded = blocks.mapInArrow(explode, "k int, bucket long, block string, grams binary, counts binary")
    joined = exploded.groupBy("k", "bucket").applyInPandas(join, "k int, bucket long, block string, totals binary")
    # a block without words has no n-gram, but its documents are rows of the result too
    every = blocks.select(F.lit(-1).alias("k"), F.lit(0).cast("long").alias("bucket"), "block", F.lit(None).cast("binary").alias("totals"))
    sums = saved(joined.unionByName(every).groupBy("block").applyInPandas(
        finish, "doc_id long, n_words long, logs double, plain long"), "lm-sums")
    words = sums.agg(F.sum("n_words")).first()[0] or 0
    others = F.log(F.greatest(F.lit(words) - F.col("n_words"), F.lit(1)).cast("double"))
    mean = (F.col("logs") - F.col("plain") * others) / F.col("n_words")
    return sums.select("doc_id", "n_words", F.when(F.col("n_words") > 0, mean).alias("score"))
