"""Token files packed by a static range asymmetric numeral system (rANS), written and read back.

Documents are range-partitioned by id and sorted; each task tokenizes its
stretch and writes files of its own, so the files of ascending partitions hold
the ids in ascending document order. A file is::

    header   magic, bits of the frequency scale, lanes, symbols of the table
    table    symbols and their frequencies (their sum is 1 << scale), CRC-32
    blocks   documents that start here (place, id), lane states, 32-bit words
    index    one checkpoint a block: where it lies, ids and documents before it,
             whether its last document goes on, CRC-32 of its bytes and of its ids
    tail     place and length of the index, CRC-32, magic

The table is counted over all ids of the file before the first is encoded, and
all blocks share it. Within a block, ``LANES`` encoder states take turns, so a
step codes that many symbols with one vector operation. Blocks don't depend on
each other: from its checkpoint any block is decoded alone, by any task, and a
document that spans blocks is put together from the pieces' counts and CRCs.

Texts are tokenized with a public vocabulary file whose path is a parameter;
nothing is trained. Where the file's normalizer and pre-tokenizer allow it
(they do for ``word_bpe_49k``), texts are cut where no token can cross, and
each distinct piece is tokenized once a task.

Defined cases: null text is empty, and a document without tokens is the end id
alone; rows with a null doc_id come last; rows of one doc_id are documents of
their own, in the order of a hash of their texts; a very long text is tokenized
whole, in stretches cut at white space; an empty table writes no file. Other
columns are ignored. A retried task writes new files, and only those of the
successful attempt are listed.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import file_system, saved

END = 1  # appended to each document
BLOCK_IDS, FILE_IDS, LANES = 1 << 18, 1 << 24, 1024
LOW, WORD = np.uint64(1 << 31), np.uint64(32)  # a state is LOW or more and under LOW << 32
MAGIC, HEADER, TAIL = b"GVRANS1\n", struct.Struct("<8sBHI"), struct.Struct("<QII8s")
CHECKPOINT = np.dtype([("offset", "<u8"), ("size", "<u4"), ("n_docs", "<u4"), ("n_ids", "<u4"), ("ids_before", "<u8"),
                       ("docs_before", "<u8"), ("crc", "<u4"), ("ids_crc", "<u4"), ("open", "u1")])
MEMO = 600_000  # words, and as many of their pieces, that a task remembers
STRETCH = 1 << 20  # bytes tokenized at a time

# Letters of Latin and Cyrillic script that neither change their kind when lower-cased nor hold a mark.
_LETTER = "a-zÀ-ÖØ-öø-įı-ɏЀ-ҁҊ-ԯ"
#: Pieces that no token crosses: letters, a digit, ASCII punctuation, or else the rest up to white space.
_PIECE = re.compile(f"[{_LETTER}]++(?![^\\x00-\\x7f])|[0-9](?![^\\x00-\\x7f])"
                    "|[!-&(-/:-@\\[-`{-~]++(?!['\\x00-\\x08\\x0e-\\x1f\\x7f-\U0010ffff])|[^ \\t\\n\\r\\x0b\\x0c]+")
_WORD = re.compile(f"[{_LETTER}]+")
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class _Memo(dict):
    """Results by key, made when first asked for; up to ``MEMO`` stay, until too many others were wanted."""

    def __init__(self, make):
        super().__init__()
        self.make, self.missed = make, 0

    def __missing__(self, key):
        made = self.make(key)
        if len(self) < MEMO and len(key) <= 32:
            self[key] = made
        else:
            self.missed += 1
            if self.missed > 4 * MEMO:
                self.clear()
                self.missed = 0
        return made


class Encoder:
    """Texts to ids, equal to the library's result for each whole text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.special = [t["content"].lower().encode() for t in config["added_tokens"]]
        steps = [s["type"] for s in (config["normalizer"] or {}).get("normalizers", [])]
        splits = [s.get("pattern", {}).get("Regex") for s in (config["pre_tokenizer"] or {}).get("pretokenizers", [])]
        # white space goes, upper case goes, and words, digits and punctuation are apart: cutting between them changes nothing
        self.apart = (steps == ["NFC", "Replace", "Lowercase"]
                      and splits[:1] == ["'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"])
        self.letters, self.pieces, self.words = _Memo(self._letter), _Memo(self._piece), _Memo(self._word)

    def _plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letter(self, letter: str) -> str:
        """How the model sees a letter: normalized, its bytes as characters."""
        return "".join(part for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(letter)))

    def _piece(self, piece: str) -> bytes:
        if not _WORD.fullmatch(piece):
            return self._plain(piece)
        # one word of plain letters: the model alone gives the same at a fraction of the time
        shown = piece if piece.isascii() else "".join([self.letters[c] for c in piece])
        return array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        return b"".join([self.pieces[p] for p in _PIECE.findall(word.decode())])

    def ids(self, text: str | None) -> np.ndarray:
        low = (text or "").encode().translate(_LOWER)
        if not self.apart or any(s in low for s in self.special):
            return np.frombuffer(self._plain(text or ""), "<u4")
        parts, at = [], 0
        while at < len(low):
            gap = _SPACE.search(low, at + STRETCH) if len(low) - at > STRETCH else None
            end = gap.end() if gap else len(low)
            parts.append(b"".join(map(self.words.__getitem__, low[at:end].split())))
            at = end
        return np.frombuffer(b"".join(parts), "<u4")


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


class Table:
    """Symbols with frequencies that add up to ``1 << scale``."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray, scale: int):
        self.symbols, self.freqs, self.scale = symbols, freqs.astype(np.uint64), scale
        self.starts = np.concatenate(([0], np.cumsum(freqs)[:-1])).astype(np.uint64)

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        symbols, counts = np.unique(ids, return_counts=True)
        scale = min(24, max(12, int(len(symbols) - 1).bit_length() + 4))
        slots = 1 << scale
        if len(symbols) > slots:
            raise ValueError(f"more than {slots} distinct ids in a file")
        freqs = np.maximum(1, counts * slots // counts.sum())
        spare = slots - int(freqs.sum())
        if spare < 0:  # the ones of rare symbols are taken from the frequent ones
            room = freqs - 1
            freqs -= room * -spare // room.sum()
            rest, order = int(freqs.sum()) - slots, np.argsort(-freqs, kind="stable")
            while rest:
                some = order[:rest][freqs[order[:rest]] > 1]
                freqs[some] -= 1
                rest -= len(some)
        else:
            freqs[np.argmax(counts)] += spare
        return cls(symbols.astype(np.uint32), freqs, scale)

    def tobytes(self) -> bytes:
        body = self.symbols.astype("<u4").tobytes() + self.freqs.astype("<u4").tobytes()
        return body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def frombytes(cls, raw: bytes, n: int, scale: int) -> Table:
        if zlib.crc32(raw[:8 * n]) != struct.unpack("<I", raw[8 * n:])[0]:
            raise ValueError("the frequency table is damaged")
        return cls(np.frombuffer(raw, "<u4", n), np.frombuffer(raw, "<u4", n, 4 * n).astype(np.int64), scale)

    def encode(self, ids: np.ndarray, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray]:
        """(states, words): symbol k is coded by lane ``k % lanes``; encoded from the last to the first."""
        place = np.zeros(int(self.symbols[-1]) + 1, np.uint32)
        place[self.symbols] = np.arange(len(self.symbols))
        at = place[ids]
        freq, start, scale = self.freqs[at], self.starts[at], np.uint64(self.scale)
        limit = freq << np.uint64(63 - self.scale)
        x, out = np.full(lanes, LOW), []
        for a in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
            f, v = freq[a:a + lanes], x[:min(lanes, len(ids) - a)]
            full = v >= limit[a:a + lanes]
            if full.any():
                out.append(v[full].astype(np.uint32))
                v[full] >>= WORD
            q = v // f
            v[:] = (q << scale) + (v - q * f) + start[a:a + lanes]
        return x, np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)

    @functools.cached_property
    def _slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.symbols), dtype=np.uint32), self.freqs.astype(np.int64))

    def decode(self, states: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        x, lanes, p = states.copy(), len(states), 0
        scale, mask, found = np.uint64(self.scale), np.uint64((1 << self.scale) - 1), np.empty(n, np.uint32)
        words = words.astype(np.uint64)
        for a in range(0, n, lanes):
            v = x[:min(lanes, n - a)]
            slot = v & mask
            s = self._slots[slot]
            found[a:a + lanes] = s
            v[:] = self.freqs[s] * (v >> scale) + slot - self.starts[s]
            short = v < LOW
            k = int(np.count_nonzero(short))
            if k:
                v[short] = (v[short] << WORD) | words[p:p + k]
                p += k
        if p != len(words) or (x != LOW).any():
            raise ValueError("a block does not end where it began")
        return self.symbols[found]


def write_file(out, ids: np.ndarray, doc_ids: list[int | None], starts: np.ndarray, block_ids: int = BLOCK_IDS,
               lanes: int = LANES) -> int:
    """Writes one file of the documents that start at ``starts`` (the first at 0); returns its number of blocks."""
    table = Table.of(ids)
    at = out.write(HEADER.pack(MAGIC, table.scale, lanes, len(table.symbols)))
    at += out.write(table.tobytes())
    marks = []
    for a in range(0, len(ids), block_ids):
        part = ids[a:a + block_ids]
        first, last = np.searchsorted(starts, (a, a + len(part)))
        states, words = table.encode(part, lanes)
        here = doc_ids[first:last]
        body = b"".join(((starts[first:last] - a).astype("<u4").tobytes(),
                         np.array([d or 0 for d in here], "<i8").tobytes(), np.array([d is None for d in here], "u1").tobytes(),
                         states.astype("<u8").tobytes(), words.astype("<u4").tobytes()))
        ends = a + len(part)
        goes_on = ends < len(ids) and not (last < len(starts) and starts[last] == ends)
        marks.append((at, len(body), last - first, len(part), a, first, zlib.crc32(body), zlib.crc32(part.astype("<u4").tobytes()), goes_on))
        at += out.write(body)
    index = np.array(marks, CHECKPOINT).tobytes()
    out.write(index)
    out.write(TAIL.pack(at, len(index), zlib.crc32(index), MAGIC))
    return len(marks)


class File:
    """A file opened for reading: its table and its checkpoints."""

    def __init__(self, source, size: int):
        self.source = source
        at, length, crc, magic = TAIL.unpack(source.read_at(TAIL.size, size - TAIL.size))
        raw = source.read_at(length, at)
        head, scale, lanes, n = HEADER.unpack(source.read_at(HEADER.size, 0))
        if magic != MAGIC or head != MAGIC or zlib.crc32(raw) != crc:
            raise ValueError("not a whole token file")
        self.index, self.lanes = np.frombuffer(raw, CHECKPOINT), lanes
        self.table = Table.frombytes(source.read_at(8 * n + 4, HEADER.size), n, scale)

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray, list[int | None]]:
        """(ids, places of the documents that start here, their ids) of one block, decoded alone."""
        mark = self.index[k]
        raw = self.source.read_at(int(mark["size"]), int(mark["offset"]))
        if zlib.crc32(raw) != mark["crc"]:
            raise ValueError(f"block {k} is damaged")
        n = int(mark["n_docs"])
        nulls = np.frombuffer(raw, "u1", n, 12 * n)
        states, words = np.frombuffer(raw, "<u8", self.lanes, 13 * n), np.frombuffer(raw, "<u4", offset=13 * n + 8 * self.lanes)
        ids = self.table.decode(states, words, int(mark["n_ids"]))
        if zlib.crc32(ids.astype("<u4").tobytes()) != mark["ids_crc"]:
            raise ValueError(f"block {k} decodes to other ids")
        doc_ids = [None if z else d for z, d in zip(nulls, np.frombuffer(raw, "<i8", n, 4 * n).tolist())]
        return ids, np.frombuffer(raw, "<u4", n).astype(np.int64), doc_ids


def write_token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                      end: int = END, block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the documents below ``folder``; returns (part, seq, file, n_ids, n_blocks), stored: files ascend by (part, seq)."""
    tokenizer = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, (fs, path) = _encoder(tokenizer), TaskContext.get(), file_system(folder)
        fs.create_dir(path, recursive=True)
        parts, doc_ids, starts, total, seq = [], [], [], 0, 0
        stop = np.array([end], "<u4")

        def flush() -> pa.RecordBatch:
            name = f"ids-{task.partitionId():06d}-{seq:04d}-{task.taskAttemptId()}.rans"
            with fs.open_output_stream(f"{path}/{name}") as out:
                blocks = write_file(out, np.concatenate(parts), doc_ids, np.array(starts), block_ids)
            return pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "seq": pa.array([seq], pa.int32()),
                                               "file": [name], "n_ids": [total], "n_blocks": [blocks]})

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encoder.ids(text.as_py())
                starts.append(total)
                doc_ids.append(doc_id)
                parts += [ids, stop]
                total += len(ids) + 1
                if total >= file_ids:
                    yield flush()
                    parts, doc_ids, starts, total, seq = [], [], [], 0, seq + 1
        if starts:
            yield flush()

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return saved(rows.mapInArrow(run, "part int, seq int, file string, n_ids long, n_blocks long"), "rans-manifest")


def _combined(crc: int, n: int, more: int) -> int:
    """CRC-32 of A + B of the CRCs of A and of B with ``n`` bytes: A's is multiplied by x^(8n)."""
    def times(a: int, b: int) -> int:  # of polynomials with reflected bits, modulo the CRC's
        out = 0
        for k in range(31, -1, -1):
            if a >> k & 1:
                out ^= b
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        return out
    power, square = 1 << 31, 1 << 23  # x^0 and x^8
    while n:
        if n & 1:
            power = times(power, square)
        square, n = times(square, square), n >> 1
    return times(power, crc) ^ more


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``write_token_files``, decoded block by block."""
    pieces_schema = "file string, doc_no long, doc_id long, whole boolean, at long, n long, crc long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, path), name, now = file_system(folder), None, None
        for b in batches:
            for file, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if file != name:
                    info = fs.get_file_info(f"{path}/{file}")
                    name, now = file, File(fs.open_input_file(info.path), info.size)
                ids, starts, doc_ids = now.block(block)
                mark = now.index[block]
                before, raw = int(mark["docs_before"]), memoryview(ids.astype("<u4").tobytes())
                cuts = starts.tolist()
                numbers = list(range(before, before + len(cuts)))
                inherits = not cuts or cuts[0] > 0  # the block begins inside a document
                if inherits:
                    cuts, numbers, doc_ids = [0, *cuts], [before - 1, *numbers], [None, *doc_ids]
                ends = [*cuts[1:], len(ids)]
                whole = [True] * len(cuts)
                whole[0], whole[-1] = not inherits, whole[-1] and not mark["open"]
                if inherits and len(cuts) == 1:
                    whole[0] = False
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(cuts), pa.string()), pa.array(numbers, pa.int64()), pa.array(doc_ids, pa.int64()),
                     pa.array([bool(w) for w in whole], pa.bool_()), pa.array([int(mark["ids_before"]) + c for c in cuts], pa.int64()),
                     pa.array([e - c for c, e in zip(cuts, ends)], pa.int64()),
                     pa.array([zlib.crc32(raw[4 * c:4 * e]) for c, e in zip(cuts, ends)], pa.int64())],
                    names=["file", "doc_no", "doc_id", "whole", "at", "n", "crc"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crcs = []
            for sizes, parts in zip(b.column(4).to_pylist(), b.column(5).to_pylist()):
                crc = 0
                for n, more in zip(sizes, parts):
                    crc = _combined(crc, 4 * n, more)
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(crcs, pa.int64())], names=["file", "doc_id", "at", "n", "crc"])

    files = manifest.select("file", "n_ids", F.coalesce(F.sum("n_ids").over(  # one row a file
        Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    blocks = manifest.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"))
    shuffles = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(shuffles, manifest.agg(F.sum("n_blocks")).first()[0] or 0))
    pieces = saved(blocks.repartition(tasks, "file", "block").sortWithinPartitions("file", "block").mapInArrow(run, pieces_schema), "rans-pieces")
    inner = ["file", "doc_id", "at", "n", "crc"]
    broken = pieces.where("not whole").groupBy("file", "doc_no").agg(  # a piece a block
        F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("parts"))
    broken = broken.select("file", "doc_id", F.element_at("parts", 1)["at"].alias("at"), F.aggregate(
        "parts", F.lit(0).cast("long"), lambda n, p: n + p["n"]).alias("n"), F.col("parts.n").alias("sizes"), F.col("parts.crc").alias("crcs"))
    joined = broken.mapInArrow(join, "file string, doc_id long, at long, n long, crc long")
    docs = pieces.where("whole").select(*inner).unionByName(joined).join(files.select("file", "before"), "file")
    return docs.select("doc_id", (F.col("before") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def roundtrip(docs: DataFrame, folder: str, **options) -> DataFrame:
    return read_token_files(write_token_files(docs, folder, **options), folder)
