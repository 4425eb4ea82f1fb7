"""SimHash near-duplicate detection with a hierarchical index in Gray order.

Fingerprints of whole texts are 64 majority bits over the XXH64 hashes of
their 4-word shingles. Two fingerprints are linked when at most ``max_bits``
bits differ; documents reachable over links form a component.

How links are found without comparing all pairs:

1. Equal fingerprints are one node (a hot group of copies is one row from here on).
2. Upper nodes of the index are shared masked bit patterns. The 64 bits are
   cut into ``max_bits + 1`` segments; two codes within ``max_bits`` agree on
   at least one whole segment, so a code enters one node per segment. A node
   that holds more than ``node_limit`` codes is cut again over the bits its
   pattern leaves free (at most ``MAX_DEPTH`` times), and what is still too
   large is compared in blocks.
3. In a node, codes are sorted by Gray rank, so neighbours share long bit
   patterns. Every 16 neighbours get a parent whose pattern is the bits all
   of them share, and so on up to a root. A search carries the differences
   accumulated on the patterns above and drops a whole group as soon as they
   exceed ``max_bits``.
4. A node returns a forest (each code with the smallest code of its local
   group), never all pairs, and the forests are joined up by ``components``.

Defined cases: null or wordless text has fingerprint zero and is linked like
any other; fewer than 4 words form one shingle; repeated rows of one doc_id
are kept, one output row each; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, saved

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
NODE_LIMIT, MAX_DEPTH, FANOUT = 16_384, 3, 16
_CHUNK = 100_000  # shingles hashed at a time: bounds a task's memory on very long texts


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text."""
    import xxhash
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle_words + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(shingle_words, len(words)) - 1:] - 1).tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _CHUNK], stops[at:at + _CHUNK])])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS, extra: str | None = None) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; with ``extra`` also that long column, as ``extra``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle_words) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]],
                                             names=["doc_id", "fp", *b.schema.names[2:]])

    more = [F.col(extra).cast("long").alias("extra")] if extra else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)
    return rows.mapInArrow(run, "doc_id long, fp long" + (", extra long" if extra else ""))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order: the inverse of r ^ (r >> 1)."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, leaves first: (shared bits, mask of the bits shared) of each node."""
    every, some = codes, codes
    out = [(codes, np.full(len(codes), ~np.uint64(0)))]
    while len(every) > 1:
        cuts = np.arange(0, len(every), FANOUT)
        every, some = np.bitwise_and.reduceat(every, cuts), np.bitwise_or.reduceat(some, cuts)
        out.append((every, ~(every ^ some)))
    return out


def neighbours(queries: np.ndarray, codes: np.ndarray, max_bits: int,
               levels: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All (query index, code index) with at most ``max_bits`` differing bits; codes in Gray order."""
    levels = levels or _levels(codes)
    shared, mask = levels[-1]
    q = np.repeat(np.arange(len(queries)), len(shared))
    node = np.tile(np.arange(len(shared)), len(queries))
    acc = np.bitwise_count((queries[q] ^ shared[node]) & mask[node])
    seen = mask[node]
    for depth in range(len(levels) - 1, -1, -1):
        if depth < len(levels) - 1:
            shared, mask = levels[depth]
            first = node * FANOUT
            width = np.minimum(FANOUT, len(shared) - first)
            rep = np.repeat(np.arange(len(node)), width)
            node = np.repeat(first - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(len(rep))
            q, new = q[rep], mask[node] & ~seen[rep]
            acc = acc[rep] + np.bitwise_count((queries[q] ^ shared[node]) & new)
            seen = mask[node]
        keep = acc <= max_bits
        q, node, acc, seen = q[keep], node[keep], acc[keep], seen[keep]
    return q, node


def local_roots(codes: np.ndarray, max_bits: int, step: int = 512) -> np.ndarray:
    """For distinct codes: index of the first code of each one's local component (codes in Gray order)."""
    levels, parent = _levels(codes), np.arange(len(codes))

    def flat(p: np.ndarray) -> np.ndarray:
        while not np.array_equal(p, up := p[p]):
            p = up
        return p

    for at in range(0, len(codes), step):
        q, hit = neighbours(codes[at:at + step], codes, max_bits, levels)
        q, keep = q + at, q + at > hit
        q, hit = q[keep], hit[keep]
        while len(q):
            parent = flat(parent)
            a, b = parent[q], parent[hit]
            open_ = a != b
            q, hit, a, b = q[open_], hit[open_], a[open_], b[open_]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    return flat(parent)


def _segments(free: int, parts: int) -> list[int]:
    """``parts`` masks that split the free bits evenly, most significant first."""
    bits = [b for b in range(63, -1, -1) if free >> b & 1]
    return [sum(1 << b for b in bits[i * len(bits) // parts:(i + 1) * len(bits) // parts]) for i in range(parts)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _children(nodes: DataFrame, masks: list[int], max_bits: int) -> DataFrame:
    """Each code once per segment of the bits its node's mask (one of ``masks``) leaves free."""
    def pairs(mask: int):
        segments = _segments(~mask & (1 << 64) - 1, max_bits + 1)
        return F.array(*[F.lit(_signed(mask | s)) for s in segments])

    grown = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), pairs(m))])
    return (nodes.select("fp", F.explode(grown[F.col("mask")]).alias("mask"))
            .withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask"))))


def links(codes: DataFrame, max_bits: int = MAX_BITS, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(a, b): a forest of links between distinct codes; column ``fp`` holds each code once."""
    nodes, masks, forests = codes.select("fp", F.lit(0).cast("long").alias("mask")), [0], []
    for depth in range(MAX_DEPTH):
        nodes = _children(nodes, masks, max_bits)
        masks = sorted({m | s for m in masks for s in _segments(~m & (1 << 64) - 1, max_bits + 1)})
        sizes = nodes.groupBy("mask", "pattern").agg(F.count("*").alias("n"))
        large = saved(sizes.where(F.col("n") > node_limit), "large-nodes")
        if large.isEmpty():
            forests.append(_forest(nodes.withColumn("block", F.lit(0).cast("long")), max_bits))
            nodes = None
            break
        forests.append(_forest(nodes.join(large, ["mask", "pattern"], "left_anti")
                               .withColumn("block", F.lit(0).cast("long")), max_bits))
        nodes = saved(nodes.join(large, ["mask", "pattern"], "left_semi"), "deeper")
    if nodes is not None:  # patterns that stay crowded: blocks of codes against blocks of codes
        forests.append(_forest(_block_pairs(nodes, large, node_limit), max_bits))
    out = forests[0]
    for more in forests[1:]:
        out = out.unionByName(more)
    return out


def _block_pairs(nodes: DataFrame, large: DataFrame, node_limit: int) -> DataFrame:
    """Codes of a crowded node dealt into halves of ``node_limit``; each pair of halves meets once."""
    parts = F.ceil(2 * F.col("n") / node_limit)
    dealt = nodes.join(large, ["mask", "pattern"]).withColumn("parts", parts) \
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    return dealt.withColumn("other", other).select(
        "fp", "mask", "pattern", (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).alias("block"))


def _forest(nodes: DataFrame, max_bits: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        codes = np.unique(table.column("fp").to_numpy().view(np.uint64))
        codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        roots = local_roots(codes, max_bits)
        own = roots != np.arange(len(codes))
        return pa.table({"a": codes[own].view(np.int64), "b": codes[roots[own]].view(np.int64)})

    # one code alone has no link: such nodes never reach Python
    alone = nodes.groupBy("mask", "pattern", "block").agg(F.count("*").alias("k")).where("k > 1").drop("k")
    return (nodes.join(alone, ["mask", "pattern", "block"], "left_semi")
            .groupBy("mask", "pattern", "block").applyInArrow(run, "a long, b long"))


def _grouped(prints: DataFrame, max_bits: int, node_limit: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint: root names the component, component_id is its smallest doc_id."""
    classes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    tree = components(links(classes.select("fp"), max_bits, node_limit), "a", "b")
    rooted = classes.join(tree.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return saved(rooted.join(least, "root").select("fp", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    node_limit: int = NODE_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links."""
    prints = saved(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    return prints.join(_grouped(prints, max_bits, node_limit), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
             node_limit: int = NODE_LIMIT) -> DataFrame:
    """Documents without near duplicates: of each component one row stays, of the smallest doc_id.

    Rows are told apart by all their columns, so unlike texts under one doc_id
    stay, each for its own component; of several rows that hold a component's smallest
    doc_id the one with the smallest hash stays. Rows with a null doc_id are
    never dropped as copies of another document. Columns are those of ``docs``.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    known = docs.where(F.col("doc_id").isNotNull()).withColumn("_keep_row", row)
    prints = saved(fingerprints(known, shingle_words=shingle_words, extra="_keep_row"), "fingerprints")
    first = prints.join(_grouped(prints, max_bits, node_limit), "fp").where("doc_id = component_id") \
        .groupBy("root").agg(F.min(F.struct("doc_id", "extra")).alias("f"))
    keep = first.select(F.col("f.doc_id").alias("_keep_id"), F.col("f.extra").alias("_keep_hash"))
    once = known.join(keep, (F.col("doc_id") == F.col("_keep_id")) & (F.col("_keep_row") == F.col("_keep_hash")), "left_semi")
    once = once.dropDuplicates(["doc_id", "_keep_row"]).select(*docs.columns)
    return once.unionByName(docs.where(F.col("doc_id").isNull()))
