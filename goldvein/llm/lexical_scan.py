"""Ranked lexical search by an Aho-Corasick scan of the documents.

There is no index of the documents. The terms of all items make one
automaton, each between two guards, so that a hit is a whole term; it is sent
to the tasks and run over every text, which gives the counts of all item terms
at once. Texts are scanned twice: first for the corpus statistics (documents,
their length, document frequencies; one row a term and task), then to score.
What the automaton puts out maps to items through the postings of the terms in
the items; each task keeps its best documents of every item, in bounded
memory, and only those are shuffled, in two steps.

Items are taken in blocks of about ``BLOCK_CHARS`` characters, each against all
documents, so the automaton and postings that are sent have a fixed size
however many items there are.

Scores are sums of whole numbers. They are added as doubles, which is exact
below 2^53; where an item's score could be larger, its parts are added in two
halves.

Defined cases: null text has no terms, and neither has a text of separators;
such items find nothing and such documents are not counted; a null doc_id
counts as a document and comes last among equal scores; every row of
documents and of items counts for itself, so repeated documents are ranked one after
the other and repeated items (of one id and text) are one item; items of one id
and unlike texts are ranked apart; very long texts are scanned whole, in
stretches cut at separators; empty tables give an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

TOP = 20
BLOCK_CHARS = 2_000_000
STRETCH = 1 << 20  # characters scanned at a time
POOL = 1 << 20  # (document, item) scores held at a time
_LAST = 2 ** 63 - 1  # stands for a null doc_id in the order
_GAP = re.compile(" ")


def _plain() -> bytes:
    """Per byte: A-Z in lower case, other ASCII letters and digits and all bytes of other characters as they are, the rest a space."""
    kept = lambda b: b >= 128 or chr(b).isalnum()
    return bytes((b + 32 if 65 <= b <= 90 else b) if kept(b) else 32 for b in range(256))


_PLAIN = _plain()


def plain(text: str | None) -> str:
    """The text's terms between spaces."""
    return f" {(text or '').encode().translate(_PLAIN).decode()} "


class Searcher:
    """The items of one block: automaton of their terms and the postings of the terms."""

    def __init__(self, rows: list[tuple]):
        counts = [Counter(plain(t).split()) for _, _, t in rows]
        self.items = [n for n, _, _ in rows]
        self.terms = sorted(set().union(*counts)) if counts else []
        number = {t: k for k, t in enumerate(self.terms)}
        entries = sorted((number[t], i, c) for i, own in enumerate(counts) for t, c in own.items())
        self.first = np.searchsorted([e[0] for e in entries], np.arange(len(self.terms) + 1))
        self.of, self.times = (np.array([e[k] for e in entries], np.int64) for k in (1, 2))
        self.most_terms = max((sum(c.values()) for c in counts), default=0)

    def automaton(self):
        import ahocorasick
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, t in enumerate(self.terms):
            found.add_word(f" {t} ", k)
        if self.terms:
            found.make_automaton()
        return found


def _counted(text: str | None, automaton) -> tuple[int, Counter]:
    """(terms of the text, how often each item term occurs)."""
    whole, at, n, found = plain(text), 0, 0, Counter()
    while at < len(whole) - 1:
        gap = _GAP.search(whole, at + STRETCH) if len(whole) - at > STRETCH else None
        part = whole[at:gap.end() if gap else len(whole)]
        n += len(part.split())
        if len(automaton):
            found.update(map(itemgetter(1), automaton.iter(part)))
        at += len(part) - 1  # the space at the end begins the next stretch, too
    return n, found


def statistics(docs: DataFrame, searcher: Searcher, text_col: str = "text") -> tuple[int, int, np.ndarray]:
    """(documents with a term, all their terms, document frequency of every item term)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, held = searcher.automaton(), Counter()
        for b in batches:
            for text in b.column(0):
                n, found = _counted(text.as_py(), automaton)
                if n:
                    held.update(found.keys())
                    held.update({-1: 1, -2: n})
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.int64())], names=["term", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "term int, n long")
    counts = {r.term: r.n for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # one row an item term
    return counts.get(-1, 0), counts.get(-2, 0), np.array([counts.get(k, 0) for k in range(len(searcher.terms))], np.int64)


class _Best:
    """The best documents of each item among the scores offered, ties to smaller ids."""

    def __init__(self, items: int, top: int):
        self.top, self.floor = top, np.zeros(items, np.int64)
        self.held = [np.zeros(0, np.int64)] * 3  # item, score, id
        self.new: list[tuple] = []
        self.size = 0

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: document x item."""
        doc, item = np.nonzero((scores > 0) & (scores >= self.floor))
        self.new.append((item, scores[doc, item], ids[doc]))
        self.size += len(item)
        if self.size > 4 * self.top * len(self.floor) + POOL:
            self.settle()

    def settle(self) -> None:
        item, score, ids = (np.concatenate([h, *x]) for h, x in zip(self.held, zip(*self.new))) if self.new else self.held
        order = np.lexsort((ids, -score, item))
        item, score, ids = item[order], score[order], ids[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        some = rank < self.top
        self.held, self.new, self.size = [item[some], score[some], ids[some]], [], 0
        last = some & (rank == self.top - 1)
        self.floor[item[last]] = score[last]


def _scores(searcher: Searcher, weights: np.ndarray, n: np.ndarray, tfs: list[Counter], docs: int, terms: int) -> np.ndarray:
    """Scores of some documents, document x item."""
    size = [len(c) for c in tfs]
    of = np.repeat(np.arange(len(tfs)), size)
    term = np.fromiter((t for c in tfs for t in c), np.int64, len(of))
    tf = np.fromiter((k for c in tfs for k in c.values()), np.int64, len(of))
    m = 75 + 25 * n * docs // max(1, terms)
    part = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[of]))
    first, count = searcher.first[term], np.diff(searcher.first)[term]
    at = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    cell = np.repeat(of, count) * len(searcher.items) + searcher.of[at]
    value, cells = np.repeat(part, count) * searcher.times[at], len(tfs) * len(searcher.items)
    if searcher.most_terms * int(part.max(initial=0)) < 1 << 53:
        out = np.bincount(cell, value, cells).astype(np.int64)
    else:
        out = (np.bincount(cell, value >> 24, cells).astype(np.int64) << 24) + np.bincount(cell, value & 0xFFFFFF, cells).astype(np.int64)
    return out.reshape(len(tfs), -1)


def best_in_tasks(docs: DataFrame, searcher: Searcher, weights: np.ndarray, n_docs: int, n_terms: int, top: int = TOP,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(item, doc_id, score): each task's best documents of every item; a null doc_id is the largest long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, best = searcher.automaton(), _Best(len(searcher.items), top)
        at_once = max(1, POOL // max(1, len(searcher.of)))
        for b in batches:
            for a in range(0, b.num_rows, at_once):
                some = b.slice(a, at_once)
                counted = [_counted(t.as_py(), automaton) for t in some.column(1)]
                scores = _scores(searcher, weights, np.array([n for n, _ in counted], np.int64), [c for _, c in counted], n_docs, n_terms)
                best.offer(scores, some.column(0).to_numpy(zero_copy_only=False))
        best.settle()
        item, score, ids = best.held
        numbers = np.array(searcher.items, np.int64)[item] if len(item) else item
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(ids), pa.array(score)], names=["item", "doc_id", "score"])

    known = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    return docs.select(known.alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "item long, doc_id long, score long")


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): of each item the ``top`` documents with the highest score above 0."""
    spark = docs.sparkSession
    rows = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")) \
        .where("text is not null").distinct()
    rows = saved(rows.withColumn("item", F.xxhash64("item_id", "text")), "lexical-items")
    blocks = -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars)
    parts = []
    for block in range(blocks):
        mine = rows.where(F.pmod("item", F.lit(blocks)) == block).select("item", "item_id", "text")
        searcher = Searcher([tuple(r) for r in mine.collect()])  # a block of bounded size
        n_docs, n_terms, df = statistics(docs, searcher, text_col)
        parts.append(saved(best_in_tasks(docs, searcher, term_weights(n_docs, df), n_docs, n_terms, top, id_col, text_col), "lexical-best"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = [F.col("score").desc(), F.col("doc_id")]
    near = found.withColumn("_some", F.pmod(F.xxhash64("doc_id", "score"), F.lit(64)))  # first within slices of an item's rows
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("item", "_some").orderBy(*order))).where(F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    names = rows.select("item", "item_id")
    return best.join(names, "item").select("item_id", "rank", F.when(F.col("doc_id") != _LAST, F.col("doc_id")).alias("doc_id"), "score")
