"""Benchmark decontamination by pigeonhole edit matching.

A document is contaminated by a test item when some substring of it is
within the item's error budget: ``floor(error_rate * characters)`` edits
(insertions, deletions, substitutions). Both texts are lower-cased and runs
of white space are one space.

* Each item is split into budget + 1 pieces. If the whole matches with at
  most budget errors, at least one piece matches exactly, so every match has
  a piece hit. One Aho-Corasick pass over the whole text finds all hits.
* Hits are verified bottom-up over the halving tree of the pieces: a node of
  m pieces may hold m - 1 errors, and on any true match there is a leaf all
  of whose ancestors stay within theirs. So a chance hit costs a few steps of
  Myers' bit-parallel search on a short pattern, and only survivors are
  verified against the whole item. Where hits of one item crowd, as in repetitive
  text, the item is searched once over the whole stretch.

The items are the bounded query set: they are taken in blocks of about
``block_chars`` characters, each block against all documents, so what is
sent to tasks has a fixed size however many items there are.

Defined cases: null or blank documents and items never match; repeated items
and repeated documents give the same rows once per (doc_id, item_id); very
long texts are searched whole; empty tables give empty results. Other columns
pass through ``decontaminated`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.1
BLOCK_CHARS = 4_000_000
MANY_HITS = 64  # of one item in overlapping places; beyond that they are searched together


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def myers(pattern: str, text: str) -> int:
    """Least edits between the pattern and any substring of the text."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << m - 1
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = at.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best = score
        ph, mh = ph << 1, mh << 1
        pv, mv = (mh | ~(xv | ph)) & full, ph & xv
    return best


class Item:
    """A test item, its pieces and each piece's chain of enclosing nodes."""

    def __init__(self, item_id, text: str, error_rate: float):
        self.item_id, self.text, n = item_id, text, len(text)
        self.budget = min(int(error_rate * n), n - 1)
        self.cuts = [i * n // (self.budget + 1) for i in range(self.budget + 2)]
        self.above: list[list[tuple[int, int, int]]] = [[] for _ in range(self.budget + 1)]
        nodes = [(0, self.budget + 1)]
        while nodes:  # parents come before children, so each chain is built from the root down
            a, b = nodes.pop()
            for leaf in range(a, b):
                self.above[leaf].append((self.cuts[a], self.cuts[b], b - a - 1))
            if b - a > 2:
                nodes += [(a, (a + b) // 2), ((a + b) // 2, b)]
        for chain in self.above:
            chain.reverse()

    def piece(self, leaf: int) -> str:
        return self.text[self.cuts[leaf]:self.cuts[leaf + 1]]

    def errors(self, leaf: int, text: str, at: int) -> int | None:
        """Least edits of the whole item around a piece hit that starts at ``at``, if within budget."""
        start, found = self.cuts[leaf], None
        for a, b, budget in self.above[leaf]:
            window = text[max(0, at - (start - a) - budget):at + (b - start) + budget]
            found = 0 if self.text[a:b] in window else myers(self.text[a:b], window)
            if found > budget:
                return None
        return found


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, rows: list[tuple], error_rate: float):
        import ahocorasick
        texts = ((i, normal(t)) for i, t in rows if t is not None)
        self.items = [Item(i, t, error_rate) for i, t in texts if t]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for k, item in enumerate(self.items):
            for leaf in range(item.budget + 1):
                pieces.setdefault(item.piece(leaf), []).append((k, leaf))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if pieces:
            self.automaton.make_automaton()
        self.usable = bool(pieces)

    def found(self, text: str | None, first: bool = False) -> dict[int, int]:
        """Item index -> least edits, over all places; ``first``: stop at the first match."""
        out: dict[int, int] = {}
        if not self.usable or not text:
            return out
        text = normal(text)
        near: dict[int, Stretch] = {}  # per item the hits whose surroundings overlap, the latest ones
        for end, (length, owners) in self.automaton.iter(text):
            at = end - length + 1
            for k, leaf in owners:
                item = self.items[k]
                if out.get(k) == 0:
                    continue
                low = max(0, at - item.cuts[leaf] - item.budget)
                high = at - item.cuts[leaf] + len(item.text) + item.budget
                if k in near and low > near[k].high:
                    near.pop(k).settle(item, text, k, out)
                    if first and out:
                        return out
                near.setdefault(k, Stretch(low, high)).add(low, high, at, leaf)
        for k, stretch in near.items():
            stretch.settle(self.items[k], text, k, out)
            if first and out:
                break
        return out


class Stretch:
    """Piece hits of one item whose surroundings overlap.

    A few hits are verified one by one. In repetitive text, where hits are many,
    the whole stretch is searched once instead, so its time grows with its length.
    """

    def __init__(self, low: int, high: int):
        self.low, self.high, self.hits = low, high, []

    def add(self, low: int, high: int, at: int, leaf: int) -> None:
        self.low, self.high = min(self.low, low), max(self.high, high)
        if len(self.hits) <= MANY_HITS:
            self.hits.append((at, leaf))

    def settle(self, item: Item, text: str, k: int, out: dict[int, int]) -> None:
        """Puts the least edits of the item in the stretch to ``out``, if within budget."""
        if len(self.hits) > MANY_HITS:
            window = text[self.low:self.high]
            errors = 0 if item.text in window else myers(item.text, window)
            if errors <= item.budget:
                out[k] = min(errors, out.get(k, errors))
            return
        tried = set()
        for at, leaf in self.hits:
            if (diagonal := at - item.cuts[leaf]) in tried:
                continue
            errors = item.errors(leaf, text, at)
            if errors is not None:
                tried.add(diagonal)
                out[k] = min(errors, out.get(k, errors))
                if errors == 0:
                    return


def _blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_chars`` characters, each small enough to send to tasks."""
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")) \
        .where("t is not null").distinct()
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-chars // block_chars)
    for block in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == block).collect()]


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", error_rate: float = ERROR_RATE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, errors, budget), one row per matching pair; errors is the least over all places."""
    schema = "doc_id long, item_id long, errors int, budget int"
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = []
    for rows in _blocks(items, item_id_col, item_text_col, block_chars):
        def run(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(rows, error_rate)
            for b in batches:
                got = [(b.column(0)[n].as_py(), matcher.items[k].item_id, errors, matcher.items[k].budget)
                       for n, t in enumerate(b.column(1)) for k, errors in matcher.found(t.as_py()).items()]
                cols = list(zip(*got)) if got else [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                                                 names=["doc_id", "item_id", "errors", "budget"])
        parts.append(source.mapInArrow(run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("doc_id", "item_id").agg(F.min("errors").alias("errors"), F.max("budget").alias("budget"))


def decontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                   item_text_col: str = "text", error_rate: float = ERROR_RATE,
                   block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that match no item, with all their columns; no join is needed to drop the others."""
    where = docs.columns.index(text_col)
    out = docs
    for rows in _blocks(items, item_id_col, item_text_col, block_chars):
        def run(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(rows, error_rate)
            for b in batches:
                yield b.filter(pa.array([not matcher.found(t.as_py(), first=True) for t in b.column(where)], pa.bool_()))
        out = out.mapInArrow(run, docs.schema)
    return out
