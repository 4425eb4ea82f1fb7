"""Language identification of mixed-language text.

1. Letters are classed by script ranges; a word's script leaves only the
   languages that used that script in training as candidates.
2. Each word gets, per candidate, the log likelihood of its letter trigrams
   (hashed to ``BUCKETS``, word ends included) under that language.
3. Viterbi over the words of the text, with a penalty for each switch of
   language, labels spans; the document's language has the most letters.

The model is one table of trigram counts per language, summed over all
training rows by Spark; its size is bounded by languages x buckets, and more
than ``MAX_LANGUAGES`` labels are an error. Prediction reads the text only.

Defined cases: null text or text without a letter is ``und`` with score 0;
letters of a script no language was trained on leave all languages as
candidates; ties go to the language that sorts first; with no training row
every text is ``und``; very long texts are scored in pieces cut at white space and
labelled whole; repeated rows give
repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS, MAX_LANGUAGES = 1 << 16, 512
SWITCH_PENALTY, SMOOTHING, SCRIPT_SHARE = 8.0, 0.5, 0.01
UNKNOWN = "und"
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                  T.StructField("lang", T.StringType())]))
_PART_CHARS, _GROUP_CHARS = 250_000, 1_000_000  # memory of a task: characters scored, then labelled, at a time
_GAP = re.compile(r"\s")  # no word holds white space, so a text may be cut there

# Unicode script ranges (first code point, last code point, script).
SCRIPT_RANGES = (
    (0x0041, 0x024F, "Latin"), (0x0250, 0x02AF, "Latin"), (0x0370, 0x03FF, "Greek"), (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"), (0x0590, 0x05FF, "Hebrew"), (0x0600, 0x06FF, "Arabic"), (0x0700, 0x074F, "Syriac"),
    (0x0750, 0x077F, "Arabic"), (0x0780, 0x07BF, "Thaana"), (0x08A0, 0x08FF, "Arabic"), (0x0900, 0x097F, "Devanagari"),
    (0x0980, 0x09FF, "Bengali"), (0x0A00, 0x0A7F, "Gurmukhi"), (0x0A80, 0x0AFF, "Gujarati"), (0x0B00, 0x0B7F, "Oriya"),
    (0x0B80, 0x0BFF, "Tamil"), (0x0C00, 0x0C7F, "Telugu"), (0x0C80, 0x0CFF, "Kannada"), (0x0D00, 0x0D7F, "Malayalam"),
    (0x0D80, 0x0DFF, "Sinhala"), (0x0E00, 0x0E7F, "Thai"), (0x0E80, 0x0EFF, "Lao"), (0x0F00, 0x0FFF, "Tibetan"),
    (0x1000, 0x109F, "Myanmar"), (0x10A0, 0x10FF, "Georgian"), (0x1100, 0x11FF, "Hangul"), (0x1200, 0x139F, "Ethiopic"),
    (0x13A0, 0x13FF, "Cherokee"), (0x1780, 0x17FF, "Khmer"), (0x1800, 0x18AF, "Mongolian"), (0x1E00, 0x1EFF, "Latin"),
    (0x1F00, 0x1FFF, "Greek"), (0x3040, 0x309F, "Hiragana"), (0x30A0, 0x30FF, "Katakana"), (0x3130, 0x318F, "Hangul"),
    (0x31F0, 0x31FF, "Katakana"), (0x3400, 0x4DBF, "Han"), (0x4E00, 0x9FFF, "Han"), (0xA640, 0xA69F, "Cyrillic"),
    (0xAC00, 0xD7AF, "Hangul"), (0xF900, 0xFAFF, "Han"), (0xFB50, 0xFDFF, "Arabic"), (0xFE70, 0xFEFF, "Arabic"),
    (0x20000, 0x2FA1F, "Han"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, _, name in SCRIPT_RANGES)) + ("Other",)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: lower case; 1 letter, 2 mark, 0 neither; index in SCRIPTS."""
    lower, kind = np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, np.uint8)
    script = np.full(0x110000, len(SCRIPTS) - 1, np.uint8)
    for cp in range(0x110000):
        c = unicodedata.category(ch := chr(cp))[0]
        if c == "L":
            kind[cp] = 1
            if len(low := ch.lower()) == 1:
                lower[cp] = ord(low)
        elif c == "M":
            kind[cp] = 2
    for first, last, name in SCRIPT_RANGES:
        script[first:last + 1] = SCRIPTS.index(name)
    return lower, kind, script


class Words:
    """Words of a list of texts, as arrays: document, first character, end, script, and the trigrams inside."""

    def __init__(self, texts: list[str]):
        lower, kind, script = _tables()
        raw = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
        k = kind[raw]
        inside = k > 0
        edge = np.diff(inside.astype(np.int8))
        first, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        # a run of marks alone is not a word
        letters = np.add.reduceat(k == 1, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
        if len(first):  # reduceat runs to the next start: only letters of this word lie there
            real = letters > 0
            for a, b in zip(first[~real], end[~real]):
                inside[a:b] = False
            first, end, letters = first[real], end[real], letters[real]
        c = np.where(inside, lower[raw], np.uint32(32))
        here = np.flatnonzero(inside)
        mixed = c[here - 1] * np.uint32(0x9E3779B1) ^ c[here] * np.uint32(0x85EBCA6B) ^ c[here + 1] * np.uint32(0xC2B2AE35)
        mixed ^= mixed >> np.uint32(15)
        self.trigrams = (mixed * np.uint32(0x2C1B3C6D) >> np.uint32(16)).astype(np.intp)
        size = end - first
        self.offsets = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.intp) if len(size) else np.zeros(0, np.intp)
        self.letters, self.script = letters, script[raw[first]] if len(first) else np.zeros(0, np.uint8)
        starts = 1 + np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))  # texts in ``raw``
        self.doc = np.searchsorted(starts, first, "right") - 1
        self.first, self.end = first - starts[self.doc], end - starts[self.doc]
        self.char_script, self.is_letter = script[raw], k == 1
        self.trigram_doc = np.repeat(self.doc, size)


class Model:
    """Log likelihoods of trigrams per language, and each script's candidates."""

    def __init__(self, langs: list[str], grams: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        total = grams.sum(axis=1, keepdims=True)
        self.table = np.ascontiguousarray(np.log((grams + SMOOTHING) / (total + SMOOTHING * BUCKETS)).T, dtype=np.float32)
        share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
        used = (share >= SCRIPT_SHARE).T  # script x language
        self.candidates = used | ~used.any(axis=1, keepdims=True)

    def scores(self, words: Words) -> np.ndarray:
        """words x languages: log likelihood less the best candidate's; excluded languages are far below."""
        out = np.empty((len(words.doc), len(self.langs)), np.float32)
        for n in range(len(self.langs)):
            out[:, n] = np.add.reduceat(self.table[:, n][words.trigrams], words.offsets) if len(words.doc) else 0
        out[~self.candidates[words.script]] = -1e6
        return out - out.max(axis=1, keepdims=True)


def viterbi(scores: np.ndarray, starts: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word; each text's words are ``scores[start:start + count]``. Texts advance together."""
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    active = np.searchsorted(-counts, -np.arange(1, (counts[0] if len(counts) else 0) + 1), "right")
    best = np.zeros((len(starts), scores.shape[1]))
    stays = np.ones(scores.shape, bool)
    source = np.zeros(len(scores), np.int16)
    for t, a in enumerate(active):
        at, v = starts[:a] + t, best[:a]
        if t:
            source[at] = v.argmax(axis=1)
            floor = v.max(axis=1, keepdims=True) - penalty
            stays[at] = v >= floor
            v = np.maximum(v, floor)
            v -= floor
        best[:a] = v + scores[at]
    labels, now = np.zeros(len(scores), np.int16), best.argmax(axis=1).astype(np.int16)
    for t in range(len(active) - 1, -1, -1):
        at = starts[:active[t]] + t
        cur = now[:active[t]]
        labels[at] = cur
        now[:active[t]] = np.where(stays[at, cur], cur, source[at])
    return labels


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model of all rows with a text and a label; None without any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        for b in batches:
            for rows in _parts(_lengths(b.column(0)), _GROUP_CHARS):
                texts, langs = (b.column(k).slice(rows.start, len(rows)).to_pylist() for k in (0, 1))
                for part in _pieces(texts):
                    words, own = Words([t for _, _, t in part]), np.array([langs[i] for i, _, _ in part])
                    for lang in np.unique(own):
                        count = grams.setdefault(str(lang), np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                        mine = own == lang
                        count[:BUCKETS] += np.bincount(words.trigrams[mine[words.trigram_doc]], minlength=BUCKETS)
                        per = np.bincount(words.script[mine[words.doc]], words.letters[mine[words.doc]], len(SCRIPTS))
                        count[BUCKETS:] += per.astype(np.int64)
        for lang, count in grams.items():
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(count[used])],
                                             names=["lang", "feature", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where("text is not null and lang is not null")
    counts = rows.mapInArrow(run, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    per_lang = counts.groupBy("lang").agg(  # one compact row a language: positions and counts
        F.collect_list("feature").alias("features"), F.collect_list("n").alias("ns")).limit(MAX_LANGUAGES + 1).collect()
    if len(per_lang) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col}")
    per_lang.sort(key=lambda r: r.lang)
    table = np.zeros((len(per_lang), BUCKETS + len(SCRIPTS)))
    for k, r in enumerate(per_lang):
        table[k, r.features] = r.ns
    return Model([r.lang for r in per_lang], table[:, :BUCKETS], table[:, BUCKETS:]) if per_lang else None


def _parts(sizes: list[int], most: int) -> Iterator[range]:
    """Consecutive positions with about ``most`` characters together."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > most:
            yield range(at, i)
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield range(at, len(sizes))


def _lengths(texts: pa.Array) -> list[int]:
    return pc.fill_null(pc.utf8_length(texts), 0).to_pylist()


def _pieces(texts: list[str | None]) -> Iterator[list[tuple[int, int, str]]]:
    """Lists of (position, first character, piece) of about ``_PART_CHARS`` characters; long texts are cut between words."""
    part, size = [], 0
    for i, text in enumerate(texts):
        at, text = 0, text or ""
        while True:
            gap = _GAP.search(text, at + _PART_CHARS) if len(text) - at > _PART_CHARS else None
            end = gap.end() if gap else len(text)
            if part and size + end - at > _PART_CHARS:
                yield part
                part, size = [], 0
            part.append((i, at, text[at:end]))
            size, at = size + end - at, end
            if at >= len(text):
                break
    if part:
        yield part


def label(texts: list[str | None], model: Model | None, penalty: float = SWITCH_PENALTY) -> pa.Table:
    """lang_pred, score and spans (start, end, lang; in characters) of each text."""
    n = len(texts)
    langs = np.array([*(model.langs if model else []), UNKNOWN], object)
    pred, score = np.full(n, len(langs) - 1), np.zeros(n)
    spans = [np.zeros(0, np.int64) for _ in range(4)]  # text, start, end, language
    sizes = [len(t or "") for t in texts]
    for group in _parts(sizes, _GROUP_CHARS) if model else ():
        found = []
        for part in _pieces([texts[i] for i in group]):
            words, (own, offset, pieces) = Words([t for _, _, t in part]), zip(*part)
            shift = np.array(offset)[words.doc]
            found.append((np.array(own)[words.doc], words.first + shift, words.end + shift, words.letters, model.scores(words)))
        doc, first, end, letters, scores = (np.concatenate(x) for x in zip(*found))
        counts = np.bincount(doc, minlength=len(group))
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        labels = viterbi(scores, starts, counts, penalty)
        votes = np.bincount(doc * len(model.langs) + labels, letters, len(group) * len(model.langs)).reshape(len(group), -1)
        total = votes.sum(axis=1)
        known = np.flatnonzero(total > 0)
        pred[group[0] + known] = votes[known].argmax(axis=1)
        score[group[0] + known] = votes[known].max(axis=1) / total[known]
        new = np.concatenate(([True], (np.diff(labels) != 0) | (np.diff(doc) != 0))) if len(doc) else np.zeros(0, bool)
        last = np.concatenate((new[1:], [True])) if len(doc) else new
        for k, x in enumerate((doc[new] + group[0], first[new], end[last], labels[new])):
            spans[k] = np.concatenate((spans[k], x))
    ends = np.searchsorted(spans[0], np.arange(n + 1))
    items = pa.StructArray.from_arrays([pa.array(spans[1], pa.int32()), pa.array(spans[2], pa.int32()),
                                        pa.array(langs[spans[3]], pa.string())], ["start", "end", "lang"])
    return pa.table({"lang_pred": pa.array(langs[pred], pa.string()), "score": pa.array(score),
                     "spans": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)})


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", penalty: float = SWITCH_PENALTY,
            spans: bool = True) -> DataFrame:
    """All columns of ``docs`` and lang_pred, score and (``spans``) spans, which replace columns of these names."""
    added = {"lang_pred": T.StringType(), "score": T.DoubleType()} | ({"spans": SPANS} if spans else {})
    base = docs.drop(*added)
    where, shared = base.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in _parts(_lengths(b.column(where)), _GROUP_CHARS):
                some = b.slice(rows.start, len(rows))
                got = label(some.column(where).to_pylist(), shared.value, penalty)
                yield pa.RecordBatch.from_arrays([*some.columns, *[got[c].combine_chunks() for c in added]],
                                                 names=[*b.schema.names, *added])

    return base.mapInArrow(run, T.StructType(base.schema.fields + [T.StructField(*x) for x in added.items()]))


def held_out(id_col: str = "doc_id"):
    """The rows a model is never trained on: a third, by CRC-32 of the id as text. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(F.crc32(F.col(id_col).cast("string")) % 3 != 1)
