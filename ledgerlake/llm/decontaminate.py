"""Benchmark decontamination: BM25 with block-max pruning, then a check.

The benchmark's items, cut into units of at most ``UNIT_WORDS`` words, are the
indexed collection; each passage of a text (a window of ``2 * STRIDE`` words,
one every ``STRIDE``) is a query of its distinct words. Scores are BM25 sums
over a unit's words, divided by the sum over all its words, so one threshold
suits all units: every unit at or above ``THRESHOLD`` is retrieved.

Block-max WAND, a batch of passages at a time: the postings of a term are cut
into blocks of units that carry the largest impact in the block. Terms whose
largest impacts add up to less than ``SLACK`` cannot bring a unit up to the
threshold; the other terms' postings give the pivots. (passage, block) pairs
whose block maxima plus ``SLACK`` stay below the threshold are skipped; units
of the remaining blocks are scored in full. The bounds are upper bounds, so
nothing at or above the threshold is lost.

A retrieved item counts as leaked if the text holds at least
``QUESTION_OVERLAP`` of the question's five-word shingles and
``ANSWER_OVERLAP`` of the answer's two-word shingles. (An item is one text:
its last sentence is the answer; of a single sentence, the last quarter.) An
answer of fewer than ``SHORT_ANSWER`` words says little by itself: such an item
is also leaked if the text holds ``ITEM_OVERLAP`` of the five-word shingles of
question and answer together.

The index is broadcast in shards of at most ``SHARD_ITEMS`` items, so its size
is bounded; texts are scanned once a shard. Words are maximal runs outside
``[\\x20\\x09-\\x0D]``, A-Z lower-cased, without the punctuation and symbols
(Unicode P and S) at both ends; runs of these alone are no words. Null and empty texts hold nothing, an
empty benchmark leaks nowhere; items without words are never found. Repeated
rows and repeated items are reported each on their own.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ARROW, bounded_batches, stored

UNIT_WORDS = 64
STRIDE = 64
THRESHOLD = 0.5
SLACK = 0.125
BLOCK_UNITS = 8
SHARD_ITEMS = 20_000
QUESTION_OVERLAP = 0.5
ANSWER_OVERLAP = 0.5
SHORT_ANSWER = 8
ITEM_OVERLAP = 0.5
#: Sums over at most so many keys are kept in a plain array.
DENSE = 4_000_000
K1, B = 1.2, 0.75
_SENTENCE = re.compile(r"(?<=[.?!])[ \t-\r]+|\n")


_SIGNS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] in "PS")
_ASCII_SIGNS = "".join(c for c in _SIGNS if c.isascii()).encode()


def _bare(run: bytes) -> bytes:
    """The run without punctuation and symbols at both ends."""
    s = run.decode()
    first, end = 0, len(s)
    while first < end and s[first] in _SIGNS:
        first += 1
    while end > first and s[end - 1] in _SIGNS:
        end -= 1
    return s[first:end].encode()


def _words(text: str) -> list[bytes]:
    runs = text.encode().lower().split()
    if text.isascii():
        words = [r.strip(_ASCII_SIGNS) for r in runs]
    else:
        words = [r.strip(_ASCII_SIGNS) if r.isascii() else _bare(r) for r in runs]
    return [w for w in words if w]


def words_of(text: str | None) -> list[bytes]:
    return _words(text or "")


def shingles(words: list[bytes], k: int) -> set:
    return set(zip(*[words[i:] for i in range(k)])) if len(words) >= k else ({tuple(words)} if words else set())


def question_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """The words of an item's question and of its answer."""
    parts = [_words(p) for p in _SENTENCE.split(text or "")]
    parts = [p for p in parts if p]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 4) if len(words) > 1 else 0
    return (words[:cut], words[cut:]) if cut else (words, words)


@dataclass
class Index:
    """One shard: terms, their unit postings with impacts, and block maxima."""

    terms: dict[bytes, int]
    essential: np.ndarray
    ptr: np.ndarray
    unit: np.ndarray
    impact: np.ndarray
    block_ptr: np.ndarray
    block: np.ndarray
    block_max: np.ndarray
    unit_item: np.ndarray  # unit -> position in items
    items: list  # (item_id, question shingles, answer shingles, shingles of both if the answer is short)
    n_blocks: int


def postings(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, text, unit, term, impact) over the whole benchmark;
    impacts are BM25 weights divided by their unit's sum."""
    numbered = stored(
        benchmark.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "benchmark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            item, unit, term, tf, size = [], [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                for u in range(0, len(words), UNIT_WORDS):
                    part = words[u:u + UNIT_WORDS]
                    counts = {w: part.count(w) for w in set(part)}
                    item += [i] * len(counts)
                    unit += [u // UNIT_WORDS] * len(counts)
                    term += counts
                    tf += counts.values()
                    size += [len(part)] * len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(unit, pa.int32()), pa.array(term, pa.binary()),
                 pa.array(tf, pa.int32()), pa.array(size, pa.int32())],
                names=["item", "unit", "term", "tf", "size"])

    raw = stored(numbered.select("item", "text").mapInArrow(
        run, "item bigint, unit int, term binary, tf int, size int"), "benchmark-terms")
    units = raw.groupBy("item", "unit").agg(F.max("size").alias("size"))
    n, mean = units.agg(F.count(F.lit(1)), F.avg("size")).first()
    df = raw.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(1.0) + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.lit(float(mean or 1))))
    weighed = raw.join(df, "term").withColumn("w", weight)
    whole = weighed.groupBy("item", "unit").agg(F.sum("w").alias("whole"))
    return weighed.join(whole, ["item", "unit"]).withColumn("impact", F.col("w") / F.col("whole")).join(numbered, "item")


def shard_index(rows: list, texts: dict) -> Index:
    """The index of one shard from its (item, unit, term, impact) rows."""
    rows = sorted(rows)
    unit_no, terms, items = {}, {}, {}
    for item, unit, term, _ in rows:
        unit_no.setdefault((item, unit), len(unit_no))
        terms.setdefault(term, len(terms))
        items.setdefault(item, len(items))
    t = np.array([terms[r[2]] for r in rows], np.int64)
    u = np.array([unit_no[r[0], r[1]] for r in rows], np.int64)
    w = np.array([r[3] for r in rows], np.float64)
    order = np.lexsort((u, t))
    t, u, w = t[order], u[order], w[order]
    n_terms, n_blocks = len(terms), -(-len(unit_no) // BLOCK_UNITS)
    ptr = np.searchsorted(t, np.arange(n_terms + 1))
    top = np.maximum.reduceat(w, ptr[:-1])
    weak = np.argsort(top, kind="stable")
    essential = np.ones(n_terms, bool)
    essential[weak[np.cumsum(top[weak]) < SLACK]] = False
    key = t * n_blocks + u // BLOCK_UNITS
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    block_term = t[first]
    listed = []
    for item in items:
        item_id, text = texts[item]
        q, a = question_answer(text)
        listed.append((item_id, shingles(q, 5), shingles(a, 2), shingles(words_of(text), 5) if len(a) < SHORT_ANSWER else None))
    return Index(terms, essential, ptr, u, w, np.searchsorted(block_term, np.arange(n_terms + 1)),
                 u[first] // BLOCK_UNITS, np.maximum.reduceat(w, first),
                 np.array([items[i] for i, _ in unit_no], np.int64), listed, n_blocks)


def _distinct(key, size):
    """np.unique of keys below ``size``."""
    if size > 8 * DENSE:
        return np.unique(key)
    seen = np.zeros(size, bool)
    seen[key] = True
    return np.flatnonzero(seen)


def _expand(ptr, ids):
    """For each id the positions ptr[id]..ptr[id+1]: (row of ids, position)."""
    size = ptr[ids + 1] - ptr[ids]
    row = np.repeat(np.arange(len(ids)), size)
    start = np.repeat(ptr[ids] - np.r_[0, np.cumsum(size)[:-1]], size)
    return row, start + np.arange(len(row))


def _sums(key, value, size):
    """Distinct keys (below ``size``) and the sum of each one's values (above zero)."""
    if size <= DENSE:
        total = np.bincount(key, weights=value, minlength=size)
        keys = np.flatnonzero(total)
        return keys, total[keys]
    keys, place = np.unique(key, return_inverse=True)
    return keys, np.bincount(place, weights=value, minlength=len(keys))


def retrieve(ix: Index, texts: list[list[bytes]], threshold: float = THRESHOLD) -> list[tuple[int, int, float]]:
    """(text number, item position, best score) of all items with a unit at or
    above the threshold in some passage."""
    if not ix.terms or not texts:
        return []
    get, none = ix.terms.get, -1
    sizes = np.array([len(w) for w in texts], np.int64)
    ids = np.fromiter((get(w, none) for ws in texts for w in ws), np.int64, int(sizes.sum()))
    at = np.flatnonzero(ids >= 0)
    if not len(at):
        return []
    doc = np.repeat(np.arange(len(texts)), sizes)[at]
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    n_windows = sizes // STRIDE + 1
    window_of = np.r_[0, np.cumsum(n_windows)[:-1]]
    step = (at - starts[doc]) // STRIDE
    window, term = window_of[doc] + step, ids[at]
    again = step > 0  # each place lies in the window that starts at its stride and in the one before
    window, term = np.r_[window, window[again] - 1], np.r_[term, term[again]]
    n_terms = len(ix.terms)

    strong = ix.essential[term]
    total = int(n_windows.sum())
    key = _distinct(window[strong] * n_terms + term[strong], total * n_terms)
    row, pos = _expand(ix.block_ptr, key % n_terms)
    pair, bound = _sums((key // n_terms)[row] * ix.n_blocks + ix.block[pos], ix.block_max[pos], total * ix.n_blocks)
    pair = pair[bound + SLACK >= threshold]  # (window, block) pairs left
    if not len(pair):
        return []
    left = np.isin(window, pair // ix.n_blocks)
    key = _distinct(window[left] * n_terms + term[left], total * n_terms)
    row, pos = _expand(ix.ptr, key % n_terms)
    w, unit = (key // n_terms)[row], ix.unit[pos]
    left = np.isin(w * ix.n_blocks + unit // BLOCK_UNITS, pair)
    n_units = len(ix.unit_item)
    found, score = _sums(w[left] * n_units + unit[left], ix.impact[pos][left], total * n_units)
    best: dict[tuple[int, int], float] = {}
    for k, s in zip(found[score >= threshold - 1e-9].tolist(), score[score >= threshold - 1e-9].tolist()):
        d = int(np.searchsorted(window_of, k // n_units, side="right")) - 1
        hit = (d, int(ix.unit_item[k % n_units]))
        best[hit] = max(s, best.get(hit, 0.0))
    return sorted((d, i, s) for (d, i), s in best.items())


def leaks(ix: Index, texts: list[str | None]) -> list[tuple[int, object, float, float, float]]:
    """(text number, item_id, score, question overlap, answer overlap) of the
    retrieved items whose question and answer both are in the text, or, with a
    short answer, enough of the whole item."""
    words = [words_of(t) for t in texts]
    out, of = [], {}
    for d, i, score in retrieve(ix, words):
        if d not in of:
            of = {d: (shingles(words[d], 5), shingles(words[d], 2))}
        item_id, q, a, whole = ix.items[i]
        long, short = of[d]
        if len(q) == 1 and len(next(iter(q))) < 5:  # a question of fewer than five words
            size = len(next(iter(q)))
            long = shingles(words[d], size)
        if len(a) == 1 and len(next(iter(a))) < 2:
            short = shingles(words[d], 1)
        qo, ao = len(q & long) / len(q), len(a & short) / len(a)
        both = whole and len(next(iter(whole))) == 5 and len(whole & of[d][0]) / len(whole) >= ITEM_OVERLAP
        if both or (qo >= QUESTION_OVERLAP and ao >= ANSWER_OVERLAP):
            out.append((d, item_id, score, qo, ao))
    return out


def _shards(benchmark: DataFrame):
    """Broadcast indexes, one of at most about SHARD_ITEMS items after another."""
    spark = benchmark.sparkSession
    rows = postings(benchmark)
    shards = max(1, math.ceil(rows.select("item").distinct().count() / SHARD_ITEMS))
    # One shard of rows comes to the driver at a time.
    rows = stored(rows.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)).cast("int")), "benchmark-postings")
    for k in range(shards):
        part = rows.filter(F.col("shard") == k)
        got = [(r[0], r[1], bytes(r[2]), r[3]) for r in part.select("item", "unit", "term", "impact").collect()]
        texts = {r[0]: (r[1], r[2]) for r in part.select("item", "item_id", "text").distinct().collect()}
        yield spark.sparkContext.broadcast(shard_index(got, texts) if got else None)


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per leaked item of a row of ``docs``: doc_id, item_id, score,
    question_overlap, answer_overlap."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    if item_kind not in ARROW:  # ids of other kinds come back as text
        benchmark, item_kind = benchmark.withColumn("item_id", F.col("item_id").cast("string")), "string"

    def scan(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = leaks(shared.value, b.column(1).to_pylist()) if shared.value else []
                cols = list(zip(*found)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], ARROW[item_kind]),
                     *(pa.array(c, pa.float64()) for c in cols[2:])],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        return docs.select("doc_id", "text").mapInArrow(
            run, f"doc_id {kind}, item_id {item_kind}, score double, question_overlap double, answer_overlap double")

    out = None
    for shared in _shards(benchmark):
        part = scan(shared)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no item."""
    bounded_batches(docs.sparkSession)

    def test(shared) -> Column:
        @F.pandas_udf("boolean")
        def leaked(texts: pd.Series) -> pd.Series:
            bad = {x[0] for x in leaks(shared.value, [t if isinstance(t, str) else None for t in texts])} if shared.value else set()
            return pd.Series([i in bad for i in range(len(texts))], dtype=bool)

        return leaked("text")

    for shared in _shards(benchmark):
        docs = docs.filter(~test(shared))
    return docs
