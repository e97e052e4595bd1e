"""Hard negatives by a secondary-sort shuffle.

A row's score for an anchor is the inner product of their vectors, each
component being floor(scale * x), as an integer. Anchors meet all rows in
blocks: rows are dealt into blocks of bounded size, anchors too, and a block of
anchors is scored against a block of rows in one task, so no pair of rows ever
becomes a row of a table by itself.

1. Each pair of blocks gives its first ``n_positives`` rows of an anchor's
   label; the first of them overall are the anchor's positives.
2. A positive of score p opens the window [low_pct * p, p] (in percent). Each
   pair of blocks gives the first ``n_negatives`` rows of another label in each
   window; what comes after them there cannot be among the first overall.
3. Positives and these rows are packed into keys (anchor, descending score,
   positive first, id) and dealt by anchor with
   ``repartitionAndSortWithinPartitions``. An iterator reads the sorted keys:
   a positive opens a window, a negative is given out to every open window that
   it lies in, until a window has enough. It holds one anchor's open windows
   (``n_positives`` at most), never an anchor's rows.

Rows with a null id, label, vector or component, or a component that is not
finite, take no part. Shorter vectors are filled up with zeros. Repeated rows
count one by one; a repeated anchor gives its rows again. A score outside the
range of a long ends the job with an error. Columns other than vec_id,
embedding and label are not read. An empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import partitions, stored

SCALE = 256
ANCHOR_EVERY = 100
N_POSITIVES = 5
N_NEGATIVES = 5
LOW_PCT = 80
ROW_BLOCK = 16_384
ANCHOR_BLOCK = 1_024
#: Row blocks for each shuffle partition, so that hashed blocks spread evenly.
SPREAD = 2
#: Scores of one matrix in memory.
SCORES = 1 << 22
_KEY = struct.Struct(">QQBQ")
_MID = 1 << 63
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, embedding of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))  # NaN is above all
    return rows.select("vec_id", F.col("label").cast("bigint").alias("label"), "embedding").filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)


def _matrix(vectors: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of list vectors, as doubles; short ones end in zeros."""
    column = vectors.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], vectors.type)
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(values) == len(column) * width:
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    at = np.repeat(np.arange(len(column)), sizes), np.concatenate([np.arange(s) for s in sizes] or [np.empty(0, int)])
    out[at[0], at[1].astype(np.int64)] = values
    return out


def _products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The exact integer inner products: in doubles while every partial sum
    is exact there, else in Python's integers."""
    if not a.size or not x.size:
        return np.zeros((len(a), len(x)), np.int64)
    if np.abs(a).max() * np.abs(x).max() * a.shape[1] < 2.0**53 / 128:
        return (a @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.array((whole(a) @ whole(x).T).tolist(), np.int64).reshape(len(a), len(x))  # beyond a long: OverflowError


def _first(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, earlier places first among equals."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.argsort(-scores[at], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")[:k]


def _scored(rows: pa.Table, anchors: pa.Table, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place of an anchor, scores of all rows, whether the label is the
    anchor's, ids), rows in the order of their ids, the anchor itself left out."""
    order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
    rows = rows.take(order)
    ids, rid, labels = (rows[c].to_numpy() for c in ("vec_id", "rid", "label"))
    lengths = [t["embedding"].combine_chunks().value_lengths() for t in (rows, anchors) if t.num_rows]
    width = max((int(np.max(n.to_numpy(zero_copy_only=False))) for n in lengths), default=0)
    x, a = _matrix(rows["embedding"], width, scale), _matrix(anchors["embedding"], width, scale)
    own, label = anchors["rid"].to_numpy(), anchors["label"].to_numpy()
    step = max(1, SCORES // max(len(ids), 1))
    for start in range(0, len(own), step):
        block = _products(a[start:start + step], x)
        for k, scores in enumerate(block, start):
            other = rid != own[k]
            yield k, scores[other], labels[other] == label[k], ids[other]


def _grid(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int):
    """Rows and anchors grouped by (block of rows, block of anchors)."""
    r = F.pmod(F.xxhash64("rid"), F.lit(row_blocks)).cast("int")
    a = F.pmod(F.xxhash64("rid"), F.lit(anchor_blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("rid", "vec_id", "label", "embedding", r.alias("r"), every(anchor_blocks).alias("a"))
    right = anchors.select("*", every(row_blocks).alias("r"), a.alias("a"))
    return left.groupBy("r", "a").cogroup(right.groupBy("r", "a"))


def _positives(grid, k: int, scale: int) -> DataFrame:
    """(rid of the anchor, score, vec_id): each anchor's first ``k`` rows of
    its label."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list = []
        if rows.num_rows and anchors.num_rows:
            own = anchors["rid"].to_pylist()
            for at, scores, same, ids in _scored(rows, anchors, scale):
                scores, ids = scores[same], ids[same]
                found += [(own[at], int(scores[p]), int(ids[p])) for p in _first(scores, k)]
        cols = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["rid", "score", "vec_id"])

    best = Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id")
    return grid.applyInArrow(run, "rid long, score long, vec_id long").withColumn(
        "at", F.row_number().over(best)).filter(F.col("at") <= k).drop("at")


def _window_rows(grid, k: int, low_pct: int, scale: int) -> DataFrame:
    """(rid of the anchor, score, vec_id): the first ``k`` rows of another
    label in each window of each pair of blocks."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list = []
        if rows.num_rows and anchors.num_rows:
            own, opened = anchors["rid"].to_pylist(), anchors["opened"].to_pylist()
            for at, scores, same, ids in _scored(rows, anchors, scale):
                scores, ids, mine = scores[~same], ids[~same], set()
                for p in opened[at]:
                    inside = np.flatnonzero((scores <= p) & (scores >= -(-low_pct * p // 100)))
                    mine.update(inside[_first(scores[inside], k)].tolist())
                found += [(own[at], int(scores[i]), int(ids[i])) for i in mine]
        cols = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["rid", "score", "vec_id"])

    return grid.applyInArrow(run, "rid long, score long, vec_id long")


def packed(anchor: int, score: int, negative: int, vec_id: int) -> bytes:
    """Sorts by anchor, descending score, positives first, id."""
    return _KEY.pack(anchor, _MID - 1 - score, negative, vec_id + _MID)


def opened_windows(sorted_rows, k: int = N_NEGATIVES, low_pct: int = LOW_PCT) -> Iterator[tuple]:
    """Result rows from (packed key, anchor's vec_id) in the order of keys."""
    anchor, windows = None, []
    for key, anchor_id in sorted_rows:
        a, score, negative, vec_id = _KEY.unpack(key)
        score, vec_id = _MID - 1 - score, vec_id - _MID
        if a != anchor:
            anchor, windows = a, []
        if not negative:
            windows.append([vec_id, score, 0])
            continue
        windows = [w for w in windows if w[2] < k and 100 * score >= low_pct * w[1]]  # scores fall: the others are done
        for w in windows:
            if score <= w[1]:
                w[2] += 1
                yield anchor_id, w[0], w[2], vec_id, w[1], score


def mine(rows: DataFrame, anchor_every: int = ANCHOR_EVERY, n_positives: int = N_POSITIVES,
         n_negatives: int = N_NEGATIVES, low_pct: int = LOW_PCT, scale: int = SCALE,
         row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for each anchor (vec_id divisible by ``anchor_every``) and
    positive the first negatives of the window, by score, then id."""
    spark = rows.sparkSession
    base = stored(usable(rows).withColumn("rid", F.monotonically_increasing_id()), "hard-rows")
    anchors = base.filter(F.col("vec_id") % anchor_every == 0)
    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # columns of their own beside those of rows
    n, n_anchors = (t.count() for t in (base, anchors))
    row_blocks = max(SPREAD * partitions(spark), -(-n // row_block))
    anchor_blocks = max(1, -(-n_anchors // anchor_block))
    positives = stored(_positives(_grid(base, anchors, row_blocks, anchor_blocks), n_positives, scale), "hard-positives")
    opened = positives.filter("score >= 0").groupBy("rid").agg(F.collect_set("score").alias("opened"))
    windows = _window_rows(_grid(base, anchors.join(opened, "rid"), row_blocks, anchor_blocks), n_negatives, low_pct, scale)
    names = anchors.select("rid", F.col("vec_id").alias("anchor_id"))
    kinds = positives.withColumn("negative", F.lit(0)).unionByName(windows.withColumn("negative", F.lit(1)))
    keyed = kinds.join(names, "rid").select("rid", "score", "negative", "vec_id", "anchor_id").rdd.map(
        lambda r: (packed(r[0], r[1], r[2], r[3]), r[4]))
    dealt = keyed.repartitionAndSortWithinPartitions(partitions(spark), lambda key: zlib.crc32(key[:8]))
    return spark.createDataFrame(dealt.mapPartitions(lambda it: opened_windows(it, n_negatives, low_pct)), OUT)
