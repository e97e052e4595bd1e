"""Isotonic pooling that merges (M-9).

Pool-adjacent-violators over ranges of scores: rows are reduced to (score, sum
of targets, count), dealt by ranges of the score, and every range is pooled in
its own task. A pooled range is a short list of blocks, and pooling the blocks
of neighbouring ranges gives the blocks of both (means are compared exactly, as
integer products, and equal neighbours join, so the blocks do not depend on how
the scores were cut). ``FAN_IN`` ranges at a time are merged until one is left.
The last list is the fitted map itself; rows never meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import cut_lineage

FAN_IN = 16
_BLOCK = "part int, low double, high double, total long, n long"


def pooled(rows: Iterable[tuple[float, float, int, int]]) -> list[tuple[float, float, int, int]]:
    """Blocks (low, high, sum, count) of ordered blocks, means increasing."""
    out: list[tuple[float, float, int, int]] = []
    for low, high, total, n in rows:
        while out and out[-1][2] * n >= total * out[-1][3]:
            first, _, before, m = out.pop()
            low, total, n = first, total + before, n + m
        out.append((low, high, total, n))
    return out


def _table(part: int, found: list) -> pa.RecordBatch:
    cols = list(zip(*found)) if found else [(), (), (), ()]
    kinds = (pa.float64(), pa.float64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * len(found), pa.int32()), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
        names=["part", "low", "high", "total", "n"])


def blocks(df: DataFrame, score: str = "risk_score", y: str = "target", ranges: int | None = None) -> DataFrame:
    """(low, high, total, n): the blocks of the isotonic fit of ``y`` (0 or 1)
    on ``score``. Rows without a score or target do not count."""
    by_score = df.select(F.col(score).cast("double").alias("low"), F.col(y).cast("long").alias("y")).dropna().groupBy("low").agg(
        F.sum("y").alias("total"), F.count(F.lit(1)).alias("n"))
    ordered = (by_score.repartitionByRange(ranges, "low") if ranges else by_score.repartitionByRange("low"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        part = 0
        for b in batches:
            part = b.column(0)[0].as_py() if b.num_rows else part
            low, total, n = (b.column(i).to_pylist() for i in (1, 2, 3))
            out = pooled([*out, *zip(low, low, total, n)])
        yield _table(part, out)

    now = ordered.sortWithinPartitions("low").select(F.spark_partition_id().alias("part"), "low", "total", "n").mapInArrow(first, _BLOCK)
    now = cut_lineage(now)
    while (now.agg(F.max("part")).first()[0] or 0) > 0:
        def merged(key: tuple, rows: pa.Table) -> pa.Table:
            rows = rows.sort_by([("low", "ascending")])
            cols = [rows[c].to_pylist() for c in ("low", "high", "total", "n")]
            return pa.Table.from_batches([_table(key[0].as_py(), pooled(zip(*cols)))])

        now = now.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        now = cut_lineage(now.groupBy("part").applyInArrow(merged, _BLOCK))
    return now.drop("part")


def fit(df: DataFrame, score: str = "risk_score", y: str = "target", ranges: int | None = None):
    """The MLlib model of the blocks: level on a block, linear between them,
    clipped outside. Its own pooling sees blocks that no longer violate."""
    value = (F.col("total").cast("double") / F.col("n")).alias("rate")
    half = (F.col("n") / 2).alias("w")
    found = blocks(df, score, y, ranges)
    ends = found.filter("low < high").select(F.explode(F.array("low", "high")).alias("score"), value, half).unionByName(
        found.filter("low = high").select(F.col("low").alias("score"), value, F.col("n").cast("double").alias("w")))
    return IsotonicRegression(featuresCol="score", labelCol="rate", weightCol="w", isotonic=True).fit(ends)
