"""Exact linear-interpolated quantiles without a single-task buffer.

``percentile(value, q, freq)`` grouped by column keeps every distinct value of
a group in one aggregation buffer on one task. Here the work is spread out:

1. rows are reduced to (group, value, frequency) with a partial aggregate;
2. inclusive running counts come from ``windows.running_sums`` (range-bucketed
   for large groups, so no task orders a whole column);
3. each group's target ranks ``floor(q*(n-1))`` and ``ceil(q*(n-1))`` are a
   one-row-per-group table joined back on the group key;
4. only the distinct values whose rank range holds a target rank survive the
   filter; a final aggregate per (group, q) interpolates between them.

The arithmetic follows Spark's exact ``percentile`` (and numpy's 'linear'):
position = q*(n-1); when the two neighbouring ranks hold the same value it
is returned as is, else ``(hi-pos)*v_lo + (pos-lo)*v_hi``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.windows import DEFAULT_BUCKETS, running_sums
from ledgerlake.session import bounded_broadcast, cut_lineage

#: Accuracy of the sketch that brackets a rank: off by n / ACCURACY at most.
ACCURACY = 500
#: Rows that a bracket may hold before it is ranked; above it is bracketed again.
BRACKET_ROWS = 1_000_000


class Order(NamedTuple):
    """The two neighbouring values of a quantile and where it lies between."""

    n: int
    pos: float
    low: float | None
    high: float | None

    def value(self, f=lambda x: x) -> float | None:
        """The linear quantile of f(x), for a non-decreasing f."""
        if self.low is None:
            return None
        a, b, lo, hi = f(self.low), f(self.high), math.floor(self.pos), math.ceil(self.pos)
        return a if lo == hi or a == b else (hi - self.pos) * a + (self.pos - lo) * b


def order_statistics(df: DataFrame, columns: Mapping[str, Column], probs: Mapping[str, Sequence[float]],
                     bracket_rows: int = BRACKET_ROWS, accuracy: int = ACCURACY) -> dict[tuple[str, float], Order]:
    """Exact quantiles of several columns of one table, by selection.

    One scan sketches every column and brackets each wanted rank, a second one
    counts the rows below and inside each bracket, and only values inside
    (about 4 / ``accuracy`` of a column) are grouped, shuffled and ranked. A
    bracket that still holds more than ``bracket_rows`` rows is sketched and
    counted again, unless it is one value. A bracket that the counts do not
    confirm is widened to the whole column. Nulls do not count; NaN is above
    all numbers. Numbers alone reach the driver: the counts and two values a
    quantile. A column without values gives ``Order(0, 0, None, None)``."""
    wanted = [(name, q) for name in columns for q in probs[name]]
    x = {name: c.cast("double") for name, c in columns.items()}
    rows = df.select(*[x[name].alias(f"x{i}") for i, name in enumerate(columns)])
    at = {name: F.col(f"x{i}") for i, name in enumerate(columns)}

    def around(q: float) -> list[float]:
        return [max(0.0, q - 2 / accuracy), min(1.0, q + 2 / accuracy)]

    def sketch(c: Column, qs: Sequence[float]) -> Column:
        return F.percentile_approx(c, [p for q in qs for p in around(q)], accuracy)

    first = rows.agg(*[f(at[name]).alias(f"{kind}{i}") for i, name in enumerate(columns) for kind, f in (
        ("n", F.count), ("s", lambda c, name=name: sketch(c, probs[name])))]).first()
    n = {name: first[f"n{i}"] for i, name in enumerate(columns)}
    pos = {(name, q): (n[name] - 1) * q for name, q in wanted}
    edges: dict = {}
    for i, name in enumerate(columns):
        for k, q in enumerate(probs[name]):
            low, high = (first[f"s{i}"] or [None] * (2 * k + 2))[2 * k:2 * k + 2]
            edges[name, q] = (low if around(q)[0] > 0 else None, high if around(q)[1] < 1 else None)
    open_ = [w for w in wanted if n[w[0]] > 0]

    def inside(name: str, q: float) -> Column:
        low, high = edges[name, q]
        c = at[name]
        ok = c.isNotNull()
        if low is not None:
            ok = ok & (c >= F.lit(low))
        return ok if high is None else ok & (c <= F.lit(high))

    def below(name: str, q: float) -> Column:
        low = edges[name, q][0]
        return F.lit(False) if low is None else at[name] < F.lit(low)

    before: dict = {}
    while open_:
        counted = rows.agg(*[F.count_if(f(*w)).alias(f"{kind}{i}") for i, w in enumerate(open_)
                             for kind, f in (("b", below), ("i", inside))]).first()
        again = []
        for i, w in enumerate(open_):
            before[w], held = counted[f"b{i}"], counted[f"i{i}"]
            if before[w] > math.floor(pos[w]) or before[w] + held <= math.ceil(pos[w]):
                edges[w] = (None, None)
                again.append((w, None))
            elif held > bracket_rows and edges[w][0] != edges[w][1]:
                again.append((w, (pos[w] - before[w]) / max(held - 1, 1)))
        if not again:
            break
        closer = [(w, q) for w, q in again if q is not None]
        if closer:
            found = rows.agg(*[F.percentile_approx(F.when(inside(*w), at[w[0]]), around(q), accuracy).alias(f"s{i}")
                               for i, (w, q) in enumerate(closer)]).first()
            for i, (w, q) in enumerate(closer):
                low, high = found[f"s{i}"]
                now = (low if around(q)[0] > 0 else edges[w][0], high if around(q)[1] < 1 else edges[w][1])
                if now == edges[w]:  # no narrower: rank it as it is
                    bracket_rows = max(bracket_rows, n[w[0]])
                edges[w] = now
        open_ = [w for w, _ in again]
    ranked = [w for w in wanted if n[w[0]] > 0]
    out = {w: Order(n[w[0]], max(pos[w], 0.0), None, None) for w in wanted}
    if not ranked:
        return out
    picks = F.array(*[F.struct(F.lit(i).alias("w"), F.when(inside(*w), at[w[0]]).alias("v")) for i, w in enumerate(ranked)])
    values = rows.select(F.explode(F.filter(picks, lambda s: s["v"].isNotNull())).alias("s")).groupBy(
        F.col("s.w").alias("w"), F.col("s.v").alias("v")).agg(F.count(F.lit(1)).alias("f"))
    start = F.element_at(F.array(*[F.lit(before[w]) for w in ranked]), F.col("w") + 1)
    targets = F.element_at(F.array(*[F.array(F.lit(math.floor(pos[w])), F.lit(math.ceil(pos[w]))) for w in ranked]), F.col("w") + 1)
    order = Window.partitionBy("w").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = start + F.sum("f").over(order)
    hits = values.select("w", "v", targets.alias("t"), (end - F.col("f")).alias("a"), end.alias("b")).select(
        "w", "v", *[((F.col("t")[k] >= F.col("a")) & (F.col("t")[k] < F.col("b"))).alias(f"t{k}") for k in (0, 1)])
    for r in hits.filter("t0 or t1").collect():
        w = ranked[r["w"]]
        out[w] = out[w]._replace(**({"low": r["v"]} if r["t0"] else {}), **({"high": r["v"]} if r["t1"] else {}))
    return out


def selected_percentiles(df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float]) -> dict[tuple[str, float], float | None]:
    """Exact linear quantiles by ``order_statistics``, as numbers."""
    found = order_statistics(df, columns, dict.fromkeys(columns, probs))
    return {k: o.value() for k, o in found.items()}


def exact_percentiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (),
                      buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Rows ``(*groups, prob, q)``: the exact quantile of non-null ``value``
    at every ``prob`` within each group. Groups with no non-null value are
    absent (callers treat absence as null)."""
    out_groups = list(groups)
    keys = out_groups or ["_g"]
    v = F.col(value).cast("double")
    base = df if out_groups else df.withColumn("_g", F.lit(0))
    # Distinct values per group: read by three passes below, so written once.
    counts = cut_lineage(
        base.filter(v.isNotNull()).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_f"))
    )
    cum = running_sums(counts, ["_v"], ["_f"], keys, buckets, prefix="_cum")

    pos = (F.col("_n") - F.lit(1)).cast("double") * F.col("_p")
    targets = (
        counts.groupBy(*keys).agg(F.sum("_f").alias("_n"))
        .select(*keys, "_n", F.explode(F.array(*[F.lit(float(q)) for q in probs])).alias("_p"))
        .select(*keys, "_p", pos.alias("_pos"))
        .select(*keys, "_p", "_pos", F.floor("_pos").alias("_lo"), F.ceil("_pos").alias("_hi"))
        .groupBy(*keys).agg(F.collect_list(F.struct("_p", "_pos", "_lo", "_hi")).alias("_t"))
    )  # one row per group, each array len(probs) long; broadcast behind a check of its size

    start, end = F.col("_cum_f") - F.col("_f"), F.col("_cum_f")  # 0-based ranks [start, end)

    def holds(rank):
        return (rank >= start) & (rank < end)

    hit = cum.join(bounded_broadcast(targets), keys, "inner").select(
        *keys, "_v", F.explode(F.filter("_t", lambda t: holds(t["_lo"]) | holds(t["_hi"]))).alias("t"),
        "_f", "_cum_f",
    )
    # Every (group, prob) keeps at most two rows here.
    picked = hit.groupBy(*keys, F.col("t._p").alias("prob")).agg(
        F.first("t._pos").alias("_pos"), F.first("t._lo").alias("_lo"), F.first("t._hi").alias("_hi"),
        F.max(F.when(holds(F.col("t._lo")), F.col("_v"))).alias("_vlo"),
        F.max(F.when(holds(F.col("t._hi")), F.col("_v"))).alias("_vhi"),
    )
    same = (F.col("_lo") == F.col("_hi")) | (F.col("_vlo") == F.col("_vhi"))
    interp = (F.col("_hi") - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * F.col("_vhi")
    return picked.select(*out_groups, "prob", F.when(same, F.col("_vlo")).otherwise(interp).alias("q"))
