"""Monitoring: drift, data quality and alerts (D-1 .. D-11).

All months are handled in ONE job keyed by ``batch``; nothing loops over
months on the driver.

Numeric drift (D-2) is the normed Wasserstein-1 distance between each month
and the reference, computed without copying the reference once per month: the
reference is profiled once, and ranges of values are integrated in tasks of
their own (``numeric_drift``).

Categorical drift (D-3) is the Jensen-Shannon distance (natural log); levels
seen only in the reference contribute ``p*ln 2`` each, which is summed from
the reference shares without expanding them per month.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.session import cut_lineage, round_half_up


def as_category(c: str, dtype) -> Column:
    """Categorical value as text; booleans as 'True'/'False' like the report."""
    from pyspark.sql.types import BooleanType

    if isinstance(dtype, BooleanType):
        return F.when(F.col(c), F.lit("True")).when(~F.col(c), F.lit("False"))
    return F.col(c).cast("string")


def _long(df: DataFrame, columns, keep=(), numeric=True) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    structs = [
        F.struct(F.lit(c).alias("column"),
                 (F.col(c).cast("double") if numeric else as_category(c, types[c])).alias("value"))
        for c in columns
    ]
    return df.select(*keep, F.explode(F.array(*structs)).alias("_kv")).select(*keep, "_kv.column", "_kv.value")


# --- D-2 ------------------------------------------------------------------------

#: Rows of a range of values, on average; a column has so many ranges, at least RANGES.
ROWS_PER_RANGE = 500_000
RANGES = 16


@dataclass(frozen=True)
class ReferenceProfile:
    """The reference side of D-2, made once: (col, value, n) rows, written to
    the shared folder, and a few numbers a column."""

    columns: tuple[str, ...]
    rows: DataFrame
    totals: tuple[int, ...]
    std: tuple[float, ...]
    edges: tuple[tuple[float, ...], ...]


def _sketch_edges(df: DataFrame, columns, others=()) -> tuple[list[list[float]], list]:
    """Quantile edges of each column (one aggregate of all columns over the
    unmultiplied rows) and the row's other aggregates."""
    n = df.count()
    ranges = max(RANGES, -(-n // ROWS_PER_RANGE))
    probs = [i / ranges for i in range(1, ranges)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, max(1000, 4 * ranges)).alias(f"e{i}")
                   for i, c in enumerate(columns)], *others).first()
    return [sorted(set(row[f"e{i}"] or [])) for i in range(len(columns))], row


def _compacted(df: DataFrame, columns, keep: str | None = None) -> DataFrame:
    """([keep,] col, value, n): the non-null values of each column, counted
    batch by batch in the tasks; col is the column's place in ``columns``."""
    import numpy as np
    import pyarrow as pa

    width = len(columns)
    picked = df.select(*([F.col(keep).alias("_k")] if keep else []), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])

    def run(batches):
        for b in batches:
            keys = b.column(0).dictionary_encode() if keep else None
            codes = keys.indices.to_numpy(zero_copy_only=False) if keep else np.zeros(b.num_rows, np.int64)
            out = []
            for i in range(width):
                column = b.column(i + bool(keep))
                known = column.is_valid().to_numpy(zero_copy_only=False)
                values = column.to_numpy(zero_copy_only=False)[known] + 0.0  # one zero
                order = np.lexsort((values, codes[known]))
                v, k = values[order], codes[known][order]
                new = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (k[1:] != k[:-1])]) if len(v) else np.empty(0, int)
                out.append((np.full(len(new), i, np.int32), v[new], np.diff(np.r_[new, len(v)]), k[new]))
            col, value, n, code = (np.concatenate(x) for x in zip(*out))
            cells = [pa.array(col), pa.array(value), pa.array(n.astype(np.int64))]
            if keep:
                cells = [keys.dictionary.take(pa.array(code.astype(np.int64))), *cells]
            yield pa.RecordBatch.from_arrays(cells, names=[*(["_k"] if keep else []), "col", "value", "n"])

    ddl = "col int, value double, n long"
    return picked.mapInArrow(run, f"_k {picked.schema['_k'].dataType.simpleString()}, {ddl}" if keep else ddl)


def reference_profile(reference: DataFrame, columns) -> ReferenceProfile:
    """Counts, moments and ranges of the reference, for any number of months."""
    others = [f(F.col(c).cast("double")).alias(f"{name}{i}") for i, c in enumerate(columns)
              for name, f in (("n", F.count), ("s", F.stddev_pop))]
    edges, row = _sketch_edges(reference, columns, others)
    rows = cut_lineage(_compacted(reference, columns).groupBy("col", "value").agg(F.sum("n").alias("n")))
    return ReferenceProfile(tuple(columns), rows, tuple(row[f"n{i}"] for i in range(len(columns))),
                            tuple(float(row[f"s{i}"] or 0.0) for i in range(len(columns))), tuple(map(tuple, edges)))


def _distance(lo: float, hi: float, x, fx, f0: float, c, g, g0: float) -> float:
    """The integral of |F - G| over [lo, hi): F steps to fx at the sorted x
    (f0 before), G to g at the sorted c (g0 before)."""
    import numpy as np

    at, step = np.r_[lo, x], np.r_[f0, fx]
    area = np.r_[0.0, np.cumsum(step[:-1] * np.diff(at))]  # of F from lo up to each of its points

    def up_to(v):
        i = np.searchsorted(x, v, side="right")
        return area[i] + step[i] * (v - at[i])

    a, b, k = np.r_[lo, c], np.r_[c, hi], np.r_[g0, g]
    # F is below k up to m and not below it from there on
    first = np.searchsorted(step, k, side="left")
    m = np.clip(np.where(first < len(at), at[np.minimum(first, len(at) - 1)], hi), a, b)
    under = k * (m - a) - (up_to(m) - up_to(a))
    over = (up_to(b) - up_to(m)) - k * (b - m)
    return float(np.sum(under + over))


def numeric_drift(reference: DataFrame | ReferenceProfile, current: DataFrame, columns, batch: str = "batch") -> DataFrame:
    """(batch, column, drift): Wasserstein-1 / max(std_pop(reference), 0.001),
    nulls dropped on both sides.

    The axis of every column is cut into ranges (by sketches of both sides, so
    neither side is dense in one); a range's reference values and all months'
    values meet in one task, which integrates |F - G| over the range for each
    month: how many rows lie below the range on either side comes from the
    ranges' counts. The integrals of the ranges add up. Rows are shuffled once
    and the reference is not multiplied by the months."""
    import numpy as np
    import pyarrow as pa

    profile = reference if isinstance(reference, ReferenceProfile) else reference_profile(reference, columns)
    cur_edges, _ = _sketch_edges(current, columns)
    edges = [np.array(sorted({*a, *b})) for a, b in zip(profile.edges, cur_edges)]
    totals, names = profile.totals, list(columns)

    def placed(df: DataFrame) -> DataFrame:
        """The range of each row (0: below the first edge)."""
        def run(batches):
            for b in batches:
                col, value = b["col"].to_numpy(), b["value"].to_numpy()
                at = np.zeros(len(col), np.int32)
                for i in np.unique(col):
                    mine = col == i
                    at[mine] = np.searchsorted(edges[i], value[mine], side="right")
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=[*b.schema.names, "r"])

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        return df.mapInArrow(run, f"{kinds}, r int")

    ref = cut_lineage(placed(profile.rows))
    cur = cut_lineage(placed(_compacted(current, columns, batch).groupBy("_k", "col", "value").agg(F.sum("n").alias("n"))))
    # rows below each range, for the reference and every (month, column) that has rows, in all ranges
    last = F.element_at(F.array(*[F.lit(len(e)) for e in edges]), F.col("col") + 1)

    def below(df: DataFrame, keys: list[str]) -> DataFrame:
        counts = df.groupBy(*keys, "r").agg(F.sum("n").alias("n"))
        grid = counts.groupBy(*keys).agg(F.sum("n").alias("all")).withColumn("r", F.explode(F.sequence(F.lit(0), last)))
        run = Window.partitionBy(*keys).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
        return grid.join(counts, [*keys, "r"], "left").select(
            *keys, "r", "all", F.coalesce(F.sum("n").over(run), F.lit(0)).cast("long").alias("below"))

    none = F.lit(None)
    left = ref.select("col", "r", "value", "n", none.cast("long").alias("below")).unionByName(
        below(ref, ["col"]).select("col", "r", none.cast("double").alias("value"), none.cast("long").alias("n"), "below"))
    right = cur.select("_k", "col", "r", "value", "n", none.cast("long").alias("below"), none.cast("long").alias("all")).unionByName(
        below(cur, ["_k", "col"]).select("_k", "col", "r", none.cast("double").alias("value"), none.cast("long").alias("n"), "below", "all"))

    def integrate(key: tuple, r: pa.Table, c: pa.Table) -> pa.Table:
        col, at = key[0].as_py(), key[1].as_py()
        out_k, out_w = [], []
        if r.num_rows and totals[col]:
            r = r.sort_by("value")
            known = r["value"].is_valid()
            values = r.filter(known)
            x, n = values["value"].to_numpy(), values["n"].to_numpy()
            start = r.filter(pa.compute.invert(known))["below"][0].as_py()
            f0, fx = start / totals[col], (start + np.cumsum(n)) / totals[col]
            lo = edges[col][at - 1] if at > 0 else -np.inf
            hi = edges[col][at] if at < len(edges[col]) else np.inf
            months = c.filter(c["below"].is_valid())
            rows = c.filter(c["value"].is_valid()).sort_by([("_k", "ascending"), ("value", "ascending")])
            codes = pa.compute.index_in(rows["_k"], months["_k"]).to_numpy()
            cv, cn = rows["value"].to_numpy(), rows["n"].to_numpy()
            for i, (k, under, size) in enumerate(zip(*(months[x].to_pylist() for x in ("_k", "below", "all")))):
                mine = codes == i
                v, g = cv[mine], (under + np.cumsum(cn[mine])) / size
                points = np.r_[x, v]
                low, high = (lo if np.isfinite(lo) else points.min(initial=np.inf)), (hi if np.isfinite(hi) else points.max(initial=-np.inf))
                if low < high:  # outside the first and the last point both are 0 or both 1
                    out_k.append(k)
                    out_w.append(_distance(low, high, x, fx, f0, v, g, under / size))
        return pa.table([pa.array(out_k, c["_k"].type), pa.array([col] * len(out_k), pa.int32()), pa.array(out_w, pa.float64())],
                        names=["_k", "col", "w"])

    kind = current.schema[batch].dataType.simpleString()
    parts = left.groupBy("col", "r").cogroup(right.groupBy("col", "r")).applyInArrow(integrate, f"_k {kind}, col int, w double")
    std = F.element_at(F.array(*[F.lit(max(s, C.STD_FLOOR)) for s in profile.std]), F.col("col") + 1)
    name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("col") + 1)
    # a month whose values all equal the reference's one value has no range to integrate: its distance is 0
    seen = cur.select("_k", "col").distinct().filter(F.element_at(F.array(*[F.lit(t > 0) for t in totals]), F.col("col") + 1))
    found = seen.join(parts.groupBy("_k", "col").agg(F.sum("w").alias("w")), ["_k", "col"], "left")
    return found.select(F.col("_k").alias(batch), name.alias("column"), (F.coalesce("w", F.lit(0.0)) / std).alias("drift"))


# --- D-3 ------------------------------------------------------------------------

def categorical_drift(reference: DataFrame, current: DataFrame, columns, batch: str = "batch") -> DataFrame:
    """(batch, column, drift): Jensen-Shannon distance, natural log, nulls dropped."""
    ref = _long(reference, columns, numeric=False).filter(F.col("value").isNotNull())
    cur = _long(current, columns, keep=(batch,), numeric=False).filter(F.col("value").isNotNull())
    ref_levels = ref.groupBy("column", "value").agg(F.count(F.lit(1)).alias("ref_n"))
    ref_tot = ref_levels.groupBy("column").agg(F.sum("ref_n").alias("ref_total"))
    ref_p = ref_levels.join(ref_tot, "column").select("column", "value", (F.col("ref_n") / F.col("ref_total")).alias("p"))
    cur_levels = cur.groupBy(batch, "column", "value").agg(F.count(F.lit(1)).alias("cur_n"))
    cur_tot = cur_levels.groupBy(batch, "column").agg(F.sum("cur_n").alias("cur_total"))
    cur_q = cur_levels.join(cur_tot, [batch, "column"]).select(batch, "column", "value", (F.col("cur_n") / F.col("cur_total")).alias("q"))
    j = cur_q.join(ref_p, ["column", "value"], "left").fillna(0.0, ["p"])
    p, q = F.col("p"), F.col("q")
    mid = (p + q) / 2
    term = F.when(q > 0, q * F.log(q / mid)).otherwise(0.0) + F.when(p > 0, p * F.log(p / mid)).otherwise(0.0)
    per = j.groupBy(batch, "column").agg(F.sum(term).alias("matched"), F.sum("p").alias("p_matched"))
    js = (F.col("matched") + F.lit(math.log(2.0)) * F.greatest(F.lit(0.0), F.lit(1.0) - F.col("p_matched"))) / 2
    return per.select(batch, "column", F.sqrt(F.greatest(js, F.lit(0.0))).alias("drift"))


# --- D-5, D-6 --------------------------------------------------------------------

def missing_increase(reference: DataFrame, current: DataFrame, columns, batch: str = "batch") -> DataFrame:
    """(batch, column, increase): round(cur null share - ref null share, 4) > 0."""
    ref = reference.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    cur = current.groupBy(batch).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    ref_l = _long(ref, columns).withColumnRenamed("value", "ref_share")
    cur_l = _long(cur, columns, keep=(batch,)).withColumnRenamed("value", "cur_share")
    inc = round_half_up(F.col("cur_share") - F.col("ref_share"), 4)
    return cur_l.join(ref_l, "column").select(batch, "column", inc.alias("increase")).filter(F.col("increase") > 0)


def new_categories(reference: DataFrame, current: DataFrame, columns, batch: str = "batch") -> DataFrame:
    """(batch, column, value) present in the month but never in the reference."""
    ref = _long(reference, columns, numeric=False).filter(F.col("value").isNotNull()).distinct()
    cur = _long(current, columns, keep=(batch,), numeric=False).filter(F.col("value").isNotNull()).distinct()
    return cur.join(ref, ["column", "value"], "left_anti")


# --- D-4 ------------------------------------------------------------------------

def batch_summaries(scored: DataFrame, drift: DataFrame, missing: DataFrame, new_cats: DataFrame,
                    inputs, batch: str = "batch") -> DataFrame:
    """One row per month: loans, drift share over the inputs (strictly above the
    threshold), prediction drift, drifted columns, fund rate, mean probability,
    outcome coverage, missing increases and new categories (sorted text)."""
    n_inputs = len(list(inputs))
    base = scored.groupBy(batch).agg(
        F.count(F.lit(1)).alias("loans"),
        F.avg((F.col("decision") == "fund").cast("double")).alias("fund_rate"),
        F.avg("probability_of_default").alias("mean_probability"),
        F.avg(F.col("outcome_known").cast("double")).alias("outcome_known"),
    )
    is_input = F.col("column").isin(*inputs)
    drifted = F.when(is_input & (F.col("drift") > C.DRIFT_THRESHOLD), F.col("column"))
    d = drift.groupBy(batch).agg(
        F.count(drifted).alias("n_drifted"),
        F.array_sort(F.collect_list(drifted)).alias("drifted"),
        F.max(F.when(F.col("column") == C.PREDICTION_COLUMN, F.col("drift"))).alias("prediction_drift"),
    )
    mi = missing.groupBy(batch).agg(
        F.array_sort(F.collect_list(F.concat(F.col("column"), F.lit(":"), F.format_string("%.4f", F.col("increase"))))).alias("mi")
    )
    nc = new_cats.groupBy(batch).agg(
        F.array_sort(F.collect_list(F.concat(F.col("column"), F.lit("="), F.col("value")))).alias("nc")
    )
    s = base.join(d, batch, "left").join(mi, batch, "left").join(nc, batch, "left")
    return s.select(
        batch, "loans",
        round_half_up(F.coalesce(F.col("n_drifted"), F.lit(0)) / F.lit(float(n_inputs)), 4).alias("drift_share"),
        round_half_up(F.coalesce(F.col("prediction_drift"), F.lit(0.0)), 4).alias("prediction_drift"),
        F.concat_ws(",", F.coalesce(F.col("drifted"), F.array().cast("array<string>"))).alias("drifted_columns"),
        round_half_up(F.col("fund_rate"), 4).alias("fund_rate"),
        round_half_up(F.col("mean_probability"), 4).alias("mean_probability"),
        round_half_up(F.col("outcome_known"), 4).alias("outcome_known"),
        F.concat_ws(";", F.coalesce(F.col("mi"), F.array().cast("array<string>"))).alias("missing_increase"),
        F.concat_ws(";", F.coalesce(F.col("nc"), F.array().cast("array<string>"))).alias("new_categories"),
    )


# --- D-7 .. D-11 ---------------------------------------------------------------------

def _fmt(x: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", round_half_up(x, digits))


def breaches(summaries: DataFrame) -> DataFrame:
    """D-7: breach flag and the named thresholds crossed."""
    ds, pd = F.col("drift_share"), F.col("prediction_drift")
    crossed = F.array_compact(F.array(
        F.when(ds > C.TRIGGER_DRIFT_SHARE, F.concat(F.lit("drift share "), _fmt(ds, 2), F.lit(f" > {C.TRIGGER_DRIFT_SHARE}"))),
        F.when(pd > C.TRIGGER_PREDICTION_DRIFT, F.concat(F.lit("prediction drift "), _fmt(pd, 3), F.lit(f" > {C.TRIGGER_PREDICTION_DRIFT}"))),
    ))
    return summaries.withColumn("crossed", crossed).withColumn("breach", F.size("crossed") > 0)


def retrain_alerts(summaries: DataFrame, needed: int = C.TRIGGER_CONSECUTIVE_MONTHS, batch: str = "batch") -> DataFrame:
    """D-8: fire on the month completing ``needed`` consecutive breaching
    batches, once per episode (gaps and islands over the months present).

    The summary table has one row per month, so its windows are small."""
    b = breaches(summaries)
    order = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("island", F.sum(F.when(F.col("breach"), 0).otherwise(1)).over(order))
    run_w = Window.partitionBy("island").orderBy(batch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("run", F.sum(F.when(F.col("breach"), 1).otherwise(0)).over(run_w))
    fired = b.filter(F.col("breach") & (F.col("run") == needed))
    return fired.select(
        F.lit("retrain").alias("kind"), batch,
        F.concat(F.col("run").cast("string"), F.lit(" consecutive months above threshold ("),
                 F.concat_ws("; ", "crossed"), F.lit(")")).alias("reason"),
    )


def missing_alerts(summaries: DataFrame, missing: DataFrame, columns, limit: float = C.TRIGGER_MAX_MISSING_INCREASE,
                   batch: str = "batch") -> DataFrame:
    """D-9: increase above ``limit``; suppressed when the same column breached in
    the previous batch (batches present, not calendar months); immediate."""
    idx = summaries.select(batch, F.row_number().over(Window.orderBy(batch)).alias("bi"))
    br = missing.filter(F.col("increase") > limit).join(idx, batch)
    prev = F.lag("bi").over(Window.partitionBy("column").orderBy("bi"))
    br = br.withColumn("prev", prev).filter(F.col("prev").isNull() | (F.col("prev") != F.col("bi") - 1))
    pos = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column"))
    item = F.struct((-F.col("increase")).alias("neg"), pos.alias("pos"),
                    F.concat(F.col("column"), F.lit(" +"), F.format_string("%d", F.floor(F.col("increase") * 100 + 0.5).cast("int")), F.lit("%")).alias("txt"))
    per = br.groupBy(batch).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return per.select(
        F.lit("investigate").alias("kind"), batch,
        F.concat(F.lit("missing values jumped vs reference: "), F.concat_ws(", ", F.transform("items", lambda s: s["txt"]))).alias("reason"),
    )


def category_alerts(new_cats: DataFrame, batch: str = "batch") -> DataFrame:
    """D-10: each (column, value) alerts once, in the first month it appears;
    one alert per month naming all its new pairs, sorted."""
    first = new_cats.groupBy("column", "value").agg(F.min(batch).alias(batch))
    per = first.groupBy(batch).agg(F.array_sort(F.collect_list(F.struct("column", "value"))).alias("pairs"))
    return per.select(
        F.lit("investigate").alias("kind"), batch,
        F.concat(F.lit("categories never seen in training: "),
                 F.concat_ws(", ", F.transform("pairs", lambda s: F.concat(s["column"], F.lit("="), s["value"])))).alias("reason"),
    )


def alert_log(missing_a: DataFrame, category_a: DataFrame, retrain_a: DataFrame) -> DataFrame:
    """D-11: all alerts with their order within a month (missing, category, retrain)."""
    return (
        missing_a.withColumn("seq", F.lit(1))
        .unionByName(category_a.withColumn("seq", F.lit(2)))
        .unionByName(retrain_a.withColumn("seq", F.lit(3)))
    )
