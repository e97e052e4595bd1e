"""Probability metrics and the grade prior (M-1, M-4, M-10).

Log loss and Brier are plain averages. ROC-AUC and average precision are
exact and tie-correct: rows are reduced to (score, positives, negatives) with
a partial aggregate, then cumulative counts over distinct scores come from the
range-bucketed running sums (no single-task global window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.quantiles import selected_percentiles
from ledgerlake.functions.windows import running_sums
from ledgerlake.session import bounded_broadcast, cut_lineage

EPS = 2.220446049250313e-16


def _clip(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(EPS)), F.lit(1.0 - EPS))


def quality(df: DataFrame, y: str = "target", p: str = "probability_of_default", group: list[str] | None = None) -> DataFrame:
    """M-4 per group: n, log loss (p clipped to [eps, 1-eps]), exact ROC-AUC
    (ties count one half), PR-AUC (average precision), Brier.

    Rows are reduced once to (group, score, positives, negatives); all five
    come from that table: the pointwise losses are sums over it, the ranking
    metrics need the running counts below each score, and the counts at or
    above it are the totals less those."""
    g = list(group or []) or ["_all"]
    base = df if group else df.withColumn("_all", F.lit(0))
    # one row per (group, distinct score), read by the totals and the running sums
    by_score = cut_lineage(base.groupBy(*g, F.col(p).cast("double").alias("score")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"),
        F.sum((F.lit(1) - F.col(y)).cast("long")).alias("neg"),
    ))
    s, c = F.col("score"), _clip(F.col("score"))
    all_ = F.col("pos") + F.col("neg")
    scored = F.sum(F.when(s.isNotNull(), all_))
    totals = by_score.groupBy(*g).agg(
        F.sum(all_).alias("n"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
        (F.sum(-(F.col("pos") * F.log(c) + F.col("neg") * F.log(F.lit(1.0) - c))) / scored).alias("log_loss"),
        (F.sum(F.col("pos") * (F.lit(1.0) - s) ** 2 + F.col("neg") * s ** 2) / scored).alias("brier"),
    )
    below = running_sums(by_score, ["score"], ["pos", "neg"], g, prefix="cum_").join(totals, g)
    at_or_above = (F.col("_p") - F.col("cum_pos") + F.col("pos"), F.col("_n") - F.col("cum_neg") + F.col("neg"))
    won = (F.col("cum_neg") - F.col("neg")) * F.col("pos") + F.lit(0.5) * F.col("pos") * F.col("neg")
    precision = at_or_above[0] / (at_or_above[0] + at_or_above[1])
    one = lambda name: F.first(name).alias(name)  # noqa: E731 -- the same on every row of a group
    out = below.groupBy(*g).agg(
        one("n"), one("log_loss"),
        (F.sum(won) / (F.first("_p").cast("double") * F.first("_n").cast("double"))).alias("roc_auc"),
        F.when(F.first("_p") > 0, F.sum(F.col("pos") * precision) / F.first("_p")).alias("pr_auc"),
        one("brier"),
    )
    return out if group else out.drop("_all")


def reliability(df: DataFrame, y: str = "target", p: str = "probability_of_default", n_bins: int = 15) -> DataFrame:
    """M-10: quantile-binned calibration table (mean predicted vs observed),
    empty bins dropped. Inner edges are exact linear quantiles of p."""
    probs = [i / n_bins for i in range(1, n_bins)]
    # n_bins - 1 rows come back to the driver: the edges become literals.
    found = selected_percentiles(df, {"p": F.col(p)}, probs)
    edges = [found["p", q] for q in probs if found["p", q] is not None]
    edge_arr = F.array(*[F.lit(float(e)) for e in edges])
    b = F.size(F.filter(edge_arr, lambda e: e <= F.col(p).cast("double")))
    return df.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(p).cast("double")).alias("mean_predicted"),
        F.avg(F.col(y).cast("double")).alias("observed_rate"),
    )


# --- M-1 grade prior ---------------------------------------------------------------

def fit_grade_prior(train: DataFrame, grade_col: str = "grade", y: str = "target") -> tuple[DataFrame, float]:
    """Mean target per grade (a small table) and the global mean (fallback).
    The train rows are read once, here: every later use of the rates reads the
    reduced table, and the global mean is made from its sums."""
    target = F.col(y).cast("double")
    rates = cut_lineage(train.groupBy(grade_col).agg(
        F.count(F.lit(1)).alias("loans"), F.avg(target).alias("prior"),
        F.count(target).alias("_known"), F.sum(target).alias("_total"),
    ))
    total, known = rates.agg(F.sum("_total"), F.sum("_known")).first()
    return rates.drop("_known", "_total"), float(total) / known


def predict_grade_prior(df: DataFrame, rates: DataFrame, overall: float, grade_col: str = "grade",
                        out: str = "probability_of_default") -> DataFrame:
    """Left join on grade (broadcast only after the size check); unseen or
    null grade -> global mean."""
    small = bounded_broadcast(rates.select(grade_col, F.col("prior").alias("_prior")))
    return df.join(small, grade_col, "left").withColumn(out, F.coalesce(F.col("_prior"), F.lit(overall))).drop("_prior")
