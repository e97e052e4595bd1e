"""Evaluation keyed by model family (M-13, A-4 .. A-9 for several families).

All families' scores of the same loans are one long table (loan, family, raw
score, calibrated probability). Tuning reads the tuning rows of that table
only: one grouped curve, one grouped choice, one quantile job. The test year is
scored once into the same shape, and every family's metrics and policies come
from grouped aggregates over it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.functions.features import expected_return
from ledgerlake.functions.quantiles import order_statistics
from ledgerlake.operators import policy
from ledgerlake.session import round_half_up

FAMILY = "family"
#: Policies that do not look at a score, reported once.
BASELINE = "baseline"


@dataclass(frozen=True)
class Tuned:
    """What tuning gives a family: three numbers and the shared target."""

    threshold: float
    matched_threshold: float
    matched_share: float
    risk_at_threshold: float


def long_scores(df: DataFrame, scorers: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """``df`` scored by every family: its columns, family, risk_score and
    probability_of_default."""
    frames = [scorer(df).select(*df.columns, F.lit(name).alias(FAMILY), "risk_score", "probability_of_default")
              for name, scorer in scorers.items()]
    return reduce(DataFrame.unionByName, frames)


def scored_in_one_read(df: DataFrame, scorers: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """``df`` scored by every family: its columns, family, risk_score and
    probability_of_default. A row is read once and scored by one family after
    the other (scorers keep the columns that they do not make)."""
    made = ("risk_score", "probability_of_default")
    kept, wide = [c for c in df.columns if c not in made], df
    for i, scorer in enumerate(scorers.values()):
        wide = scorer(wide).withColumnsRenamed({c: f"_{c}_{i}" for c in made})
    rows = [F.struct(F.lit(name).alias(FAMILY), *[F.col(f"_{c}_{i}").cast("double").alias(c) for c in made])
            for i, name in enumerate(scorers)]
    return wide.select(*kept, F.explode(F.array(*rows)).alias("_s")).select(*kept, "_s.*")


def threshold_curves(scored: DataFrame, families: list[str]) -> DataFrame:
    """A-5 for every family in one aggregate: rows fall into the first grid
    point that funds them, and running sums go over the grid."""
    spark = scored.sparkSession
    never = F.lit(C.THRESHOLD_GRID_POINTS)
    buckets = scored.groupBy(FAMILY, F.coalesce(policy.first_funding_grid_index(F.col("risk_score")), never).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("funded_amnt").alias("capital"), F.sum("realized_profit").alias("profit"),
        F.sum(F.col("target").cast("double")).alias("defaults"))
    grid = spark.createDataFrame([(f, k) for f in families for k in range(C.THRESHOLD_GRID_POINTS + 1)], f"{FAMILY} string, k int")
    sums = ("n", "capital", "profit", "defaults")
    # Both sides are bounded by the grid (117 rows a family), whatever the data.
    joined = grid.join(F.broadcast(buckets), [FAMILY, "k"], "left").select(
        FAMILY, "k", *[F.coalesce(c, F.lit(0)).alias(c) for c in sums])
    everything = Window.partitionBy(FAMILY)
    run = everything.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    curve = joined.select(FAMILY, "k", policy.grid_value(F.col("k")).alias("threshold"), F.sum("n").over(everything).alias("rows"),
                          *[F.sum(c).over(run).alias(c) for c in sums])
    return policy.policy_metrics(curve.filter(F.col("k") < never).drop("k"))


def tune(scored: DataFrame, families: list[str], objective: str = "return_per_dollar",
         min_share: float = C.MIN_SHARE_FUNDED) -> dict[str, Tuned]:
    """A-6 .. A-8 for every family on the tuning rows."""
    best = Window.partitionBy(FAMILY).orderBy(round_half_up(F.col(objective), 10).desc(), F.col("threshold").asc())
    curve = threshold_curves(scored, families).filter(F.col("share_funded") >= min_share)
    chosen = {r[FAMILY]: float(r["threshold"]) for r in curve.withColumn("at", F.row_number().over(best)).filter("at = 1").collect()}
    for f in families:
        if f not in chosen:
            raise ValueError(f"no threshold of {f} funds the minimum share of loans")
    is_ = {f: F.col(FAMILY) == f for f in families}
    share = policy.grade_ab_share(scored.filter(is_[families[0]]))  # the same loans in every family
    if not 0 < share <= 1:
        raise ValueError(f"share must be in (0, 1], got {share}")
    ranks = order_statistics(scored, {f: F.when(is_[f], F.col("risk_score")) for f in families}, dict.fromkeys(families, [share]))
    risks = scored.agg(*[F.max(F.when(is_[f] & (F.col("risk_score") < chosen[f]), F.col("probability_of_default"))).alias(f"r{i}")
                         for i, f in enumerate(families)]).first()
    return {f: Tuned(chosen[f], ranks[f, share].value(), share, float(risks[f"r{i}"] or 0.0)) for i, f in enumerate(families)}


def flags(tuned: dict[str, Tuned], profit: policy.ProfitModel) -> dict[str, Column]:
    """The scored policies as conditions on a row of the long table (with
    ``gain``), each by the thresholds of the row's family."""
    ev = expected_return(F.col("probability_of_default"), F.col("gain"), F.col("funded_amnt"), profit.lgd, profit.prepay_factor) > 0

    def of(attribute: str) -> Column:
        return reduce(lambda e, f: F.when(F.col(FAMILY) == f, F.lit(getattr(tuned[f], attribute))).otherwise(e),
                      tuned, F.lit(None).cast("double"))

    return {
        "expected_value": ev,
        "threshold": (F.col("risk_score") < of("threshold")) & ev,
        "matched_to_grade_AB": (F.col("risk_score") < of("matched_threshold")) & ev,
    }


def evaluate(scored: DataFrame, tuned: dict[str, Tuned], profit: policy.ProfitModel) -> DataFrame:
    """A-3/A-4 for every family and policy, and the unscored baselines once:
    one grouped aggregate."""
    first = F.col(FAMILY) == next(iter(tuned))
    conditions = flags(tuned, profit) | {"fund_all": F.lit(True), "grade_AB": F.col("grade").isin("A", "B")}
    scored = policy.with_gain(scored)
    wide = scored.groupBy(FAMILY).agg(
        F.count(F.lit(1)).alias("rows"), *[a for name, c in conditions.items() for a in policy._policy_aggs(name, c)])
    rows = [F.struct(
        (F.lit(BASELINE) if name in ("fund_all", "grade_AB") else F.col(FAMILY)).alias(FAMILY), F.lit(name).alias("policy"),
        F.col(f"{name}__n").alias("n"), *[F.coalesce(F.col(f"{name}__{k}"), F.lit(0.0)).alias(k) for k in ("capital", "profit", "defaults")])
        for name in conditions]
    long = wide.select(first.alias("first"), "rows", F.explode(F.array(*rows)).alias("p")).select("first", "rows", "p.*")
    return policy.policy_metrics(long.filter((F.col(FAMILY) != BASELINE) | F.col("first")).drop("first"))


def paired_flags(scored: DataFrame, tuned: dict[str, Tuned], profit: policy.ProfitModel, key: str = "loan_id") -> DataFrame:
    """One row a loan: funded_amnt, realized_profit, ``<family>_<policy>`` and
    the baselines, for paired comparisons (the families' rows of a loan meet
    in one aggregate by its key). The rows are small but each is weighed for
    every draw afterwards, so they stay in all shuffle partitions instead of
    being coalesced by their bytes; the aggregate uses the same exchange."""
    scored = policy.with_gain(scored)
    scored = scored.repartition(int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    conditions = flags(tuned, profit)
    return scored.groupBy(key).agg(
        F.first("funded_amnt").alias("funded_amnt"), F.first("realized_profit").alias("realized_profit"),
        F.lit(True).alias("fund_all"), F.first(F.col("grade").isin("A", "B")).alias("grade_AB"),
        *[F.bool_or((F.col(FAMILY) == f) & c).alias(f"{f}_{name}") for f in tuned for name, c in conditions.items()])


def comparisons(first: str, second: str) -> dict[str, tuple[str, str]]:
    """A-9: the five paired comparisons of two families (``first`` leads)."""
    return {
        f"{first}_threshold_vs_fund_all": (f"{first}_threshold", "fund_all"),
        f"{first}_threshold_vs_grade_AB": (f"{first}_threshold", "grade_AB"),
        f"{first}_matched_vs_grade_AB": (f"{first}_matched_to_grade_AB", "grade_AB"),
        f"{second}_matched_vs_grade_AB": (f"{second}_matched_to_grade_AB", "grade_AB"),
        f"{first}_vs_{second}_matched": (f"{first}_matched_to_grade_AB", f"{second}_matched_to_grade_AB"),
    }
