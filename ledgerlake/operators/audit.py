"""Group audit (A-10 .. A-12).

All audited columns are aggregated in ONE pass with grouping sets (Spark
expands each row once per set and pre-aggregates map-side, so even a group
holding a third of the rows is reduced before the shuffle). The disparity
summary reads only the small group table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import config as C


def by_group(df: DataFrame, columns=C.FAIRNESS_COLUMNS, min_count: int = C.DEFAULT.min_group_size,
             funded_col: str = "funded", score_col: str = "risk_score") -> DataFrame:
    """A-10: per (column, group): n, fund_rate, mean_score, default_rate,
    default_if_funded (target mean over funded loans only), n_funded."""
    funded = F.col(funded_col)
    cols = list(columns)
    g = df.groupingSets([[c] for c in cols], *cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(funded.cast("double")).alias("fund_rate"),
        F.avg(score_col).alias("mean_score"),
        F.avg(F.col("target").cast("double")).alias("default_rate"),
        F.avg(F.when(funded, F.col("target").cast("double"))).alias("default_if_funded"),
        F.count_if(funded).alias("n_funded"),
        *[F.grouping(c).alias(f"_g_{c}") for c in cols],
    )
    which = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for c in reversed(cols):
        which = F.when(F.col(f"_g_{c}") == 0, F.lit(c)).otherwise(which)
        value = F.when(F.col(f"_g_{c}") == 0, F.col(c).cast("string")).otherwise(value)
    return g.select(
        which.alias("column"), value.alias("group"), "n", "fund_rate", "mean_score",
        "default_rate", "default_if_funded", "n_funded",
    ).filter(F.col("n") >= min_count)


def _pearson(x: str, y: str) -> Column:
    sx, sy = F.stddev_pop(x), F.stddev_pop(y)
    return F.when((F.count(F.lit(1)) > 1) & (sx > 0) & (sy > 0), F.covar_pop(x, y) / (sx * sy))


def disparity(groups: DataFrame, min_funded: int = C.DEFAULT.min_funded_for_error) -> DataFrame:
    """A-11: per column: group count, lowest/highest fund rate with the group
    (ties -> alphabetically first group), spread, default_if_funded range over
    groups with enough funded loans, score-vs-outcome Pearson correlation
    (null when undefined instead of failing)."""
    lo = F.min(F.struct(F.col("fund_rate"), F.col("group")))
    hi = F.min(F.struct((-F.col("fund_rate")).alias("neg"), F.col("group")))
    enough = F.col("n_funded") >= min_funded
    return groups.groupBy("column").agg(
        F.count(F.lit(1)).alias("groups"),
        lo["group"].alias("fund_rate_min_group"),
        lo["fund_rate"].alias("fund_rate_min"),
        hi["group"].alias("fund_rate_max_group"),
        (-hi["neg"]).alias("fund_rate_max"),
        (F.max("fund_rate") - F.min("fund_rate")).alias("fund_rate_spread"),
        F.min(F.when(enough, F.col("default_if_funded"))).alias("default_if_funded_min"),
        F.max(F.when(enough, F.col("default_if_funded"))).alias("default_if_funded_max"),
        _pearson("mean_score", "default_rate").alias("score_vs_outcome_correlation"),
    )


def totals(df: DataFrame, funded_col: str = "funded") -> DataFrame:
    """A-12: loans, overall fund rate, overall default rate among funded."""
    funded = F.col(funded_col)
    return df.agg(
        F.count(F.lit(1)).alias("test_loans"),
        F.avg(funded.cast("double")).alias("overall_fund_rate"),
        F.avg(F.when(funded, F.col("target").cast("double"))).alias("overall_default_if_funded"),
    )
