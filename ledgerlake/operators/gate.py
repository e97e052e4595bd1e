"""Champion vs challenger promotion gate (G-1, G-2).

Both bundles' decisions over the same (tuning) rows are unioned with a bundle
tag and evaluated in one ``groupBy(bundle)`` pass; the driver compares two
numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.session import round_half_up


def bundle_returns(decided: DataFrame, bundle_col: str = "bundle") -> DataFrame:
    """G-1: return per dollar of each bundle's funded loans (0.0 if none)."""
    funded = F.col("decision") == "fund"
    sums = decided.groupBy(bundle_col).agg(
        F.sum(F.when(funded, F.col("funded_amnt"))).alias("capital"),
        F.sum(F.when(funded, F.col("realized_profit"))).alias("profit"),
    )
    return sums.select(
        bundle_col,
        F.when(F.coalesce(F.col("capital"), F.lit(0.0)) != 0, F.col("profit") / F.col("capital")).otherwise(F.lit(0.0)).alias("return_per_dollar"),
    )


def promotion_decision(returns: DataFrame, margin: float = C.PROMOTION_MARGIN, candidate: str = "candidate",
                       champion: str = "champion") -> DataFrame:
    """G-2 as a one-row table: promote iff candidate - champion > margin
    (strict); with no champion row the candidate is promoted."""
    cand = F.max(F.when(F.col("bundle") == candidate, F.col("return_per_dollar")))
    champ = F.max(F.when(F.col("bundle") == champion, F.col("return_per_dollar")))
    row = returns.agg(cand.alias("candidate_return"), champ.alias("champion_return"))
    c, h = F.col("candidate_return"), F.col("champion_return")
    improvement = c - h
    promote = F.when(h.isNull(), F.lit(True)).otherwise(improvement > F.lit(margin))

    def fmt(x):
        return F.format_string("%+.5f", round_half_up(x, 5))

    reason = F.when(h.isNull(), F.lit("no model in production yet")).otherwise(
        F.concat(F.lit("candidate "), fmt(c), F.lit(" vs champion "), fmt(h), F.lit(" ("), fmt(improvement),
                 F.lit(", "), F.when(promote, F.lit("above")).otherwise(F.lit("below")), F.lit(f" the {margin} margin)"))
    )
    return row.select(promote.alias("promote"), "candidate_return", "champion_return",
                      F.lit(margin).alias("margin"), reason.alias("reason"))
