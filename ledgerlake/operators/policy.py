"""Money: profit model, policy evaluation, threshold curve, threshold choice,
bootstrap comparison and the funding decision (A-1, A-3 .. A-9, P-13 .. P-17).

Scale notes
-----------
* Every policy metric is a conditional sum. All policies are evaluated in ONE
  aggregate (one column set per policy) and unpivoted afterwards, so the data
  is read once however many policies are compared.
* The threshold curve never re-scans per threshold: each row is assigned to
  the first grid point that funds it, one partial aggregate produces at most
  117 buckets, and running sums over the 116-point grid give the curve.
* The bootstrap uses Poisson(1) weights drawn from a hash of (loan, draw): no
  row is moved, copied or multiplied; each task sums its own weighted amounts
  per draw, so the shuffle is draws x tasks small rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.functions.features import contractual_gain, expected_return
from ledgerlake.functions.quantiles import selected_percentiles


@dataclass(frozen=True)
class ProfitModel:
    lgd: float
    prepay_factor: float


def with_gain(df: DataFrame) -> DataFrame:
    return df.withColumn("gain", contractual_gain(F.col("installment"), F.col("term_months"), F.col("funded_amnt")))


def profit_model_frame(train: DataFrame) -> DataFrame:
    """A-1 as a one-row DataFrame: dollar-weighted LGD and prepayment factor."""
    t = F.col("target")
    gain = contractual_gain(F.col("installment"), F.col("term_months"), F.col("funded_amnt"))
    sums = train.agg(
        F.sum(F.when(t == 1, F.col("realized_profit"))).alias("default_profit"),
        F.sum(F.when(t == 1, F.col("funded_amnt"))).alias("default_funded"),
        F.sum(F.when(t == 0, F.col("realized_profit"))).alias("repaid_profit"),
        F.sum(F.when(t == 0, gain)).alias("repaid_gain"),
    )
    return sums.select(
        (-F.col("default_profit") / F.col("default_funded")).alias("lgd"),
        (F.col("repaid_profit") / F.col("repaid_gain")).alias("prepay_factor"),
    )


def fit_profit_model(train: DataFrame) -> ProfitModel:
    row = profit_model_frame(train).first()
    return ProfitModel(lgd=float(row["lgd"]), prepay_factor=float(row["prepay_factor"]))


POLICY_METRICS = (
    "loans_funded", "share_funded", "capital_invested", "total_profit",
    "return_per_dollar", "default_rate_funded",
)


def _policy_aggs(name: str, funded: Column) -> list[Column]:
    f = funded
    return [
        F.count_if(f).alias(f"{name}__n"),
        F.sum(F.when(f, F.col("funded_amnt"))).alias(f"{name}__capital"),
        F.sum(F.when(f, F.col("realized_profit"))).alias(f"{name}__profit"),
        F.sum(F.when(f, F.col("target").cast("double"))).alias(f"{name}__defaults"),
    ]


def evaluate_policies(df: DataFrame, policies: dict[str, Column]) -> DataFrame:
    """A-3/A-4: metrics for many boolean policy columns in one pass.

    Output: one row per policy with the A-3 metrics (return per dollar and
    default rate are 0 when nothing is funded).
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for name, funded in policies.items():
        aggs += _policy_aggs(name, funded)
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(name).alias("policy"),
            F.col(f"{name}__n").alias("n"),
            F.coalesce(F.col(f"{name}__capital"), F.lit(0.0)).alias("capital"),
            F.coalesce(F.col(f"{name}__profit"), F.lit(0.0)).alias("profit"),
            F.coalesce(F.col(f"{name}__defaults"), F.lit(0.0)).alias("defaults"),
        )
        for name in policies
    ]
    long = wide.select(F.col("__rows").alias("rows"), F.explode(F.array(*rows)).alias("p")).select("rows", "p.*")
    return policy_metrics(long, total_col="rows")


def policy_metrics(sums: DataFrame, total_col: str = "rows") -> DataFrame:
    """A-3 from sums (n, capital, profit, defaults, total rows)."""
    n = F.col("n")
    return sums.select(
        *[c for c in sums.columns if c not in ("n", "capital", "profit", "defaults", total_col)],
        n.cast("bigint").alias("loans_funded"),
        F.coalesce(F.try_divide(n.cast("double"), F.col(total_col)), F.lit(0.0)).alias("share_funded"),
        F.col("capital").alias("capital_invested"),
        F.col("profit").alias("total_profit"),
        F.when(F.col("capital") != 0, F.col("profit") / F.col("capital")).otherwise(F.lit(0.0)).alias("return_per_dollar"),
        F.when(n > 0, F.col("defaults") / n).otherwise(F.lit(0.0)).alias("default_rate_funded"),
    )


def grid_value(k: Column) -> Column:
    return (F.lit(C.THRESHOLD_GRID_START_MILLI) + F.lit(C.THRESHOLD_GRID_STEP_MILLI) * k).cast("double") / F.lit(1000.0)


def first_funding_grid_index(score: Column) -> Column:
    """Smallest grid index k with score < t_k (116 when no grid point funds).

    A floating estimate is corrected against the exact grid values, so the
    bucket equals the naive comparison row by row.
    """
    est = F.floor((score * 1000.0 - C.THRESHOLD_GRID_START_MILLI) / C.THRESHOLD_GRID_STEP_MILLI) + 1
    fixed = (
        F.when(grid_value(est - 1) > score, est - 1)
        .when(grid_value(est) <= score, est + 1)
        .otherwise(est)
    )
    return F.least(F.greatest(fixed, F.lit(0)), F.lit(C.THRESHOLD_GRID_POINTS)).cast("int")


def threshold_curve(df: DataFrame, score_col: str = "risk_score") -> DataFrame:
    """A-5: the A-3 metrics of 'fund when score < t' for every grid t."""
    from pyspark.sql import Window

    spark = df.sparkSession
    never = F.lit(C.THRESHOLD_GRID_POINTS)
    buckets = df.groupBy(
        F.coalesce(first_funding_grid_index(F.col(score_col)), never).alias("k")
    ).agg(
        F.count(F.lit(1)).alias("b_n"),
        F.sum("funded_amnt").alias("b_capital"),
        F.sum("realized_profit").alias("b_profit"),
        F.sum(F.col("target").cast("double")).alias("b_defaults"),
    )
    grid = spark.range(C.THRESHOLD_GRID_POINTS).select(F.col("id").cast("int").alias("k"))
    # Both sides are bounded by the grid size (<= 117 rows), whatever the data size.
    joined = grid.join(F.broadcast(buckets), "k", "full").select(
        "k", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("b_n", "b_capital", "b_profit", "b_defaults")]
    )
    everything = Window.partitionBy()
    run = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = joined.select(
        "k",
        grid_value(F.col("k")).alias("threshold"),
        F.sum("b_n").over(everything).alias("rows"),
        F.sum("b_n").over(run).alias("n"),
        F.sum("b_capital").over(run).alias("capital"),
        F.sum("b_profit").over(run).alias("profit"),
        F.sum("b_defaults").over(run).alias("defaults"),
    ).filter(F.col("k") < C.THRESHOLD_GRID_POINTS).drop("k")
    return policy_metrics(sums, total_col="rows")


def choose_threshold_frame(curve: DataFrame, objective: str = "return_per_dollar",
                           min_share: float = C.MIN_SHARE_FUNDED) -> DataFrame:
    """A-6: best objective among usable rows; ties go to the lowest threshold."""
    from ledgerlake.session import round_half_up

    # Objectives equal to 1e-10 are ties (summation order must not decide).
    return curve.filter(F.col("share_funded") >= min_share).orderBy(
        round_half_up(F.col(objective), 10).desc(), F.col("threshold").asc()
    ).limit(1)


def choose_threshold(curve: DataFrame, objective: str = "return_per_dollar",
                     min_share: float = C.MIN_SHARE_FUNDED) -> float:
    row = choose_threshold_frame(curve, objective, min_share).first()
    if row is None:
        raise ValueError("no threshold funds the minimum share of loans")
    return float(row["threshold"])


def grade_ab_share(df: DataFrame) -> float:
    """A-8 (second half): share of grade A/B loans."""
    return float(df.agg(F.avg(F.col("grade").isin("A", "B").cast("double"))).first()[0])


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """A-7 core: exact linear-interpolated quantile (numpy 'linear') by
    selection: only the values around the wanted rank are ordered."""
    return selected_percentiles(df, {"x": F.col(col)}, [q])["x", q]


def threshold_for_share(df: DataFrame, share: float, score_col: str = "risk_score") -> float:
    """A-7: the score cut-off that funds ``share`` of the loans."""
    if not 0 < share <= 1:
        raise ValueError(f"share must be in (0, 1], got {share}")
    return exact_quantile(df, score_col, share)


def risk_at_threshold(df: DataFrame, threshold: float, score_col: str = "risk_score",
                      prob_col: str = "probability_of_default") -> float:
    """A-8: largest calibrated probability among funded loans (0 if none)."""
    v = df.agg(F.max(F.when(F.col(score_col) < threshold, F.col(prob_col)))).first()[0]
    return 0.0 if v is None else float(v)


def decide(df: DataFrame, threshold: float, profit: ProfitModel, amount_col: str = "loan_amnt",
           score_col: str = "risk_score", prob_col: str = "probability_of_default") -> DataFrame:
    """P-17: fund iff score < threshold AND expected return > 0, with the basis."""
    amount = F.col(amount_col)
    gain = contractual_gain(F.col("installment"), F.col("term_months").cast("double"), amount)
    ev = expected_return(F.col(prob_col), gain, amount, profit.lgd, profit.prepay_factor)
    above = F.col(score_col) >= F.lit(threshold)
    df = df.withColumn("expected_return_usd", ev)
    negative = F.col("expected_return_usd") <= 0
    return df.withColumns(
        {
            "decision": F.when(above | negative, F.lit("decline")).otherwise(F.lit("fund")),
            "decision_basis": F.when(above, F.lit("score_above_threshold"))
            .when(negative, F.lit("negative_expected_return"))
            .otherwise(F.lit("score_below_threshold")),
        }
    )


# --- A-9 bootstrap -----------------------------------------------------------

def _poisson_cdf(kmax: int) -> list[float]:
    import math

    out, acc = [], 0.0
    for k in range(kmax + 1):
        acc += math.exp(-1.0) / math.factorial(k)
        out.append(acc)
    return out


# A 32-bit uniform cannot resolve tail mass below 2**-32, reached at k = 13.
POISSON_KMAX = 13


def uniform_from_hash(key: Column) -> Column:
    """u in [0,1) from the first 32 bits of md5(key)."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


# Prime modulus of the per-draw sequence (2**31 - 1): all products stay exact in BIGINT.
DRAW_MODULUS = 2147483647


def draw_seeds(key: Column) -> tuple[Column, Column]:
    """Two per-loan integers from ONE md5: start s in [0, M) and step t in [1, M)."""
    h = F.md5(key)
    s = F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(DRAW_MODULUS))
    t = F.pmod(F.conv(F.substring(h, 9, 8), 16, 10).cast("long"), F.lit(DRAW_MODULUS - 1)) + 1
    return s, t


def draw_uniform(s: Column, t: Column, draw: Column) -> Column:
    """u_d = ((s + d*t) mod M) / M. For a random (s, t) the pair (u_d, u_e) of
    two different draws is uniform on the unit square, so draws are pairwise
    independent across loans; only one hash per loan is computed."""
    return F.pmod(s + draw.cast("long") * t, F.lit(DRAW_MODULUS)).cast("double") / F.lit(float(DRAW_MODULUS))


def poisson_weight(u: Column) -> Column:
    """Inverse CDF of Poisson(1) at u."""
    cdf = _poisson_cdf(POISSON_KMAX)
    expr = F.lit(POISSON_KMAX + 1)
    for k in reversed(range(POISSON_KMAX + 1)):
        expr = F.when(u < F.lit(cdf[k]), F.lit(k)).otherwise(expr)
    return expr


def bootstrap_differences(df: DataFrame, comparisons: dict[str, tuple[str, str]], draws: int,
                          seed: int, key_col: str = "loan_id") -> DataFrame:
    """A-9: per-draw return difference for each comparison (a vs b).

    ``comparisons`` maps a name to two boolean columns of ``df``. The result
    has one row per (comparison, draw). A task makes the weights of its loans
    (numpy, one batch and draw at a time) and sums them into draws x policies
    numbers: no row is multiplied by the draws, and each task sends one row a
    draw into the shuffle. A null amount or flag counts as zero."""
    import numpy as np
    import pyarrow as pa

    policies = sorted({c for pair in comparisons.values() for c in pair})
    s, t = draw_seeds(F.concat_ws("-", F.lit(str(seed)), F.col(key_col)))
    funded = lambda p, amount: F.coalesce(F.when(F.col(p), F.col(amount).cast("double")), F.lit(0.0))
    values = [funded(p, amount) for p in policies for amount in ("funded_amnt", "realized_profit")]
    seeded = df.select(s.alias("s"), t.alias("t"), F.array(*values).alias("v"))
    cdf, width = np.array(_poisson_cdf(POISSON_KMAX)), len(values)

    def weight(x):
        return np.searchsorted(cdf, x / float(DRAW_MODULUS), side="right").astype(np.float64)

    def run(batches):
        # weights by the leading 16 bits of the draw's number; the few ranges that hold a step of the distribution are looked up
        low = np.arange(1 << 16, dtype=np.int64) << 15
        table = weight(low)
        step = table != weight(low + (1 << 15) - 1)
        total = np.zeros((draws, width))
        seen = False
        for b in batches:
            seen = seen or b.num_rows > 0
            x, t = b.column(0).to_numpy().copy(), b.column(1).to_numpy()
            v = b.column(2).flatten().to_numpy().reshape(-1, width)
            for d in range(draws):  # x is (s + d * t) mod M
                at = x >> 15
                w = table[at]
                if len(odd := np.flatnonzero(step[at])):
                    w[odd] = weight(x[odd])
                total[d] += w @ v
                x += t
                x[x >= DRAW_MODULUS] -= DRAW_MODULUS
        if seen:
            flat = pa.array(total.ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(draws, dtype=np.int32)), pa.ListArray.from_arrays(np.arange(0, total.size + 1, width, dtype=np.int32), flat)],
                names=["draw", "sums"])

    parts = seeded.mapInArrow(run, "draw int, sums array<double>")
    per_draw = parts.groupBy("draw").agg(*[F.sum(F.col("sums")[i]).alias(f"v{i}") for i in range(width)])

    def ret(pol: str) -> Column:
        i = 2 * policies.index(pol)
        return F.when(F.col(f"v{i}") != 0, F.col(f"v{i + 1}") / F.col(f"v{i}")).otherwise(F.lit(0.0))

    rows = [
        F.struct(F.lit(name).alias("comparison"), (ret(a) - ret(b)).alias("difference"))
        for name, (a, b) in comparisons.items()
    ]
    return per_draw.select("draw", F.explode(F.array(*rows)).alias("c")).select("c.comparison", "draw", "c.difference")


def bootstrap_summary(diffs: DataFrame) -> DataFrame:
    """Mean, 2.5/97.5 percentiles (linear) and P(difference > 0)."""
    d = F.col("difference")
    return diffs.groupBy("comparison").agg(
        F.avg(d).alias("mean_difference"),
        F.percentile(d, F.lit(0.025)).alias("ci_low"),
        F.percentile(d, F.lit(0.975)).alias("ci_high"),
        F.avg((d > 0).cast("double")).alias("prob_better"),
        F.count(F.lit(1)).alias("draws"),
    )
