"""Profiles of the loan data (A-13 .. A-23).

Each profile is one aggregate (several tables are unpivoted first so that
many columns share one group-by). Where a statistic needs a value from a first
pass (histogram edges), that pass returns a few numbers to the driver and the
second pass uses them as literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.functions.features import expected_installment
from ledgerlake.functions.quantiles import selected_percentiles

DESCRIBE_COLUMNS = ("annual_inc", "loan_amnt", "dti", "revol_util", "fico_mid", "credit_history_months")
CATEGORY_COLUMNS = ("purpose", "home_ownership", "verification_status", "initial_list_status")


def unpivot(df: DataFrame, columns, value_type: str = "double", keep=()) -> DataFrame:
    """(column, value) long form of ``columns`` (one explode, no join)."""
    structs = [F.struct(F.lit(c).alias("column"), F.col(c).cast(value_type).alias("value")) for c in columns]
    return df.select(*keep, F.explode(F.array(*structs)).alias("_kv")).select(*keep, "_kv.column", "_kv.value")


def monthly_summary(scored: DataFrame) -> DataFrame:
    """A-13: loans, outcome-known share, fund rate, mean probability per batch."""
    return scored.groupBy("batch").agg(
        F.count(F.lit(1)).alias("loans"),
        F.avg(F.col("outcome_known").cast("double")).alias("outcome_known"),
        F.avg((F.col("decision") == "fund").cast("double")).alias("fund_rate"),
        F.avg("probability_of_default").alias("mean_probability"),
    )


def status_counts(raw: DataFrame) -> DataFrame:
    """A-14: loans per raw status (report order: descending count)."""
    return raw.groupBy("loan_status").agg(F.count(F.lit(1)).alias("loans"))


def funnel(raw_with_status: DataFrame, prepared_count_col: str = "_prepared") -> DataFrame:
    """A-15: nested counts in one aggregate, unpivoted to (step, loans)."""
    term36 = F.col("term").contains("36")
    known = F.col("status_clean").isin(*C.RESOLVED_STATUSES)
    wide = raw_with_status.agg(
        F.count(F.lit(1)).alias("s1"),
        F.count_if(term36).alias("s2"),
        F.count_if(term36 & known).alias("s3"),
        F.count_if(F.col(prepared_count_col)).alias("s4"),
    )
    steps = [("1", "all loans", "s1"), ("2", "36-month term", "s2"), ("3", "+ known outcome", "s3"),
             ("4", "+ matured", "s4")]
    structs = [F.struct(F.lit(int(o)).alias("step_order"), F.lit(s).alias("step"), F.col(c).alias("loans")) for o, s, c in steps]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def maturity_by_year(features: DataFrame) -> DataFrame:
    """A-16: finished 36-month loans and their default rate by issue year."""
    known = F.col("status_clean").isin(*C.RESOLVED_STATUSES)
    return (
        features.filter(F.col("term").contains("36") & known)
        .groupBy(F.year("issue_date").alias("year"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col("status_clean").isin(*C.POSITIVE_STATUSES).cast("double")).alias("default_rate"),
        )
    )


def risk_by_grade(prepared: DataFrame) -> DataFrame:
    """A-18."""
    return prepared.groupBy("grade").agg(
        F.count(F.lit(1)).alias("loans"),
        F.avg(F.col("target").cast("double")).alias("default_rate"),
        F.avg("int_rate").alias("avg_int_rate"),
        F.avg("realized_profit").alias("avg_profit"),
    )


def null_shares(df: DataFrame, columns) -> DataFrame:
    """A-19: null share per column (one aggregate), only those > 0."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    structs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("null_share")) for c in columns]
    return shares.select(F.explode(F.array(*structs)).alias("s")).select("s.*").filter(F.col("null_share") > 0)


def describe(df: DataFrame, columns=DESCRIBE_COLUMNS) -> DataFrame:
    """A-20: count, null_count, mean, sample std, min, quartiles (exact,
    linear interpolation), max per column.

    Quartiles come by selection; all moments of all columns are one aggregate
    over the unmultiplied rows.
    """
    quartiles = {0.25: "q25", 0.5: "median", 0.75: "q75"}
    found = selected_percentiles(df, {c: F.col(c) for c in columns}, list(quartiles))
    aggs = {
        "count": F.count, "null_count": lambda v: F.count_if(v.isNull()), "mean": F.avg, "std": F.stddev_samp,
        "min": F.min, "max": F.max,
    }
    one = df.agg(*[f(F.col(c).cast("double")).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in aggs.items()])
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{name}{i}").alias(name) for name in aggs],
                 *[F.lit(found[c, q]).cast("double").alias(name) for q, name in quartiles.items()])
        for i, c in enumerate(columns)
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*").select(
        "column", "count", "null_count", "mean", "std", "min", "q25", "median", "q75", "max",
    )


def category_profile(prepared: DataFrame, columns=CATEGORY_COLUMNS) -> DataFrame:
    """A-21: levels per column with loans and default rate."""
    structs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in columns]
    long = prepared.select("target", F.explode(F.array(*structs)).alias("s")).select("target", "s.*")
    return long.groupBy("column", "level").agg(
        F.count(F.lit(1)).alias("loans"),
        F.avg(F.col("target").cast("double")).alias("default_rate"),
    )


def histograms(prepared: DataFrame, columns=DESCRIBE_COLUMNS, bins: int = 50, profit_bins: int = 60) -> DataFrame:
    """A-22: equal-width histogram tables over the full data.

    Six numeric columns (series 'all') and realized profit split by outcome
    (series 'repaid'/'defaulted', density normalised per series). The first
    pass returns min/max per column (a few numbers); the second buckets and
    counts in one aggregate.
    """
    profit_series = F.when(F.col("target") == 1, F.lit("defaulted")).otherwise(F.lit("repaid"))
    specs = [(c, F.lit("all"), bins) for c in columns] + [("realized_profit", profit_series, profit_bins)]
    structs = [
        F.struct(F.lit(c).alias("column"), s.alias("series"), F.col(c).cast("double").alias("value"), F.lit(b).alias("nb"))
        for c, s, b in specs
    ]
    long = prepared.select(F.explode(F.array(*structs)).alias("s")).select("s.*").filter(F.col("value").isNotNull())
    edges = {r["column"]: (r["lo"], r["hi"]) for r in long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
    lo = F.lit(None).cast("double")
    hi = F.lit(None).cast("double")
    for c, (a, b) in edges.items():
        lo = F.when(F.col("column") == c, F.lit(float(a))).otherwise(lo)
        hi = F.when(F.col("column") == c, F.lit(float(b))).otherwise(hi)
    width = (F.col("hi") - F.col("lo")) / F.col("nb")
    b_idx = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("nb")), F.col("nb") - 1)
    ).cast("int")
    counted = (
        long.withColumns({"lo": lo, "hi": hi})
        .groupBy("column", "series", "nb", "lo", "hi", b_idx.alias("bin"))
        .agg(F.count(F.lit(1)).alias("loans"))
    )
    from pyspark.sql import Window

    per_series = Window.partitionBy("column", "series")
    return counted.select(
        "column", "series", "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        "loans",
        (F.col("loans") / (F.sum("loans").over(per_series) * F.when(width > 0, width).otherwise(F.lit(1.0)))).alias("density"),
    )


def installment_consistency(df: DataFrame) -> DataFrame:
    """A-23: loans whose stated installment is off the amortisation formula."""
    sched = expected_installment(F.col("loan_amnt"), F.col("int_rate"), F.col("term_months").cast("double"))
    off = F.abs(F.col("installment") / sched - 1)
    return df.agg(
        F.count(F.lit(1)).alias("loans"),
        F.count_if(off > 0.01).alias("off_by_1pct"),
        F.count_if(off > 0.05).alias("off_by_5pct"),
        F.avg((off > 0.01).cast("double")).alias("share_off_1pct"),
        F.avg((off > 0.05).cast("double")).alias("share_off_5pct"),
    )
