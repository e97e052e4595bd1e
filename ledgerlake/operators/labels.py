"""Labels and the filters that make them honest (C-1, F-1 .. F-4, P-9 .. P-11, P-18)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.functions.features import credit_policy_columns, derive_features


#: Unclassified statuses that the error message names (any one raises).
STATUSES_NAMED = 50


def status_classes(df: DataFrame) -> DataFrame:
    """Distinct cleaned statuses with their class (C-1 input).

    ``status_clean`` is low-cardinality: the distinct is a map-side partial
    aggregate, so only a handful of rows per partition are shuffled.
    """
    s = F.col("status_clean")
    cls = (
        F.when(s.isin(*C.POSITIVE_STATUSES), F.lit("positive"))
        .when(s.isin(*C.NEGATIVE_STATUSES), F.lit("negative"))
        .when(s.isin(*C.DROP_STATUSES), F.lit("drop"))
        .when(s.isNull(), F.lit("null"))
        .otherwise(F.lit("unclassified"))
    )
    # Group on the raw status first (partial aggregate over the scan), then
    # clean the few distinct values: the cleaning never runs per row.
    distinct_raw = df.groupBy("loan_status").agg(F.count(F.lit(1)).alias("loans"))
    return (
        credit_policy_columns(distinct_raw)
        .groupBy("status_clean")
        .agg(F.sum("loans").alias("loans"))
        .withColumn("classification", cls)
    )


def assert_statuses_classified(df: DataFrame) -> None:
    """C-1: raise on any status that is not classified (nulls allowed)."""
    # The count is part of the condition, so the filter stays above the
    # aggregates: on the class alone it would be evaluated on every raw row.
    unclassified = status_classes(df).filter(
        F.when(F.col("loans") > 0, F.col("classification")) == "unclassified")
    bad = [r["status_clean"] for r in unclassified.orderBy("status_clean").limit(STATUSES_NAMED).collect()]
    if bad:
        raise ValueError(f"unclassified loan_status values: {bad}")


def prepared_predicate(p: C.Params = C.DEFAULT):
    """F-1 .. F-3 as one predicate over derived + flagged rows."""
    cond = (
        F.col("status_clean").isin(*(C.POSITIVE_STATUSES + C.NEGATIVE_STATUSES))
        & F.col("term_months").isin(*p.terms_months)
        & (F.col("issue_date") >= F.lit(p.min_issue_date).cast("date"))
        & (F.col("issue_date") <= F.lit(p.max_issue_date).cast("date"))
    )
    if not p.keep_credit_policy_loans:
        cond = cond & ~F.col("not_credit_policy")
    return cond


def transform(raw: DataFrame, p: C.Params = C.DEFAULT, check_statuses: bool = True) -> DataFrame:
    """Raw loans -> prepared loans (derive, flag, label, maturity window)."""
    if check_statuses:
        assert_statuses_classified(raw)
    df = credit_policy_columns(derive_features(raw)).filter(prepared_predicate(p))
    return df.withColumns(
        {
            "target": F.col("status_clean").isin(*C.POSITIVE_STATUSES).cast("tinyint"),
            "realized_profit": F.col("total_pymnt") - F.col("funded_amnt"),
        }
    )


def prepared_columns(df: DataFrame, extra: tuple[str, ...] = ("loan_id", "grade_idx")) -> DataFrame:
    """P-12 allowlist projection, stable order, no duplicates."""
    keep = [c for c in C.ALLOWLIST if c in df.columns] + list(C.DERIVED) + list(C.OUTCOME)
    keep = list(dict.fromkeys(keep))
    return df.select(*[c for c in extra if c in df.columns], *keep)


def production_frame(raw: DataFrame, p: C.Params = C.DEFAULT) -> DataFrame:
    """F-4 + P-18: production window, unlabelled rows kept, batch key attached."""
    df = credit_policy_columns(derive_features(raw))
    return df.filter(
        F.col("term_months").isin(*p.terms_months)
        & (F.col("issue_date") >= F.lit(p.production.start).cast("date"))
        & (F.col("issue_date") <= F.lit(p.production.end).cast("date"))
    ).withColumns(
        {
            "batch": F.date_format("issue_date", "yyyy-MM"),
            "outcome_known": F.col("status_clean").isin(*C.RESOLVED_STATUSES),
        }
    )
