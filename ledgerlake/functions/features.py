"""Row-level derivations (P-1 .. P-12, P-18, P-19).

Every expression reads only the row's own values, so they are narrow
transformations: no shuffle, fused into one whole-stage-codegen span with the
scan. One shared ``derive_features`` is used by training, scoring and
monitoring, so the three can never disagree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import config as C


def term_months(term: Column) -> Column:
    """P-1: ' 36 months' -> 36."""
    return F.substring(F.trim(term), 1, 2).cast("short")


def emp_length_years(emp: Column) -> Column:
    """P-2: '10+' -> 10, '< 1' -> 0, else the first digit run; 'n/a'/null -> null.

    ``regexp_extract`` yields '' on no match, so the cast is a ``try_cast``.
    """
    digits = F.regexp_extract(emp, r"(\d+)", 1)
    return (
        F.when(emp.contains("10+"), F.lit(10))
        .when(emp.contains("< 1"), F.lit(0))
        .otherwise(F.nullif(digits, F.lit("")).try_cast("tinyint"))
        .cast("tinyint")
    )


def month_date(s: Column) -> Column:
    """P-3: 'Jun-2013' -> 2013-06-01 (strict: malformed text fails under ANSI)."""
    return F.to_date(s, "MMM-yyyy")


def try_month_date(s: Column) -> Column:
    """P-3 on requests: the same, but malformed text gives null."""
    return F.try_to_date(s, "MMM-yyyy")


def positive_ratio(num: Column, den: Column) -> Column:
    """P-6/P-7 guard: the ratio only when the denominator is > 0, else null."""
    return F.when(den > 0, num / den)


def derive_features(df: DataFrame, strict_dates: bool = True) -> DataFrame:
    """P-1 .. P-8 on raw loan rows (or on requests renamed by P-19, whose
    malformed months are null: ``strict_dates=False``)."""
    to_month = month_date if strict_dates else try_month_date
    issue_date = to_month(F.col("issue_d"))
    earliest = to_month(F.col("earliest_cr_line"))
    return df.withColumns(
        {
            "term_months": term_months(F.col("term")),
            "emp_length_years": emp_length_years(F.col("emp_length")),
            "issue_date": issue_date,
            "earliest_cr_date": earliest,
        }
    ).withColumns(
        {
            "fico_mid": (F.col("fico_range_low") + F.col("fico_range_high")) / 2,
            "credit_history_months": F.datediff("issue_date", "earliest_cr_date").cast("double")
            / F.lit(C.DAYS_PER_MONTH),
            "loan_to_income": positive_ratio(F.col("loan_amnt"), F.col("annual_inc")),
            "installment_to_income": positive_ratio(F.col("installment") * 12, F.col("annual_inc")),
            "dti": F.when(F.col("dti") >= C.DTI_SENTINEL, F.lit(None)).otherwise(F.col("dti")),
        }
    )


def remove_first(s: Column, literal: str) -> Column:
    """Remove the first occurrence of ``literal`` (not every occurrence)."""
    pos = F.instr(s, literal)
    return F.when(
        pos > 0,
        F.concat(s.substr(F.lit(1), pos - 1), s.substr(pos + len(literal), F.lit(1 << 30))),
    ).otherwise(s)


def credit_policy_columns(df: DataFrame) -> DataFrame:
    """P-9: flag and clean the 'Does not meet the credit policy' statuses."""
    return df.withColumns(
        {
            "not_credit_policy": F.col("loan_status").startswith(C.CREDIT_POLICY_STARTS),
            "status_clean": remove_first(F.col("loan_status"), C.CREDIT_POLICY_PREFIX),
        }
    )


def contractual_gain(installment: Column, term: Column, funded: Column) -> Column:
    """P-13: interest if every scheduled payment were made."""
    return installment * term - funded


def expected_return(p: Column, gain: Column, funded: Column, lgd: float, prepay: float) -> Column:
    """P-14: (1-p)*gain*prepay - p*lgd*funded."""
    return (F.lit(1.0) - p) * gain * F.lit(prepay) - p * F.lit(lgd) * funded


def breakeven_probability(gain: Column, funded: Column, lgd: float, prepay: float) -> Column:
    """P-15: gain/(gain+loss), null where the denominator is 0."""
    g = gain * F.lit(prepay)
    return F.try_divide(g, g + F.lit(lgd) * funded)


def expected_installment(principal: Column, annual_rate_pct: Column, term: Column) -> Column:
    """P-16: amortised payment P*r/(1-(1+r)^-n), P/n when r = 0, null where
    the divisor is 0 (no term)."""
    r = annual_rate_pct / F.lit(1200.0)
    return F.when(r == 0, F.try_divide(principal, term)).otherwise(
        F.try_divide(principal * r, F.lit(1.0) - F.pow(F.lit(1.0) + r, -term))
    )


def model_frame(df: DataFrame) -> DataFrame:
    """P-12: model inputs in fixed order, booleans as double."""
    cols = []
    for c in C.feature_columns():
        cols.append(F.col(c).cast("double").alias(c) if c in C.BOOLEAN else F.col(c))
    return df.select(*cols)


def applications_to_loans(apps: DataFrame) -> DataFrame:
    """P-19: request fields -> raw loan columns (same derivation afterwards)."""
    return apps.withColumnRenamed("application_date", "issue_d").withColumn(
        "term", F.concat(F.lit(" "), F.col("term_months").cast("string"), F.lit(" months"))
    ).drop("term_months")
