"""Registered queries: data contract (C-1 .. C-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.operators import contract, labels, splits
from ledgerlake.plans import oracle_sql as S
from ledgerlake.plans.registry import ratio, register
from ledgerlake.plans.stages import Stages

P = C.DEFAULT
_q = S._q


# --- C-1 --------------------------------------------------------------------------

def _sql_status_guard():
    return S.with_ctes(S.LOANS, S.FEATURES, select=f"""
SELECT status_clean, count(*) AS loans,
  CASE WHEN status_clean IN ({_q(C.POSITIVE_STATUSES)}) THEN 'positive'
       WHEN status_clean IN ({_q(C.NEGATIVE_STATUSES)}) THEN 'negative'
       WHEN status_clean IN ({_q(C.DROP_STATUSES)}) THEN 'drop'
       WHEN status_clean IS NULL THEN 'null' ELSE 'unclassified' END AS classification
FROM features GROUP BY status_clean""")


@register("status_guard", _sql_status_guard)
def q_status_guard(spark, sf_dir):
    """C-1: every cleaned status with its class (the guard raises on 'unclassified')."""
    st = Stages(spark, sf_dir)
    return labels.status_classes(st.raw).select("status_clean", "loans", "classification")


# --- C-2 --------------------------------------------------------------------------

_SQL_RULES = [
    ("target", "isin_0_1", "NOT (target IN (0, 1))"),
    ("loan_amnt", "in_range_500_40000", "NOT (loan_amnt BETWEEN 500 AND 40000)"),
    ("int_rate", "in_range_0_40", "NOT (int_rate BETWEEN 0 AND 40)"),
    ("installment", "gt_0", "NOT (installment > 0)"),
    ("grade", "isin_A_G", f"NOT (grade IN ({_q(C.GRADES)}))"),
    ("annual_inc", "ge_0", "NOT (annual_inc >= 0)"),
    ("dti", "lt_999", "NOT (dti < 999)"),
    ("fico_mid", "in_range_600_900", "NOT (fico_mid BETWEEN 600 AND 900)"),
    ("term_months", "eq_36", "NOT (term_months = 36)"),
] + [(name, "not_null", f"{name} IS NULL") for name, _, nullable in contract.PROCESSED_TYPES if not nullable]


def _sql_schema_violations():
    parts = [
        f"SELECT split, '{col}' AS \"column\", '{rule}' AS rule, count(*) FILTER (WHERE coalesce({pred}, FALSE)) AS violations "
        f"FROM splits WHERE split <> 'unused' GROUP BY split"
        for col, rule, pred in _SQL_RULES
    ]
    return S.with_ctes(*S.base(P)[:4], select=" UNION ALL ".join(parts))


@register("schema_violations", _sql_schema_violations)
def q_schema_violations(spark, sf_dir):
    """C-2: (split, column, rule, violations) from one aggregate pass."""
    st = Stages(spark, sf_dir)
    df = st.with_split.filter(F.col("split") != "unused")
    return contract.schema_violations(df, "split")


# --- C-4 --------------------------------------------------------------------------

def _sql_missingness():
    cand = list(C.SKEWED_AMOUNT) + list(C.NUMERIC) + list(C.NUMERIC_WITH_INDICATOR) + list(C.NOMINAL)
    listed = cand + list(C.STRUCTURAL_MISSING)
    parts = []
    for c in listed:
        ex = "TRUE" if c in C.STRUCTURAL_MISSING else "FALSE"
        share = f"avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END)"
        parts.append(
            f"SELECT '{c}' AS \"column\", {S.rhu(share, 6)} AS null_share, {ex} AS exempt, "
            f"(NOT {ex}) AND {share} > {C.MAX_MISSING_FRACTION}e0 AS too_empty FROM splits WHERE split = 'train'"
        )
    return S.with_ctes(*S.base(P)[:4], select=" UNION ALL ".join(parts))


@register("missingness", _sql_missingness)
def q_missingness(spark, sf_dir):
    """C-4: null share per candidate column on train, exemption, verdict."""
    st = Stages(spark, sf_dir)
    m = contract.missingness(st.train)
    return m.select("column", ratio("null_share"), "exempt", "too_empty")


# --- C-5 --------------------------------------------------------------------------

def _sql_quarantine():
    def present(c):
        return f"{c} IS NOT NULL"

    r = "int_rate/1200e0"
    sched = f"(CASE WHEN {r} = 0 THEN loan_amnt/term_months ELSE loan_amnt*{r}/(1e0 - power(1e0 + {r}, -term_months)) END)"
    rules = [
        ("loan_amnt", f"NOT ({present('loan_amnt')} AND loan_amnt > 0 AND loan_amnt <= 40000)"),
        ("term_months", f"NOT ({present('term_months')} AND term_months = 36)"),
        ("int_rate", f"NOT ({present('int_rate')} AND int_rate > 0 AND int_rate <= 40)"),
        ("installment", f"NOT ({present('installment')} AND installment > 0)"),
        ("grade", f"NOT ({present('grade')} AND grade IN ({_q(C.GRADES)}))"),
        ("sub_grade", f"NOT ({present('sub_grade')} AND regexp_matches(sub_grade, '{C.SUB_GRADE_PATTERN}'))"),
        ("purpose", f"NOT ({present('purpose')} AND purpose IN ({_q(C.PURPOSE_LEVELS)}))"),
        ("initial_list_status", f"NOT ({present('initial_list_status')} AND initial_list_status IN ({_q(C.INITIAL_LIST_LEVELS)}))"),
        ("application_date", f"NOT ({present('application_date')} AND regexp_matches(application_date, '{C.MONTH_PATTERN}'))"),
        ("annual_inc", f"NOT ({present('annual_inc')} AND annual_inc >= 0)"),
        ("emp_length", f"NOT (emp_length IS NULL OR emp_length IN ({_q(C.EMP_LENGTH_LEVELS)}))"),
        ("home_ownership", f"NOT ({present('home_ownership')} AND home_ownership IN ({_q(C.HOME_OWNERSHIP_LEVELS)}))"),
        ("verification_status", f"NOT ({present('verification_status')} AND verification_status IN ({_q(C.VERIFICATION_LEVELS)}))"),
        ("addr_state", f"NOT ({present('addr_state')} AND regexp_matches(addr_state, '{C.STATE_PATTERN}'))"),
        ("earliest_cr_line", f"NOT ({present('earliest_cr_line')} AND regexp_matches(earliest_cr_line, '{C.MONTH_PATTERN}'))"),
        ("fico_range_low", f"NOT ({present('fico_range_low')} AND fico_range_low BETWEEN 300 AND 900)"),
        ("fico_range_high", f"NOT ({present('fico_range_high')} AND fico_range_high BETWEEN 300 AND 900)"),
    ]
    for name in ("delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "total_acc", "acc_now_delinq"):
        rules.append((name, f"NOT ({present(name)} AND {name} >= 0)"))
    for name in ("application_date", "earliest_cr_line"):
        rules.append((f"{name}_invalid", f"regexp_matches({name}, '{C.MONTH_PATTERN}') AND try_strptime({name}, '%b-%Y') IS NULL"))
    rules += [
        ("fico_range_order", "fico_range_high < fico_range_low"),
        ("addr_state_not_us", f"NOT (addr_state IN ({_q(C.US_STATES)}))"),
        ("installment_inconsistent", f"abs(installment / {sched} - 1) > {C.INSTALLMENT_TOLERANCE}e0"),
    ]
    reasons = ", ".join(f"CASE WHEN coalesce({pred}, FALSE) THEN '{code}' END" for code, pred in rules)
    return S.with_ctes(
        S.LOANS,
        "apps AS (SELECT * EXCLUDE (issue_d), issue_d AS application_date, CAST(substr(trim(term), 1, 2) AS INTEGER) AS term_months FROM loans)",
        f"q AS (SELECT loan_id, concat_ws(';', {reasons}) AS reasons FROM apps)",
        select="SELECT loan_id, reasons = '' AS accepted, reasons FROM q",
    )


@register("application_quarantine", _sql_quarantine)
def q_quarantine(spark, sf_dir):
    """C-5 + P-16: every loan validated as a request; reasons joined in rule order."""
    st = Stages(spark, sf_dir)
    q = contract.quarantine(contract.loans_as_applications(st.raw))
    return q.select("loan_id", "accepted", F.concat_ws(";", "reasons").alias("reasons"))


# --- C-6 --------------------------------------------------------------------------

def _sql_vocab_gap():
    rows = (
        [("home_ownership", v) for v in C.HOME_OWNERSHIP_LEVELS]
        + [("verification_status", v) for v in C.VERIFICATION_LEVELS]
        + [("purpose", v) for v in C.PURPOSE_LEVELS]
        + [("addr_state", v) for v in C.US_STATES]
        + [("initial_list_status", v) for v in C.INITIAL_LIST_LEVELS]
    )
    values = ", ".join(f"('{c}', '{v}')" for c, v in rows)
    trained = " UNION ".join(
        f"SELECT '{c}' AS \"column\", coalesce({c}, 'unknown') AS level FROM splits WHERE split = 'train'" for c in C.NOMINAL
    )
    return S.with_ctes(
        *S.base(P)[:4],
        f"accepted(\"column\", level) AS (VALUES {values})",
        f"trained AS ({trained})",
        select="SELECT a.\"column\", a.level FROM accepted a ANTI JOIN trained t ON a.\"column\" = t.\"column\" AND a.level = t.level",
    )


@register("vocabulary_gap", _sql_vocab_gap)
def q_vocab_gap(spark, sf_dir):
    """C-6: levels the contract accepts but training never saw."""
    st = Stages(spark, sf_dir)
    return contract.vocabulary_gap(spark, st.train)


# --- C-7 --------------------------------------------------------------------------

def _sql_overlap():
    return S.with_ctes(*S.base(P)[:4], select="""
SELECT count(*) AS keys, count(*) FILTER (WHERE n > 1) AS keys_in_several_splits
FROM (SELECT loan_id, count(DISTINCT split) AS n FROM splits WHERE split <> 'unused' GROUP BY loan_id)""")


@register("split_overlap", _sql_overlap)
def q_overlap(spark, sf_dir):
    """C-7: no loan may sit in two splits (keyed on the loan identity)."""
    st = Stages(spark, sf_dir)
    return splits.split_overlap(st.with_split.filter(F.col("split") != "unused"), ["loan_id"])
