"""DuckDB oracle text.

The oracle is written independently of the Spark code: plain SQL CTEs over
the pre-registered tables, composed into one statement per registered query.
Helper CTEs mirror the pipeline stages (loan view, features, labels, split,
closed-form score) so every query text is self-contained.
"""

from __future__ import annotations

from ledgerlake import config as C


def _q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def c2(x: str) -> str:
    return f"(floor(({x})*100e0 + 0.5e0)/100e0)"


def rhu(x: str, k: int) -> str:
    """Round half up, identical to session.round_half_up."""
    s = f"{10 ** k}e0"
    return f"(floor(({x})*{s} + 0.5e0)/{s})"


LOANS = f"""
_j AS (
  SELECT l.*, o.o_totalprice, o.o_orderpriority, c.c_custkey, c.c_nationkey, c.c_acctbal,
         c.c_mktsegment, p.p_size, p.p_type,
         CAST(round(l_discount*100) AS INTEGER) % 7 AS g,
         (l_partkey*7919 + l_suppkey*104729 + l_orderkey*31) % 1000 AS u,
         CASE WHEN l_linenumber = 7 THEN 60 ELSE 36 END AS n
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
_j2 AS (
  SELECT *, u < 50 + 50*g AS bad, {c2("500e0 + l_extendedprice*0.37e0")} AS amt,
         {c2("6e0 + 3*g + l_tax*10e0")} AS rate
  FROM _j
),
_j3 AS (
  SELECT *, {c2("amt*(rate/1200e0)/(1e0 - power(1e0 + rate/1200e0, -n))")} AS inst FROM _j2
),
loans AS (
  SELECT
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
              CAST(l_suppkey AS VARCHAR), CAST(CAST(round(l_extendedprice*100) AS BIGINT) AS VARCHAR)) AS loan_id,
    amt AS loan_amnt, amt AS funded_amnt,
    ' ' || CAST(n AS VARCHAR) || ' months' AS term,
    rate AS int_rate,
    CASE WHEN l_suppkey % 50 = 0 THEN {c2("inst/10e0")} ELSE inst END AS installment,
    substr('ABCDEFG', g+1, 1) AS grade,
    substr('ABCDEFG', g+1, 1) || CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS VARCHAR) AS sub_grade,
    CASE p_size % 13 WHEN 0 THEN NULL WHEN 1 THEN '< 1 year' WHEN 2 THEN '1 year'
         WHEN 11 THEN '10+ years' WHEN 12 THEN 'n/a'
         ELSE CAST(p_size % 13 - 1 AS VARCHAR) || ' years' END AS emp_length,
    CASE WHEN l_shipdate >= TIMESTAMP '2001-01-01' AND p_size = 50 THEN 'ANY'
         WHEN c_mktsegment = 'BUILDING' THEN 'MORTGAGE' WHEN c_mktsegment = 'MACHINERY' THEN 'OWN'
         WHEN c_mktsegment = 'FURNITURE' THEN 'OTHER' ELSE 'RENT' END AS home_ownership,
    CASE WHEN p_size = 7 THEN NULL WHEN c_acctbal < 0 THEN 0e0
         WHEN l_shipdate >= TIMESTAMP '2001-07-01' THEN c_acctbal*45
         ELSE c_acctbal*15 END AS annual_inc,
    CASE WHEN substr(o_orderpriority,1,1) IN ('1','2') THEN 'Verified'
         WHEN substr(o_orderpriority,1,1) = '3' THEN 'Source Verified' ELSE 'Not Verified' END AS verification_status,
    substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3*month(l_shipdate)-2, 3) || '-' || CAST(year(l_shipdate) AS VARCHAR) AS issue_d,
    substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3*(c_custkey%12+1)-2, 3) || '-'
      || CAST(year(l_shipdate) - 5 - c_custkey%20 AS VARCHAR) AS earliest_cr_line,
    CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' AND l_returnflag = 'R' AND substr(o_orderpriority,1,1) = '1'
         THEN '{C.CREDIT_POLICY_PREFIX}' ELSE '' END ||
    CASE WHEN l_shipdate >= TIMESTAMP '2001-01-01' AND l_returnflag = 'N' THEN 'Current'
         WHEN l_shipdate >= TIMESTAMP '2001-01-01' AND l_returnflag = 'A' THEN 'Late (31-120 days)'
         WHEN bad AND u < 5 THEN 'Default' WHEN bad THEN 'Charged Off' ELSE 'Fully Paid' END AS loan_status,
    CASE WHEN starts_with(p_type,'ECONOMY') THEN 'car' WHEN starts_with(p_type,'SMALL') THEN 'credit_card'
         WHEN starts_with(p_type,'MEDIUM') THEN 'debt_consolidation' WHEN starts_with(p_type,'PROMO') THEN 'wedding'
         WHEN starts_with(p_type,'STANDARD') THEN 'home_improvement' ELSE 'small_business' END AS purpose,
    CASE WHEN c_nationkey = 24 AND l_shipdate >= TIMESTAMP '2001-01-01' THEN 'ND'
         WHEN c_nationkey = 24 THEN 'CA'
         ELSE substr('AKALARAZCACOCTDCDEFLGAHIIDILINKSKYLAMAMDMEMIMNMO', 1+2*c_nationkey, 2) END AS addr_state,
    CASE WHEN l_quantity = 50 THEN 999e0 WHEN l_quantity = 49 THEN NULL ELSE {c2("l_quantity*0.8e0")} END AS dti,
    CAST(620 + 5*(c_custkey % 40) AS DOUBLE) AS fico_range_low,
    CAST(624 + 5*(c_custkey % 40) AS DOUBLE) AS fico_range_high,
    CAST(l_linenumber % 3 AS DOUBLE) AS delinq_2yrs,
    CAST(l_suppkey % 4 AS DOUBLE) AS inq_last_6mths,
    CAST(2 + l_partkey % 18 AS DOUBLE) AS open_acc,
    CAST(c_custkey % 2 AS DOUBLE) AS pub_rec,
    CAST(5 + l_partkey % 35 AS DOUBLE) AS total_acc,
    CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_partkey % 80 AS DOUBLE) END AS mths_since_last_delinq,
    CASE WHEN c_custkey % 10 = 0 THEN CAST(40 + l_partkey % 60 AS DOUBLE) END AS mths_since_last_record,
    {c2("o_totalprice/10e0")} AS revol_bal,
    CASE WHEN l_partkey % 1000 = 0 THEN NULL ELSE (l_partkey % 1000)/10e0 END AS revol_util,
    CASE WHEN l_linestatus = 'F' THEN 'f' ELSE 'w' END AS initial_list_status,
    CASE WHEN c_custkey % 100 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS DOUBLE) END AS pub_rec_bankruptcies,
    0e0 AS acc_now_delinq, 0e0 AS collections_12_mths_ex_med, 0e0 AS recoveries,
    CASE WHEN bad THEN {c2("amt*0.635e0")} ELSE {c2("amt + (inst*n - amt)*0.83e0")} END AS total_pymnt,
    g AS grade_idx, l_shipdate
  FROM _j3
)"""

# P-1 .. P-9 (+ P-18 batch key) over the raw loans.
FEATURES = f"""
feat AS (
  SELECT *,
    CAST(substr(trim(term), 1, 2) AS SMALLINT) AS term_months,
    CASE WHEN contains(emp_length, '10+') THEN 10 WHEN contains(emp_length, '< 1') THEN 0
         ELSE TRY_CAST(NULLIF(regexp_extract(emp_length, '(\\d+)', 1), '') AS TINYINT) END AS emp_length_years,
    CAST(strptime(issue_d, '%b-%Y') AS DATE) AS issue_date,
    CAST(strptime(earliest_cr_line, '%b-%Y') AS DATE) AS earliest_cr_date,
    (fico_range_low + fico_range_high)/2 AS fico_mid,
    date_diff('day', CAST(strptime(earliest_cr_line, '%b-%Y') AS DATE), CAST(strptime(issue_d, '%b-%Y') AS DATE)) / {C.DAYS_PER_MONTH}e0 AS credit_history_months,
    CASE WHEN annual_inc > 0 THEN loan_amnt/annual_inc END AS loan_to_income,
    CASE WHEN annual_inc > 0 THEN installment*12/annual_inc END AS installment_to_income,
    CASE WHEN dti >= 999 THEN NULL ELSE dti END AS dti_clean,
    starts_with(loan_status, '{C.CREDIT_POLICY_STARTS}') AS not_credit_policy,
    CASE WHEN strpos(loan_status, '{C.CREDIT_POLICY_PREFIX}') > 0
         THEN substr(loan_status, 1, strpos(loan_status, '{C.CREDIT_POLICY_PREFIX}') - 1)
              || substr(loan_status, strpos(loan_status, '{C.CREDIT_POLICY_PREFIX}') + {len(C.CREDIT_POLICY_PREFIX)})
         ELSE loan_status END AS status_clean
  FROM loans
),
features AS (
  SELECT * EXCLUDE (dti, dti_clean), dti_clean AS dti FROM feat
)"""


def prepared_cte(p: C.Params = C.DEFAULT) -> str:
    """F-1..F-3, P-10, P-11 (transform) on top of FEATURES."""
    terms = ", ".join(str(t) for t in p.terms_months)
    policy_filter = "" if p.keep_credit_policy_loans else "AND NOT not_credit_policy"
    return f"""
prepared AS (
  SELECT *, CAST(status_clean IN ({_q(C.POSITIVE_STATUSES)}) AS TINYINT) AS target,
         total_pymnt - funded_amnt AS realized_profit
  FROM features
  WHERE status_clean IN ({_q(C.POSITIVE_STATUSES + C.NEGATIVE_STATUSES)}) {policy_filter}
    AND term_months IN ({terms})
    AND issue_date >= DATE '{p.min_issue_date}' AND issue_date <= DATE '{p.max_issue_date}'
)"""


def split_cte(p: C.Params = C.DEFAULT) -> str:
    w = p.split_windows()
    return f"""
splits AS (
  SELECT *, CASE
    WHEN issue_date BETWEEN DATE '{w['train'].start}' AND DATE '{w['train'].end}' THEN 'train'
    WHEN issue_date BETWEEN DATE '{w['validation'].start}' AND DATE '{w['validation'].end}' THEN 'validation'
    WHEN issue_date BETWEEN DATE '{w['test'].start}' AND DATE '{w['test'].end}' THEN 'test'
    ELSE 'unused' END AS split
  FROM prepared
)"""


def score_expr(prefix: str = "") -> str:
    """The closed-form risk score of FIXTURES.md 3.1."""
    return (
        "floor(1e6/(1e0+exp(-(-3.2e0 + 0.32e0*{p}grade_idx - 0.012e0*({p}fico_mid-700e0) "
        "+ 2.5e0*least(coalesce({p}loan_to_income, 0.2e0), 1e0)))) + 0.5e0)/1e6"
    ).format(p=prefix)


SCORED = f"""
scored AS (
  SELECT *, {score_expr()} AS risk_score, installment*term_months - funded_amnt AS gain
  FROM splits
)"""


def with_ctes(*ctes: str, select: str) -> str:
    body = ",\n".join(c.strip() for c in ctes)
    return f"WITH {body}\n{select}"


def base(p: C.Params = C.DEFAULT) -> list[str]:
    """loans -> features -> prepared -> splits -> scored."""
    return [LOANS, FEATURES, prepared_cte(p), split_cte(p), SCORED]
