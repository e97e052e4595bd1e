"""Registered queries: profiles (A-13 .. A-16, A-18 .. A-23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.operators import labels, profile
from ledgerlake.plans import oracle_sql as S
from ledgerlake.plans.q_policy import PM_CTE, policy_ctes
from ledgerlake.plans.registry import money, ratio, register
from ledgerlake.plans.stages import Stages

P = C.DEFAULT
_q = S._q


def production_cte() -> str:
    terms = ", ".join(str(t) for t in P.terms_months)
    return f"""production AS (
  SELECT *, strftime(issue_date, '%Y-%m') AS batch, status_clean IN ({_q(C.RESOLVED_STATUSES)}) AS outcome_known,
         {S.score_expr()} AS risk_score
  FROM features
  WHERE term_months IN ({terms}) AND issue_date >= DATE '{P.production.start}' AND issue_date <= DATE '{P.production.end}')"""


def decided_cte(src: str, name: str) -> str:
    ev = "((1 - risk_score) * (installment*term_months - loan_amnt) * (SELECT prepay_factor FROM pm) - risk_score * (SELECT lgd FROM pm) * loan_amnt)"
    return f"""{name} AS (
  SELECT *, risk_score AS probability_of_default,
         CASE WHEN risk_score >= (SELECT threshold FROM chosen) OR {ev} <= 0 THEN 'decline' ELSE 'fund' END AS decision
  FROM {src})"""


# --- A-13 -----------------------------------------------------------------------

def _sql_monthly():
    return S.with_ctes(*policy_ctes(), production_cte(), decided_cte("production", "prod_dec"), select=f"""
SELECT batch, count(*) AS loans, {S.rhu('avg(CASE WHEN outcome_known THEN 1e0 ELSE 0e0 END)', 6)} AS outcome_known,
       {S.rhu("avg(CASE WHEN decision = 'fund' THEN 1e0 ELSE 0e0 END)", 6)} AS fund_rate,
       {S.rhu('avg(probability_of_default)', 6)} AS mean_probability
FROM prod_dec GROUP BY batch""")


@register("monthly_summary", _sql_monthly)
def q_monthly(spark, sf_dir):
    """A-13 (with F-4, P-18): production months scored by the tuned policy."""
    st = Stages(spark, sf_dir)
    m = profile.monthly_summary(st.decided(st.production))
    return m.select("batch", "loans", ratio("outcome_known"), ratio("fund_rate"), ratio("mean_probability"))


# --- A-14, A-15, A-16 ---------------------------------------------------------------

@register("status_counts", lambda: S.with_ctes(S.LOANS, select="SELECT loan_status, count(*) AS loans FROM loans GROUP BY loan_status"))
def q_status_counts(spark, sf_dir):
    """A-14: raw status counts."""
    return profile.status_counts(Stages(spark, sf_dir).raw)


def _sql_funnel():
    terms = ", ".join(str(t) for t in P.terms_months)
    return S.with_ctes(S.LOANS, S.FEATURES, select=f"""
SELECT * FROM (
  SELECT 1 AS step_order, 'all loans' AS step, count(*) AS loans FROM features
  UNION ALL SELECT 2, '36-month term', count(*) FROM features WHERE contains(term, '36')
  UNION ALL SELECT 3, '+ known outcome', count(*) FROM features WHERE contains(term, '36') AND status_clean IN ({_q(C.RESOLVED_STATUSES)})
  UNION ALL SELECT 4, '+ matured', count(*) FROM features
    WHERE status_clean IN ({_q(C.POSITIVE_STATUSES + C.NEGATIVE_STATUSES)}) AND term_months IN ({terms})
      AND issue_date >= DATE '{P.min_issue_date}' AND issue_date <= DATE '{P.max_issue_date}')""")


@register("funnel", _sql_funnel)
def q_funnel(spark, sf_dir):
    """A-15: the filter funnel as four nested counts in one pass."""
    st = Stages(spark, sf_dir)
    df = st.features.withColumn("_prepared", labels.prepared_predicate(P))
    return profile.funnel(df).select(F.col("step_order").cast("int"), "step", "loans")


def _sql_maturity():
    return S.with_ctes(S.LOANS, S.FEATURES, select=f"""
SELECT year(issue_date) AS year, count(*) AS n,
       {S.rhu(f"avg(CASE WHEN status_clean IN ({_q(C.POSITIVE_STATUSES)}) THEN 1e0 ELSE 0e0 END)", 6)} AS default_rate
FROM features WHERE contains(term, '36') AND status_clean IN ({_q(C.RESOLVED_STATUSES)})
GROUP BY year(issue_date)""")


@register("maturity_by_year", _sql_maturity)
def q_maturity(spark, sf_dir):
    """A-16: finished 36-month loans by issue year."""
    st = Stages(spark, sf_dir)
    return profile.maturity_by_year(st.features).select(F.col("year").cast("bigint"), "n", ratio("default_rate"))


# --- A-18 -----------------------------------------------------------------------

def _sql_grade():
    return S.with_ctes(*S.base(P)[:3], select=f"""
SELECT grade, count(*) AS loans, {S.rhu('avg(CAST(target AS DOUBLE))', 6)} AS default_rate,
       {S.rhu('avg(int_rate)', 6)} AS avg_int_rate, {S.rhu('avg(realized_profit)', 6)} AS avg_profit
FROM prepared GROUP BY grade""")


@register("risk_by_grade", _sql_grade)
def q_grade(spark, sf_dir):
    """A-18: risk by grade."""
    g = profile.risk_by_grade(Stages(spark, sf_dir).prepared)
    return g.select("grade", "loans", ratio("default_rate"), ratio("avg_int_rate"), ratio("avg_profit"))


# --- A-19 -----------------------------------------------------------------------

def _prepared_cols() -> list[str]:
    keep = list(C.ALLOWLIST) + list(C.DERIVED) + list(C.OUTCOME)
    return list(dict.fromkeys(keep))


def _sql_nulls():
    parts = [
        f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END) AS null_share FROM prepared "
        f"WHERE issue_date <= DATE '{P.train.end}'"
        for c in _prepared_cols()
    ]
    return S.with_ctes(*S.base(P)[:3], f"shares AS ({' UNION ALL '.join(parts)})",
                       select=f"SELECT \"column\", {S.rhu('null_share', 6)} AS null_share FROM shares WHERE null_share > 0")


@register("null_shares", _sql_nulls)
def q_nulls(spark, sf_dir):
    """A-19: null share of every prepared column on the training years, > 0 only."""
    st = Stages(spark, sf_dir)
    train = st.prepared.filter(F.col("issue_date") <= F.lit(P.train.end).cast("date"))
    return profile.null_shares(train, _prepared_cols()).select("column", ratio("null_share"))


# --- A-20 -----------------------------------------------------------------------

def _sql_describe():
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS null_count,
  {S.rhu(f'avg({c})', 4)} AS mean, {S.rhu(f'stddev_samp({c})', 4)} AS std, min({c}) AS min,
  {S.rhu(f'quantile_cont({c}, 0.25)', 6)} AS q25, {S.rhu(f'quantile_cont({c}, 0.5)', 6)} AS median,
  {S.rhu(f'quantile_cont({c}, 0.75)', 6)} AS q75, max({c}) AS max FROM prepared"""
        for c in profile.DESCRIBE_COLUMNS
    ]
    return S.with_ctes(*S.base(P)[:3], select=" UNION ALL ".join(parts))


@register("describe_numeric", _sql_describe)
def q_describe(spark, sf_dir):
    """A-20: describe six numeric columns (exact quartiles)."""
    d = profile.describe(Stages(spark, sf_dir).prepared)
    return d.select("column", "count", "null_count", ratio("mean", digits=4), ratio("std", digits=4), "min",
                    ratio("q25"), ratio("median"), ratio("q75"), "max")


# --- A-21 -----------------------------------------------------------------------

def _sql_category():
    parts = [
        f"SELECT '{c}' AS \"column\", {c} AS level, count(*) AS loans, "
        f"{S.rhu('avg(CAST(target AS DOUBLE))', 6)} AS default_rate FROM prepared GROUP BY {c}"
        for c in profile.CATEGORY_COLUMNS
    ]
    return S.with_ctes(*S.base(P)[:3], select=" UNION ALL ".join(parts))


@register("category_profile", _sql_category)
def q_category(spark, sf_dir):
    """A-21: levels, loans, default rate for four categorical columns."""
    c = profile.category_profile(Stages(spark, sf_dir).prepared)
    return c.select("column", "level", "loans", ratio("default_rate"))


# --- A-22 -----------------------------------------------------------------------

def _sql_hist():
    specs = [(c, "'all'", 50) for c in profile.DESCRIBE_COLUMNS] + [
        ("realized_profit", "CASE WHEN target = 1 THEN 'defaulted' ELSE 'repaid' END", 60)
    ]
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {s} AS series, CAST({c} AS DOUBLE) AS value, {nb} AS nb FROM prepared WHERE {c} IS NOT NULL"
        for c, s, nb in specs
    )
    return S.with_ctes(
        *S.base(P)[:3],
        f"long AS ({long})",
        'edges AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM long GROUP BY "column")',
        """binned AS (
  SELECT l."column", series, nb, lo, hi,
         CASE WHEN hi = lo THEN 0 ELSE CAST(least(floor((value - lo) / (hi - lo) * nb), nb - 1) AS INTEGER) END AS bin
  FROM long l JOIN edges e ON l."column" = e."column")""",
        """counted AS (SELECT "column", series, nb, lo, hi, bin, count(*) AS loans FROM binned GROUP BY ALL)""",
        select=f"""
SELECT "column", series, bin, {S.rhu('lo + bin * ((hi - lo) / nb)', 6)} AS lower,
       {S.rhu('lo + (bin + 1) * ((hi - lo) / nb)', 6)} AS upper, loans,
       {S.rhu('loans / (sum(loans) OVER (PARTITION BY "column", series) * CASE WHEN (hi - lo) / nb > 0 THEN (hi - lo) / nb ELSE 1e0 END)', 12)} AS density
FROM counted""")


@register("histograms", _sql_hist)
def q_hist(spark, sf_dir):
    """A-22: histogram tables over the full prepared data (no sample)."""
    h = profile.histograms(Stages(spark, sf_dir).prepared)
    return h.select("column", "series", "bin", ratio("lower"), ratio("upper"), "loans", ratio("density", digits=12))


# --- A-23 -----------------------------------------------------------------------

def _sql_installment():
    r = "int_rate/1200e0"
    sched = f"(CASE WHEN {r} = 0 THEN loan_amnt/term_months ELSE loan_amnt*{r}/(1e0 - power(1e0 + {r}, -term_months)) END)"
    off = f"abs(installment / {sched} - 1)"
    return S.with_ctes(*S.base(P)[:3], select=f"""
SELECT count(*) AS loans, count(*) FILTER (WHERE {off} > 0.01e0) AS off_by_1pct, count(*) FILTER (WHERE {off} > 0.05e0) AS off_by_5pct,
       {S.rhu(f'avg(CASE WHEN {off} > 0.01e0 THEN 1e0 ELSE 0e0 END)', 6)} AS share_off_1pct,
       {S.rhu(f'avg(CASE WHEN {off} > 0.05e0 THEN 1e0 ELSE 0e0 END)', 6)} AS share_off_5pct
FROM prepared""")


@register("installment_consistency", _sql_installment)
def q_installment(spark, sf_dir):
    """A-23 (with P-16): stated installment vs the amortisation formula."""
    i = profile.installment_consistency(Stages(spark, sf_dir).prepared)
    return i.select("loans", "off_by_1pct", "off_by_5pct", ratio("share_off_1pct"), ratio("share_off_5pct"))
