"""Registered queries: features, labels, splits and policy analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.functions.features import breakeven_probability, derive_features, expected_installment
from ledgerlake.functions.features import credit_policy_columns
from ledgerlake.operators import evaluate, policy, splits
from ledgerlake.plans import oracle_sql as S
from ledgerlake.plans.registry import money, ratio, register
from ledgerlake.plans.stages import Stages, add_scores

P = C.DEFAULT


# --- P-1 .. P-9 ---------------------------------------------------------------

def _sql_derive():
    return S.with_ctes(S.LOANS, S.FEATURES, select="""
SELECT loan_id, CAST(term_months AS BIGINT) AS term_months, CAST(emp_length_years AS BIGINT) AS emp_length_years,
       CAST(issue_date AS VARCHAR) AS issue_date, CAST(earliest_cr_date AS VARCHAR) AS earliest_cr_date,
       fico_mid, credit_history_months, loan_to_income, installment_to_income, dti,
       not_credit_policy, status_clean
FROM features""")


@register("derive_features", _sql_derive)
def q_derive(spark, sf_dir):
    st = Stages(spark, sf_dir)
    df = credit_policy_columns(derive_features(st.raw))
    return df.select(
        "loan_id", F.col("term_months").cast("bigint"), F.col("emp_length_years").cast("bigint"),
        F.col("issue_date").cast("string"), F.col("earliest_cr_date").cast("string"),
        "fico_mid", "credit_history_months", "loan_to_income", "installment_to_income", "dti",
        "not_credit_policy", "status_clean",
    )


# --- F-1 .. F-3, P-9 .. P-11 ---------------------------------------------------

def _sql_labels():
    return S.with_ctes(S.LOANS, S.FEATURES, S.prepared_cte(P), select="""
SELECT loan_id, CAST(target AS BIGINT) AS target, realized_profit, CAST(issue_date AS VARCHAR) AS issue_date,
       not_credit_policy, status_clean, CAST(term_months AS BIGINT) AS term_months
FROM prepared""")


@register("label_and_filter", _sql_labels)
def q_labels(spark, sf_dir):
    st = Stages(spark, sf_dir)
    return st.prepared.select(
        "loan_id", F.col("target").cast("bigint"), "realized_profit", F.col("issue_date").cast("string"),
        "not_credit_policy", "status_clean", F.col("term_months").cast("bigint"),
    )


# --- F-5, A-17 ----------------------------------------------------------------

def _sql_split_profile():
    return S.with_ctes(*S.base(P), select=f"""
SELECT split, count(*) AS loans, {S.rhu('avg(target)', 6)} AS default_rate,
       {S.rhu('avg(loan_amnt)', 6)} AS avg_loan, {S.rhu('avg(int_rate)', 6)} AS avg_int_rate
FROM splits WHERE split <> 'unused' GROUP BY split""")


@register("split_profile", _sql_split_profile)
def q_split_profile(spark, sf_dir):
    st = Stages(spark, sf_dir)
    return splits.split_profile(st.prepared).select(
        "split", "loans", ratio("default_rate"), ratio("avg_loan"), ratio("avg_int_rate")
    )


# --- F-7 ----------------------------------------------------------------------

def _sql_fold_sizes():
    parts = []
    for i, f in enumerate(P.folds, start=1):
        parts.append(f"SELECT {i} AS fold, 'train' AS role, * FROM splits WHERE split='train' AND issue_date <= DATE '{f.train_end}'")
        parts.append(f"SELECT {i} AS fold, 'validate' AS role, * FROM splits WHERE split='train' AND year(issue_date) = {f.validate_year}")
    tagged = " UNION ALL ".join(parts)
    return S.with_ctes(*S.base(P)[:4], f"tagged AS ({tagged})", select=f"""
SELECT CAST(fold AS INTEGER) AS fold, role, count(*) AS loans, {S.rhu('avg(target)', 6)} AS default_rate,
       CAST(min(issue_date) AS VARCHAR) AS first_issue_date, CAST(max(issue_date) AS VARCHAR) AS last_issue_date
FROM tagged GROUP BY fold, role""")


@register("fold_sizes", _sql_fold_sizes)
def q_fold_sizes(spark, sf_dir):
    st = Stages(spark, sf_dir)
    return splits.fold_sizes(st.train).select(
        "fold", "role", "loans", ratio("default_rate"), "first_issue_date", "last_issue_date"
    )


# --- A-1, A-2 -----------------------------------------------------------------

PM_CTE = """
pm AS (
  SELECT -sum(CASE WHEN target = 1 THEN realized_profit END) / sum(CASE WHEN target = 1 THEN funded_amnt END) AS lgd,
         sum(CASE WHEN target = 0 THEN realized_profit END) / sum(CASE WHEN target = 0 THEN gain END) AS prepay_factor
  FROM scored WHERE split = 'train'
)"""


def _sql_profit_model():
    return S.with_ctes(*S.base(P), PM_CTE, select=f"SELECT {S.rhu('lgd', 6)} AS lgd, {S.rhu('prepay_factor', 6)} AS prepay_factor FROM pm")


@register("profit_model", _sql_profit_model)
def q_profit_model(spark, sf_dir):
    st = Stages(spark, sf_dir)
    return policy.profit_model_frame(st.train).select(ratio("lgd"), ratio("prepay_factor"))


def _sql_payback():
    return S.with_ctes(*S.base(P)[:3], select=f"""
SELECT CAST(target AS BIGINT) AS target, count(*) AS loans, {S.rhu('avg(realized_profit)', 6)} AS avg_profit,
       {S.rhu('avg(total_pymnt / funded_amnt)', 6)} AS payback_ratio,
       {S.rhu('1 - avg(total_pymnt / funded_amnt)', 6)} AS loss_share
FROM prepared GROUP BY target""")


@register("payback_by_target", _sql_payback)
def q_payback(spark, sf_dir):
    """A-2: per-loan payback ratio and loss share by outcome (EDA variant)."""
    st = Stages(spark, sf_dir)
    g = st.prepared.groupBy(F.col("target").cast("bigint").alias("target")).agg(
        F.count(F.lit(1)).alias("loans"),
        F.avg("realized_profit").alias("avg_profit"),
        F.avg(F.col("total_pymnt") / F.col("funded_amnt")).alias("payback_ratio"),
    ).withColumn("loss_share", 1 - F.col("payback_ratio"))
    return g.select("target", "loans", ratio("avg_profit"), ratio("payback_ratio"), ratio("loss_share"))


# --- A-5 .. A-8 ---------------------------------------------------------------

def tune_cte() -> str:
    return f"tune AS (SELECT * FROM scored WHERE split = 'validation' AND issue_date >= DATE '{P.calibration_end}')"


CURVE_CTES = [
    f"grid AS (SELECT range AS k, ({C.THRESHOLD_GRID_START_MILLI} + {C.THRESHOLD_GRID_STEP_MILLI}*range)/1000e0 AS threshold FROM range({C.THRESHOLD_GRID_POINTS}))",
    """curve_sums AS (
  SELECT threshold, count(*) AS rows_, count(*) FILTER (WHERE risk_score < threshold) AS n,
         coalesce(sum(CASE WHEN risk_score < threshold THEN funded_amnt END), 0e0) AS capital,
         coalesce(sum(CASE WHEN risk_score < threshold THEN realized_profit END), 0e0) AS profit,
         coalesce(sum(CASE WHEN risk_score < threshold THEN CAST(target AS DOUBLE) END), 0e0) AS defaults
  FROM grid, tune GROUP BY threshold)""",
    """curve AS (
  SELECT threshold, n AS loans_funded, n / rows_ AS share_funded, capital AS capital_invested, profit AS total_profit,
         CASE WHEN capital <> 0 THEN profit / capital ELSE 0e0 END AS return_per_dollar,
         CASE WHEN n > 0 THEN defaults / n ELSE 0e0 END AS default_rate_funded
  FROM curve_sums)""",
]


def _curve_select(prefix="") -> str:
    return (f"SELECT {S.rhu('threshold', 6)} AS threshold, loans_funded, {S.rhu('share_funded', 6)} AS share_funded, "
            f"{S.rhu('capital_invested', 2)} AS capital_invested, {S.rhu('total_profit', 2)} AS total_profit, "
            f"{S.rhu('return_per_dollar', 6)} AS return_per_dollar, {S.rhu('default_rate_funded', 6)} AS default_rate_funded")


def _sql_curve():
    return S.with_ctes(*S.base(P), tune_cte(), *CURVE_CTES, select=_curve_select() + " FROM curve")


def _curve_out(df):
    return df.select(
        ratio("threshold"), "loans_funded", ratio("share_funded"), money("capital_invested"),
        money("total_profit"), ratio("return_per_dollar"), ratio("default_rate_funded"),
    )


@register("threshold_curve", _sql_curve)
def q_curve(spark, sf_dir):
    st = Stages(spark, sf_dir)
    _, tune = st.calib_tune
    return _curve_out(policy.threshold_curve(add_scores(tune)))


CHOSEN_CTE = f"""chosen AS (
  SELECT threshold FROM curve WHERE share_funded >= {C.MIN_SHARE_FUNDED}e0
  ORDER BY {S.rhu('return_per_dollar', 10)} DESC, threshold ASC LIMIT 1)"""


def _sql_chosen():
    return S.with_ctes(*S.base(P), tune_cte(), *CURVE_CTES, select=_curve_select()
                       + f" FROM curve WHERE share_funded >= {C.MIN_SHARE_FUNDED}e0"
                       + f" ORDER BY {S.rhu('return_per_dollar', 10)} DESC, threshold ASC LIMIT 1")


@register("chosen_threshold", _sql_chosen)
def q_chosen(spark, sf_dir):
    st = Stages(spark, sf_dir)
    _, tune = st.calib_tune
    return _curve_out(policy.choose_threshold_frame(policy.threshold_curve(add_scores(tune))))


MATCHED_CTES = [
    "share AS (SELECT avg(CASE WHEN grade IN ('A','B') THEN 1e0 ELSE 0e0 END) AS s FROM tune)",
    "ord AS (SELECT risk_score, row_number() OVER (ORDER BY risk_score) - 1 AS i, count(*) OVER () AS n FROM tune)",
    "pos AS (SELECT (SELECT s FROM share) * (max(n) - 1) AS p FROM ord)",
    """matched AS (
  SELECT (SELECT s FROM share) AS matched_share,
         lo.risk_score + (hi.risk_score - lo.risk_score) * (pos.p - floor(pos.p)) AS matched_threshold
  FROM pos, ord lo, ord hi WHERE lo.i = CAST(floor(pos.p) AS BIGINT) AND hi.i = CAST(ceil(pos.p) AS BIGINT))""",
]


def _sql_matched():
    return S.with_ctes(*S.base(P), tune_cte(), *CURVE_CTES, CHOSEN_CTE, *MATCHED_CTES, select=f"""
SELECT {S.rhu('matched_share', 6)} AS matched_share, {S.rhu('matched_threshold', 9)} AS matched_threshold,
       {S.rhu('(SELECT threshold FROM chosen)', 6)} AS threshold,
       {S.rhu('coalesce((SELECT max(risk_score) FROM tune WHERE risk_score < (SELECT threshold FROM chosen)), 0e0)', 6)} AS calibrated_risk_at_threshold
FROM matched""")


@register("matched_threshold", _sql_matched)
def q_matched(spark, sf_dir):
    """A-7 + A-8: matched-share threshold and the risk level at the tuned one."""
    st = Stages(spark, sf_dir)
    t = st.tuned
    row = [(t["matched_share"], t["matched_threshold"], t["threshold"], t["calibrated_risk_at_threshold"])]
    df = spark.createDataFrame(row, "matched_share double, matched_threshold double, threshold double, calibrated_risk_at_threshold double")
    return df.select(ratio("matched_share"), ratio("matched_threshold", digits=9), ratio("threshold"),
                     ratio("calibrated_risk_at_threshold"))


# --- A-3, A-4 (flagship) --------------------------------------------------------

def _policy_defs() -> dict[str, str]:
    ev = "((1 - risk_score) * gain * (SELECT prepay_factor FROM pm) - risk_score * (SELECT lgd FROM pm) * funded_amnt) > 0"
    return {
        "expected_value": ev,
        "threshold": f"risk_score < (SELECT threshold FROM chosen) AND {ev}",
        "matched_to_grade_AB": f"risk_score < (SELECT matched_threshold FROM matched) AND {ev}",
        "fund_all": "TRUE",
        "grade_AB": "grade IN ('A','B')",
    }


def policy_ctes() -> list[str]:
    return [*S.base(P), PM_CTE, tune_cte(), *CURVE_CTES, CHOSEN_CTE, *MATCHED_CTES,
            "test AS (SELECT * FROM scored WHERE split = 'test')"]


def _sql_policy_table():
    parts = []
    for name, cond in _policy_defs().items():
        parts.append(f"""SELECT '{name}' AS policy, count(*) FILTER (WHERE {cond}) AS n, count(*) AS rows_,
  coalesce(sum(CASE WHEN {cond} THEN funded_amnt END), 0e0) AS capital,
  coalesce(sum(CASE WHEN {cond} THEN realized_profit END), 0e0) AS profit,
  coalesce(sum(CASE WHEN {cond} THEN CAST(target AS DOUBLE) END), 0e0) AS defaults FROM test""")
    union = " UNION ALL ".join(parts)
    return S.with_ctes(*policy_ctes(), f"pol AS ({union})", select=f"""
SELECT policy, n AS loans_funded, {S.rhu('n / rows_', 6)} AS share_funded, {S.rhu('capital', 2)} AS capital_invested,
       {S.rhu('profit', 2)} AS total_profit,
       {S.rhu('CASE WHEN capital <> 0 THEN profit / capital ELSE 0e0 END', 6)} AS return_per_dollar,
       {S.rhu('CASE WHEN n > 0 THEN defaults / n ELSE 0e0 END', 6)} AS default_rate_funded
FROM pol""")


def policy_table(spark, sf_dir):
    st = Stages(spark, sf_dir)
    test, cols = st.test_policies()
    res = policy.evaluate_policies(test, cols)
    return res.select(
        "policy", "loans_funded", ratio("share_funded"), money("capital_invested"), money("total_profit"),
        ratio("return_per_dollar"), ratio("default_rate_funded"),
    )


register("policy_table", _sql_policy_table)(policy_table)


# --- P-15, P-17 -----------------------------------------------------------------

def _sql_decisions():
    ev = "((1 - risk_score) * (installment*term_months - loan_amnt) * (SELECT prepay_factor FROM pm) - risk_score * (SELECT lgd FROM pm) * loan_amnt)"
    return S.with_ctes(*policy_ctes(), select=f"""
SELECT loan_id, risk_score, risk_score AS probability_of_default, {S.rhu(ev, 2)} AS expected_return_usd,
  CASE WHEN risk_score >= (SELECT threshold FROM chosen) OR {ev} <= 0 THEN 'decline' ELSE 'fund' END AS decision,
  CASE WHEN risk_score >= (SELECT threshold FROM chosen) THEN 'score_above_threshold'
       WHEN {ev} <= 0 THEN 'negative_expected_return' ELSE 'score_below_threshold' END AS decision_basis
FROM test""")


@register("decisions", _sql_decisions)
def q_decisions(spark, sf_dir):
    st = Stages(spark, sf_dir)
    d = policy.decide(add_scores(st.test), st.tuned["threshold"], st.profit, amount_col="loan_amnt")
    return d.select("loan_id", "risk_score", "probability_of_default", money("expected_return_usd"),
                    "decision", "decision_basis")


def _sql_breakeven():
    b = "(gain * (SELECT prepay_factor FROM pm)) / (gain * (SELECT prepay_factor FROM pm) + (SELECT lgd FROM pm) * funded_amnt)"
    return S.with_ctes(*S.base(P), PM_CTE, select=f"""
SELECT loan_id, {S.rhu(b, 6)} AS breakeven_probability,
       {S.rhu('installment*term_months - funded_amnt', 2)} AS contractual_gain,
       {S.rhu(f"CASE WHEN int_rate/1200e0 = 0 THEN loan_amnt/term_months ELSE loan_amnt*(int_rate/1200e0)/(1e0 - power(1e0 + int_rate/1200e0, -term_months)) END", 2)} AS expected_installment
FROM scored WHERE split = 'test'""")


@register("breakeven", _sql_breakeven)
def q_breakeven(spark, sf_dir):
    """P-13, P-15, P-16 per test loan."""
    st = Stages(spark, sf_dir)
    pm = st.profit
    t = policy.with_gain(st.test)
    return t.select(
        "loan_id",
        ratio_col(breakeven_probability(F.col("gain"), F.col("funded_amnt"), pm.lgd, pm.prepay_factor), "breakeven_probability", 6),
        ratio_col(F.col("gain"), "contractual_gain", 2),
        ratio_col(expected_installment(F.col("loan_amnt"), F.col("int_rate"), F.col("term_months").cast("double")), "expected_installment", 2),
    )


def ratio_col(c, name, digits):
    from ledgerlake.session import round_half_up

    return round_half_up(c, digits).alias(name)


# --- A-9 ------------------------------------------------------------------------

FAMILIES = ("closed_form", "grade_prior")
COMPARISONS = evaluate.comparisons(*FAMILIES)
_PRIOR = """rates AS (SELECT grade, avg(CAST(target AS DOUBLE)) AS prior FROM scored WHERE split = 'train' GROUP BY grade),
  overall AS (SELECT avg(CAST(target AS DOUBLE)) AS prior FROM scored WHERE split = 'train')"""


def _family_rows(src: str) -> str:
    """The long table of both families over ``src``."""
    return f"""SELECT *, 'closed_form' AS family FROM {src}
  UNION ALL SELECT s.* REPLACE (coalesce(r.prior, (SELECT prior FROM overall)) AS risk_score), 'grade_prior'
  FROM {src} s LEFT JOIN rates r ON s.grade = r.grade"""


def _family_ctes() -> list[str]:
    """Tuned thresholds by family, and the long test table with its flags."""
    fund = "CASE WHEN risk_score < threshold THEN {} END"
    ev = "((1 - risk_score) * gain * (SELECT prepay_factor FROM pm) - risk_score * (SELECT lgd FROM pm) * funded_amnt) > 0"
    return [
        *S.base(P), PM_CTE, _PRIOR, tune_cte(), CURVE_CTES[0],
        f"ftune AS ({_family_rows('tune')})",
        f"""fcurve AS (
  SELECT family, threshold, count(*) FILTER (WHERE risk_score < threshold) / count(*) AS share_funded,
    coalesce(sum({fund.format('realized_profit')}), 0e0) AS profit, coalesce(sum({fund.format('funded_amnt')}), 0e0) AS capital
  FROM grid, ftune GROUP BY family, threshold)""",
        f"""fchosen AS (
  SELECT family, threshold FROM (SELECT *, CASE WHEN capital <> 0 THEN profit / capital ELSE 0e0 END AS rpd FROM fcurve)
  WHERE share_funded >= {C.MIN_SHARE_FUNDED}e0
  QUALIFY row_number() OVER (PARTITION BY family ORDER BY {S.rhu('rpd', 10)} DESC, threshold ASC) = 1)""",
        MATCHED_CTES[0],
        "ford AS (SELECT family, risk_score, row_number() OVER (PARTITION BY family ORDER BY risk_score) - 1 AS i, count(*) OVER (PARTITION BY family) AS n FROM ftune)",
        "fpos AS (SELECT family, (SELECT s FROM share) * (max(n) - 1) AS p FROM ford GROUP BY family)",
        """fmatched AS (
  SELECT q.family, lo.risk_score + (hi.risk_score - lo.risk_score) * (q.p - floor(q.p)) AS matched_threshold
  FROM fpos q JOIN ford lo ON lo.family = q.family AND lo.i = CAST(floor(q.p) AS BIGINT)
  JOIN ford hi ON hi.family = q.family AND hi.i = CAST(ceil(q.p) AS BIGINT))""",
        "test AS (SELECT * FROM scored WHERE split = 'test')",
        f"ftest AS ({_family_rows('test')})",
        f"""flags AS (
  SELECT t.*, {ev} AS expected_value, risk_score < c.threshold AND {ev} AS threshold,
    risk_score < m.matched_threshold AND {ev} AS matched_to_grade_AB, true AS fund_all, grade IN ('A', 'B') AS grade_AB
  FROM ftest t JOIN fchosen c ON t.family = c.family JOIN fmatched m ON t.family = m.family)""",
    ]


def _sql_family_thresholds():
    return S.with_ctes(*_family_ctes(), select=f"""
SELECT family, {S.rhu('threshold', 6)} AS threshold, {S.rhu('matched_threshold', 9)} AS matched_threshold,
  {S.rhu('(SELECT s FROM share)', 6)} AS matched_share,
  {S.rhu('coalesce((SELECT max(risk_score) FROM ftune t WHERE t.family = c.family AND t.risk_score < c.threshold), 0e0)', 6)} AS risk_at_threshold
FROM fchosen c JOIN fmatched USING (family)""")


@register("family_thresholds", _sql_family_thresholds)
def q_family_thresholds(spark, sf_dir):
    """A-6 .. A-8 of every family, tuned together on the tuning rows."""
    rows = [(f, t.threshold, t.matched_threshold, t.matched_share, t.risk_at_threshold)
            for f, t in Stages(spark, sf_dir).tuned_families.items()]
    df = spark.createDataFrame(rows, "family string, threshold double, matched_threshold double, matched_share double, risk_at_threshold double")
    return df.select("family", ratio("threshold"), ratio("matched_threshold", digits=9), ratio("matched_share"), ratio("risk_at_threshold"))


def _sql_family_policies():
    parts = []
    for name in ("expected_value", "threshold", "matched_to_grade_AB", "fund_all", "grade_AB"):
        base = name in ("fund_all", "grade_AB")
        family, keep = ("'baseline'", "WHERE family = 'closed_form'") if base else ("family", "")
        parts.append(f"""SELECT {family} AS family, '{name}' AS policy, count(*) FILTER (WHERE {name}) AS n, count(*) AS rows_,
  coalesce(sum(CASE WHEN {name} THEN funded_amnt END), 0e0) AS capital,
  coalesce(sum(CASE WHEN {name} THEN realized_profit END), 0e0) AS profit,
  coalesce(sum(CASE WHEN {name} THEN CAST(target AS DOUBLE) END), 0e0) AS defaults FROM flags {keep} GROUP BY 1""")
    return S.with_ctes(*_family_ctes(), f"pol AS ({' UNION ALL '.join(parts)})", select=f"""
SELECT family, policy, n AS loans_funded, {S.rhu('n / rows_', 6)} AS share_funded, {S.rhu('capital', 2)} AS capital_invested,
       {S.rhu('profit', 2)} AS total_profit, {S.rhu('CASE WHEN capital <> 0 THEN profit / capital ELSE 0e0 END', 6)} AS return_per_dollar,
       {S.rhu('CASE WHEN n > 0 THEN defaults / n ELSE 0e0 END', 6)} AS default_rate_funded
FROM pol""")


@register("family_policies", _sql_family_policies)
def q_family_policies(spark, sf_dir):
    """M-13, A-4: the test year scored once by every family; all families'
    policies and the baselines in one grouped aggregate."""
    st = Stages(spark, sf_dir)
    res = evaluate.evaluate(st.families(st.test), st.tuned_families, st.profit)
    return res.select("family", "policy", "loans_funded", ratio("share_funded"), money("capital_invested"), money("total_profit"),
                      ratio("return_per_dollar"), ratio("default_rate_funded"))


#: Cumulated Poisson(1) probabilities, to the 13th (fixed by the distribution).
def _poisson_steps() -> list[float]:
    out, term, total = [], 2.718281828459045 ** -1, 0.0
    for k in range(14):
        total += term
        out.append(total)
        term /= k + 1
    return out


def _sql_bootstrap():
    M = 2**31 - 1
    case = "CASE " + " ".join(f"WHEN u < {v!r}e0 THEN {k}" for k, v in enumerate(_poisson_steps())) + " ELSE 14 END"
    pols = sorted({c for pair in COMPARISONS.values() for c in pair})
    by_loan = ", ".join(f"bool_or(family = '{f}' AND {p}) AS {f}_{p}" for f in FAMILIES for p in ("threshold", "matched_to_grade_AB"))
    sums = ", ".join(
        f"sum(CASE WHEN {p} THEN w*funded_amnt ELSE 0e0 END) AS cap_{p}, sum(CASE WHEN {p} THEN w*realized_profit ELSE 0e0 END) AS pro_{p}"
        for p in pols
    )

    def ret(p):
        return f"(CASE WHEN cap_{p} <> 0 THEN pro_{p}/cap_{p} ELSE 0e0 END)"

    diffs = " UNION ALL ".join(
        f"SELECT '{name}' AS comparison, draw, {ret(a)} - {ret(b)} AS difference FROM per_draw"
        for name, (a, b) in COMPARISONS.items()
    )
    return S.with_ctes(
        *_family_ctes(),
        f"""loans_ AS (SELECT loan_id, any_value(funded_amnt) AS funded_amnt, any_value(realized_profit) AS realized_profit,
  true AS fund_all, bool_or(grade_AB) AS grade_AB, {by_loan} FROM flags GROUP BY loan_id)""",
        f"""flagged AS (SELECT *,
  ('0x' || substr(md5('{P.seed}-' || loan_id), 1, 8))::BIGINT % {M} AS s,
  ('0x' || substr(md5('{P.seed}-' || loan_id), 9, 8))::BIGINT % {M - 1} + 1 AS t FROM loans_)""",
        f"draws AS (SELECT range AS draw FROM range({P.bootstrap_draws}))",
        f"""weighted AS (
  SELECT f.*, d.draw, CAST((f.s + d.draw * f.t) % {M} AS DOUBLE) / {float(M)!r}e0 AS u
  FROM flagged f, draws d)""",
        f"w2 AS (SELECT *, CAST({case} AS DOUBLE) AS w FROM weighted)",
        f"per_draw AS (SELECT draw, {sums} FROM w2 GROUP BY draw)",
        f"diffs AS ({diffs})",
        select=f"""
SELECT comparison, {S.rhu('avg(difference)', 6)} AS mean_difference,
       {S.rhu('quantile_cont(difference, 0.025)', 6)} AS ci_low, {S.rhu('quantile_cont(difference, 0.975)', 6)} AS ci_high,
       {S.rhu('avg(CASE WHEN difference > 0 THEN 1e0 ELSE 0e0 END)', 6)} AS prob_better, count(*) AS draws
FROM diffs GROUP BY comparison""")


@register("bootstrap_ci", _sql_bootstrap)
def q_bootstrap(spark, sf_dir):
    """A-9: all five paired comparisons of the two families and baselines."""
    st = Stages(spark, sf_dir)
    flagged = evaluate.paired_flags(st.families(st.test), st.tuned_families, st.profit)
    diffs = policy.bootstrap_differences(flagged, COMPARISONS, P.bootstrap_draws, P.seed)
    return policy.bootstrap_summary(diffs).select(
        "comparison", ratio("mean_difference"), ratio("ci_low"), ratio("ci_high"), ratio("prob_better"), "draws"
    )
