"""Registered queries: group audit (A-10 .. A-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.operators import audit
from ledgerlake.plans import oracle_sql as S
from ledgerlake.plans.q_policy import policy_ctes
from ledgerlake.plans.q_profile import decided_cte
from ledgerlake.plans.registry import ratio, register
from ledgerlake.plans.stages import Stages

P = C.DEFAULT


def _scored_test(spark, sf_dir):
    st = Stages(spark, sf_dir)
    return st.decided(st.test).withColumn("funded", F.col("decision") == "fund")


def groups_cte() -> list[str]:
    parts = [
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS "group", count(*) AS n,
  avg(CASE WHEN funded THEN 1e0 ELSE 0e0 END) AS fund_rate, avg(risk_score) AS mean_score,
  avg(CAST(target AS DOUBLE)) AS default_rate, avg(CASE WHEN funded THEN CAST(target AS DOUBLE) END) AS default_if_funded,
  count(*) FILTER (WHERE funded) AS n_funded FROM test_f GROUP BY {c}"""
        for c in C.FAIRNESS_COLUMNS
    ]
    return [
        *policy_ctes(), decided_cte("test", "test_dec"),
        "test_f AS (SELECT *, decision = 'fund' AS funded FROM test_dec)",
        f"groups AS (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n >= {P.min_group_size})",
    ]


def _sql_group_audit():
    return S.with_ctes(*groups_cte(), select=f"""
SELECT "column", "group", n, {S.rhu('fund_rate', 6)} AS fund_rate, {S.rhu('mean_score', 6)} AS mean_score,
       {S.rhu('default_rate', 6)} AS default_rate, {S.rhu('default_if_funded', 6)} AS default_if_funded, n_funded
FROM groups""")


@register("group_audit", _sql_group_audit)
def q_group_audit(spark, sf_dir):
    """A-10: per-group funding and outcome table, three columns in one pass."""
    g = audit.by_group(_scored_test(spark, sf_dir), min_count=P.min_group_size)
    return g.select("column", "group", "n", ratio("fund_rate"), ratio("mean_score"), ratio("default_rate"),
                    ratio("default_if_funded"), "n_funded")


def _sql_disparity():
    sx, sy = "stddev_pop(mean_score)", "stddev_pop(default_rate)"
    corr = f"CASE WHEN count(*) > 1 AND {sx} > 0 AND {sy} > 0 THEN covar_pop(mean_score, default_rate) / ({sx} * {sy}) END"
    enough = f"n_funded >= {P.min_funded_for_error}"
    return S.with_ctes(*groups_cte(), select=f"""
SELECT "column", count(*) AS groups,
  first("group" ORDER BY fund_rate ASC, "group" ASC) AS fund_rate_min_group, {S.rhu('min(fund_rate)', 6)} AS fund_rate_min,
  first("group" ORDER BY fund_rate DESC, "group" ASC) AS fund_rate_max_group, {S.rhu('max(fund_rate)', 6)} AS fund_rate_max,
  {S.rhu('max(fund_rate) - min(fund_rate)', 6)} AS fund_rate_spread,
  {S.rhu(f'min(CASE WHEN {enough} THEN default_if_funded END)', 6)} AS default_if_funded_min,
  {S.rhu(f'max(CASE WHEN {enough} THEN default_if_funded END)', 6)} AS default_if_funded_max,
  {S.rhu(corr, 6)} AS score_vs_outcome_correlation
FROM groups GROUP BY "column\"""")


@register("group_disparity", _sql_disparity)
def q_disparity(spark, sf_dir):
    """A-11: disparity summary per audited column."""
    g = audit.by_group(_scored_test(spark, sf_dir), min_count=P.min_group_size)
    d = audit.disparity(g, P.min_funded_for_error)
    return d.select(
        "column", "groups", "fund_rate_min_group", ratio("fund_rate_min"), "fund_rate_max_group", ratio("fund_rate_max"),
        ratio("fund_rate_spread"), ratio("default_if_funded_min"), ratio("default_if_funded_max"),
        ratio("score_vs_outcome_correlation"),
    )


def _sql_totals():
    return S.with_ctes(*groups_cte()[:-1], select=f"""
SELECT count(*) AS test_loans, {S.rhu('avg(CASE WHEN funded THEN 1e0 ELSE 0e0 END)', 6)} AS overall_fund_rate,
       {S.rhu('avg(CASE WHEN funded THEN CAST(target AS DOUBLE) END)', 6)} AS overall_default_if_funded
FROM test_f""")


@register("audit_totals", _sql_totals)
def q_totals(spark, sf_dir):
    """A-12: test loans, overall fund rate, default rate among funded."""
    t = audit.totals(_scored_test(spark, sf_dir))
    return t.select("test_loans", ratio("overall_fund_rate"), ratio("overall_default_if_funded"))


# --- G-1, G-2 -------------------------------------------------------------------------

def _sql_gate():
    ev = "((1 - risk_score) * (installment*term_months - loan_amnt) * (SELECT prepay_factor FROM pm) - risk_score * (SELECT lgd FROM pm) * loan_amnt)"

    def decided(name, thr):
        return (f"SELECT '{name}' AS bundle, funded_amnt, realized_profit, "
                f"CASE WHEN risk_score >= {thr} OR {ev} <= 0 THEN 'decline' ELSE 'fund' END AS decision FROM tune")

    fmt = lambda x: f"printf('%+.5f', {S.rhu(x, 5)})"
    m = C.PROMOTION_MARGIN
    return S.with_ctes(
        *policy_ctes(),
        f"gated AS ({decided('candidate', '(SELECT threshold FROM chosen)')} UNION ALL {decided('champion', '(SELECT matched_threshold FROM matched)')})",
        """ret AS (SELECT bundle, CASE WHEN coalesce(sum(CASE WHEN decision = 'fund' THEN funded_amnt END), 0e0) <> 0
  THEN sum(CASE WHEN decision = 'fund' THEN realized_profit END) / sum(CASE WHEN decision = 'fund' THEN funded_amnt END) ELSE 0e0 END AS r
  FROM gated GROUP BY bundle)""",
        "cmp AS (SELECT max(CASE WHEN bundle = 'candidate' THEN r END) AS c, max(CASE WHEN bundle = 'champion' THEN r END) AS h FROM ret)",
        select=f"""
SELECT CASE WHEN h IS NULL THEN TRUE ELSE c - h > {m}e0 END AS promote, {S.rhu('c', 6)} AS candidate_return,
       {S.rhu('h', 6)} AS champion_return, {m}e0 AS margin,
       CASE WHEN h IS NULL THEN 'no model in production yet' ELSE
         'candidate ' || {fmt('c')} || ' vs champion ' || {fmt('h')} || ' (' || {fmt('c - h')} || ', '
         || CASE WHEN c - h > {m}e0 THEN 'above' ELSE 'below' END || ' the {m} margin)' END AS reason
FROM cmp""")


@register("promotion_gate", _sql_gate)
def q_gate(spark, sf_dir):
    """G-1 + G-2: candidate (tuned threshold) vs champion (matched-share
    threshold), both scored on the tuning rows, never on the test year."""
    from ledgerlake.operators import gate, policy
    from ledgerlake.plans.stages import add_scores

    st = Stages(spark, sf_dir)
    _, tune = st.calib_tune
    t = st.tuned
    scored = add_scores(tune)
    cand = policy.decide(scored, t["threshold"], st.profit).withColumn("bundle", F.lit("candidate"))
    champ = policy.decide(scored, t["matched_threshold"], st.profit).withColumn("bundle", F.lit("champion"))
    cols = ["bundle", "funded_amnt", "realized_profit", "decision"]
    returns = gate.bundle_returns(cand.select(*cols).unionByName(champ.select(*cols)))
    d = gate.promotion_decision(returns, P.promotion_margin)
    return d.select("promote", ratio("candidate_return"), ratio("champion_return"), "margin", "reason")


# --- S-6, G-1, G-2 on saved bundles ----------------------------------------------------------

#: (case, bundle that is champion before, candidate); the margin decides between them.
GATE_CASES = (("first", None, "grade_prior"), ("better", "grade_prior", "closed_form"), ("worse", "closed_form", "grade_prior"),
              ("same", "closed_form", "closed_form"))


def _sql_gate_cases():
    from ledgerlake.plans.q_policy import _family_ctes

    ev = "((1 - risk_score) * gain * (SELECT prepay_factor FROM pm) - risk_score * (SELECT lgd FROM pm) * funded_amnt) > 0"
    fund = f"risk_score < threshold AND {ev}"
    values = ", ".join(f"('{case}', {'NULL' if h is None else repr(h)}, '{c}')" for case, h, c in GATE_CASES)
    return S.with_ctes(
        *_family_ctes(),
        f"""ret AS (SELECT family, CASE WHEN coalesce(sum(CASE WHEN {fund} THEN funded_amnt END), 0e0) <> 0
    THEN sum(CASE WHEN {fund} THEN realized_profit END) / sum(CASE WHEN {fund} THEN funded_amnt END) ELSE 0e0 END AS r
  FROM ftune JOIN fchosen USING (family) GROUP BY family)""",
        f"cases(gate_case, champion, candidate) AS (VALUES {values})",
        f"""d AS (SELECT gate_case, champion, candidate, c.r AS candidate_return, h.r AS champion_return,
    champion IS NULL OR c.r - h.r > {P.promotion_margin} AS promote
  FROM cases JOIN ret c ON c.family = candidate LEFT JOIN ret h ON h.family = champion)""",
        select=f"""
SELECT gate_case, promote, {S.rhu('candidate_return', 6)} AS candidate_return, {S.rhu('champion_return', 6)} AS champion_return,
  CASE WHEN promote THEN candidate ELSE champion END AS champion_after FROM d""")


@register("gate_cases", _sql_gate_cases)
def q_gate_cases(spark, sf_dir):
    """G-1, G-2 on bundles saved in, and loaded from, a registry in the shared
    folder: no champion yet, a better, a worse and an equal candidate."""
    import uuid

    from ledgerlake.plans.stages import add_scores
    from ledgerlake.session import session_folder
    from ledgerlake.sources.io import BundleMetadata
    from ledgerlake.sources.registry import BundleRegistry, rate_scorer

    st = Stages(spark, sf_dir)
    grades = st.train.groupBy("grade").agg(F.avg(F.col("target").cast("double")).alias("r"))
    rates = {r["grade"]: r["r"] for r in grades.collect()} | {"": float(st.train.agg(F.avg(F.col("target").cast("double"))).first()[0])}
    expressions = {"closed_form": lambda _: add_scores, "grade_prior": rate_scorer("grade")}
    tune = st.calib_tune[1]
    rows = []
    for case, champion, candidate in GATE_CASES:
        registry = BundleRegistry(spark, session_folder(spark, f"registry-{uuid.uuid4().hex[:10]}"))
        for turn, family in enumerate([champion, candidate] if champion else [candidate]):
            t = st.tuned_families[family]
            meta = BundleMetadata(family, t.threshold, t.risk_at_threshold, st.profit.lgd, st.profit.prepay_factor,
                                  rates=rates if family == "grade_prior" else {})
            found = registry.gate(registry.add(f"{turn}-{family}", meta), tune, P.promotion_margin, expressions)
        rows.append((case, found["promote"], found["candidate_return"], found["champion_return"], registry.champion().split("-", 1)[1]))
    df = spark.createDataFrame(rows, "gate_case string, promote boolean, candidate_return double, champion_return double, champion_after string")
    return df.select("gate_case", "promote", ratio("candidate_return"), ratio("champion_return"), "champion_after")
