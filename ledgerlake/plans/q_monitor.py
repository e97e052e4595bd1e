"""Registered queries: monitoring (D-1 .. D-11).

Reference = the train split scored by the deployed rule; production = the
production window (unlabelled rows kept) scored and decided the same way.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.operators import monitor
from ledgerlake.plans import oracle_sql as S
from ledgerlake.plans.q_policy import policy_ctes
from ledgerlake.plans.q_profile import decided_cte, production_cte
from ledgerlake.plans.registry import ratio, register
from ledgerlake.plans.stages import Stages, add_scores

P = C.DEFAULT
NUMERIC, CATEGORICAL = C.monitored_columns()
INPUTS = NUMERIC + CATEGORICAL
NUMERIC_WITH_PRED = NUMERIC + [C.PREDICTION_COLUMN]


class Monitoring:
    """Lazily built monitoring tables over one testdata folder."""

    def __init__(self, spark, sf_dir):
        self.st = Stages(spark, sf_dir)

    @cached_property
    def reference(self):
        """The watched columns of the scored train split, written once (read by
        four drift/quality jobs)."""
        return self.st.stored("reference", lambda: add_scores(self.st.train).select(*INPUTS, C.PREDICTION_COLUMN))

    @cached_property
    def current(self):
        """S-4: the scored and decided production window written once,
        partitioned by month (``batch``); every monitoring job reads it."""
        return self.st.stored("batches", lambda: self.st.decided(self.st.production), partition_by="batch")

    @cached_property
    def drift(self):
        """All (batch, column) drift values, written once per application: the
        summaries and every alert query read this table."""
        def build():
            num = monitor.numeric_drift(self.reference, self.current, NUMERIC_WITH_PRED)
            cat = monitor.categorical_drift(self.reference, self.current, CATEGORICAL)
            return num.unionByName(cat)

        return self.st.stored("drift", build)

    @cached_property
    def missing(self):
        return monitor.missing_increase(self.reference, self.current, INPUTS)

    @cached_property
    def new_cats(self):
        return monitor.new_categories(self.reference, self.current, CATEGORICAL)

    @cached_property
    def summaries(self):
        return monitor.batch_summaries(self.current, self.drift, self.missing, self.new_cats, INPUTS)


# --- SQL building blocks -------------------------------------------------------------

def _cat_expr(c: str) -> str:
    if c in C.BOOLEAN:
        return f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' END"
    return f"CAST({c} AS VARCHAR)"


def monitor_ctes() -> list[str]:
    num_ref = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM train WHERE {c} IS NOT NULL" for c in NUMERIC_WITH_PRED)
    num_cur = " UNION ALL ".join(f"SELECT batch, '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM prod_dec WHERE {c} IS NOT NULL" for c in NUMERIC_WITH_PRED)
    cat_ref = " UNION ALL ".join(f"SELECT '{c}' AS col, {_cat_expr(c)} AS v FROM train WHERE {c} IS NOT NULL" for c in CATEGORICAL)
    cat_cur = " UNION ALL ".join(f"SELECT batch, '{c}' AS col, {_cat_expr(c)} AS v FROM prod_dec WHERE {c} IS NOT NULL" for c in CATEGORICAL)
    return [
        *policy_ctes(), production_cte(), decided_cte("production", "prod_dec"),
        "train AS (SELECT * FROM scored WHERE split = 'train')",
        f"nref AS ({num_ref})", f"ncur AS ({num_cur})",
        "ref_stat AS (SELECT col, count(*) AS N, stddev_pop(v) AS sd FROM nref GROUP BY col)",
        "cur_stat AS (SELECT batch, col, count(*) AS Nb FROM ncur GROUP BY batch, col)",
        "months AS (SELECT DISTINCT batch FROM prod_dec)",
        """npts AS (
  SELECT batch, col, v, sum(nr) AS nr, sum(nc) AS nc FROM (
    SELECT m.batch, r.col, r.v, r.nr, 0 AS nc FROM (SELECT col, v, count(*) AS nr FROM nref GROUP BY col, v) r, months m
    UNION ALL SELECT batch, col, v, 0, count(*) FROM ncur GROUP BY batch, col, v) GROUP BY batch, col, v)""",
        """ncdf AS (
  SELECT p.batch, p.col, p.v,
         sum(nr) OVER w / rs.N AS Fr, sum(nc) OVER w / cs.Nb AS Gc,
         lead(p.v) OVER (PARTITION BY p.batch, p.col ORDER BY p.v) - p.v AS gap, rs.sd
  FROM npts p JOIN ref_stat rs ON p.col = rs.col JOIN cur_stat cs ON p.batch = cs.batch AND p.col = cs.col
  WINDOW w AS (PARTITION BY p.batch, p.col ORDER BY p.v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        f"""ndrift AS (SELECT batch, col, sum(abs(Fr - Gc) * coalesce(gap, 0e0)) / greatest(max(sd), {C.STD_FLOOR}e0) AS drift
  FROM ncdf GROUP BY batch, col)""",
        f"cref AS ({cat_ref})", f"ccur AS ({cat_cur})",
        """cpts AS (
  SELECT batch, col, v, sum(nr) AS nr, sum(nc) AS nc FROM (
    SELECT m.batch, r.col, r.v, r.nr, 0 AS nc FROM (SELECT col, v, count(*) AS nr FROM cref GROUP BY col, v) r, months m
    UNION ALL SELECT batch, col, v, 0, count(*) FROM ccur GROUP BY batch, col, v) GROUP BY batch, col, v)""",
        """cshare AS (
  SELECT batch, col, v, nr / sum(nr) OVER (PARTITION BY batch, col) AS p, nc / sum(nc) OVER (PARTITION BY batch, col) AS q FROM cpts)""",
        """cdrift AS (
  SELECT batch, col, sqrt(greatest(0e0, (
     sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0e0 END)
   + sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0e0 END)) / 2)) AS drift
  FROM cshare GROUP BY batch, col HAVING sum(q) > 0)""",
        "drift AS (SELECT * FROM ndrift UNION ALL SELECT * FROM cdrift)",
    ]


def quality_ctes() -> list[str]:
    ref_sh = " UNION ALL ".join(f"SELECT '{c}' AS col, avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END) AS s FROM train" for c in INPUTS)
    cur_sh = " UNION ALL ".join(f"SELECT batch, '{c}' AS col, avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END) AS s FROM prod_dec GROUP BY batch" for c in INPUTS)
    return [
        f"ref_null AS ({ref_sh})", f"cur_null AS ({cur_sh})",
        f"missing AS (SELECT * FROM (SELECT c.batch, c.col, {S.rhu('c.s - r.s', 4)} AS increase FROM cur_null c JOIN ref_null r ON c.col = r.col) WHERE increase > 0)",
        "newcats AS (SELECT DISTINCT batch, col, v FROM ccur ANTI JOIN (SELECT DISTINCT col, v FROM cref) r USING (col, v))",
    ]


def summary_ctes() -> list[str]:
    inputs = S._q(INPUTS)
    return [
        *monitor_ctes(), *quality_ctes(),
        f"""summ AS (
  SELECT b.batch, b.loans,
    {S.rhu(f'coalesce(d.n_drifted, 0) / {float(len(INPUTS))!r}e0', 4)} AS drift_share,
    {S.rhu('coalesce(d.pred, 0e0)', 4)} AS prediction_drift,
    coalesce(d.drifted, '') AS drifted_columns,
    {S.rhu('b.fund_rate', 4)} AS fund_rate, {S.rhu('b.mean_probability', 4)} AS mean_probability,
    {S.rhu('b.outcome_known', 4)} AS outcome_known,
    coalesce(mi.txt, '') AS missing_increase, coalesce(nc.txt, '') AS new_categories
  FROM (SELECT batch, count(*) AS loans, avg(CASE WHEN decision = 'fund' THEN 1e0 ELSE 0e0 END) AS fund_rate,
               avg(probability_of_default) AS mean_probability, avg(CASE WHEN outcome_known THEN 1e0 ELSE 0e0 END) AS outcome_known
        FROM prod_dec GROUP BY batch) b
  LEFT JOIN (SELECT batch, count(*) FILTER (WHERE col IN ({inputs}) AND drift > {C.DRIFT_THRESHOLD}e0) AS n_drifted,
                    string_agg(col, ',' ORDER BY col) FILTER (WHERE col IN ({inputs}) AND drift > {C.DRIFT_THRESHOLD}e0) AS drifted,
                    max(drift) FILTER (WHERE col = '{C.PREDICTION_COLUMN}') AS pred
             FROM drift GROUP BY batch) d ON b.batch = d.batch
  LEFT JOIN (SELECT batch, string_agg(col || ':' || printf('%.4f', increase), ';' ORDER BY col || ':' || printf('%.4f', increase)) AS txt
             FROM missing GROUP BY batch) mi ON b.batch = mi.batch
  LEFT JOIN (SELECT batch, string_agg(col || '=' || v, ';' ORDER BY col || '=' || v) AS txt FROM newcats GROUP BY batch) nc ON b.batch = nc.batch)""",
    ]


# --- queries --------------------------------------------------------------------------

def _sql_numeric_drift():
    return S.with_ctes(*monitor_ctes(), select=f"SELECT batch, col AS \"column\", {S.rhu('drift', 6)} AS drift FROM ndrift")


@register("numeric_drift", _sql_numeric_drift)
def q_numeric_drift(spark, sf_dir):
    """D-1, D-2: normed Wasserstein drift per month and numeric input (+ score)."""
    m = Monitoring(spark, sf_dir)
    d = m.drift.filter(F.col("column").isin(*NUMERIC_WITH_PRED))
    return d.select("batch", "column", ratio("drift"))


def _sql_categorical_drift():
    return S.with_ctes(*monitor_ctes(), select=f"SELECT batch, col AS \"column\", {S.rhu('drift', 6)} AS drift FROM cdrift")


@register("categorical_drift", _sql_categorical_drift)
def q_categorical_drift(spark, sf_dir):
    """D-3: Jensen-Shannon distance per month and categorical input."""
    m = Monitoring(spark, sf_dir)
    d = m.drift.filter(F.col("column").isin(*CATEGORICAL))
    return d.select("batch", "column", ratio("drift"))


def _sql_missing():
    return S.with_ctes(*monitor_ctes(), *quality_ctes(), select="SELECT batch, col AS \"column\", increase FROM missing")


@register("missing_increase", _sql_missing)
def q_missing(spark, sf_dir):
    """D-5: missing-share increase vs the reference, > 0 only."""
    return Monitoring(spark, sf_dir).missing.select("batch", "column", "increase")


def _sql_new_cats():
    return S.with_ctes(*monitor_ctes(), *quality_ctes(), select="SELECT batch, col AS \"column\", v AS value FROM newcats")


@register("new_categories", _sql_new_cats)
def q_new_cats(spark, sf_dir):
    """D-6: values never seen in the reference, per month."""
    return Monitoring(spark, sf_dir).new_cats.select("batch", "column", "value")


def _sql_summaries():
    return S.with_ctes(*summary_ctes(), select="SELECT * FROM summ")


@register("batch_summaries", _sql_summaries)
def q_summaries(spark, sf_dir):
    """D-4: one summary row per month."""
    return Monitoring(spark, sf_dir).summaries


def retrain_ctes() -> list[str]:
    ds, pd = "drift_share", "prediction_drift"
    crossed = (
        f"concat_ws('; ', CASE WHEN {ds} > {C.TRIGGER_DRIFT_SHARE}e0 THEN 'drift share ' || printf('%.2f', {S.rhu(ds, 2)}) || ' > {C.TRIGGER_DRIFT_SHARE}' END, "
        f"CASE WHEN {pd} > {C.TRIGGER_PREDICTION_DRIFT}e0 THEN 'prediction drift ' || printf('%.3f', {S.rhu(pd, 3)}) || ' > {C.TRIGGER_PREDICTION_DRIFT}' END)"
    )
    return [
        *summary_ctes(),
        f"br AS (SELECT *, ({ds} > {C.TRIGGER_DRIFT_SHARE}e0 OR {pd} > {C.TRIGGER_PREDICTION_DRIFT}e0) AS breach, {crossed} AS crossed FROM summ)",
        "isl AS (SELECT *, sum(CASE WHEN breach THEN 0 ELSE 1 END) OVER (ORDER BY batch ROWS UNBOUNDED PRECEDING) AS island FROM br)",
        "runs AS (SELECT *, sum(CASE WHEN breach THEN 1 ELSE 0 END) OVER (PARTITION BY island ORDER BY batch ROWS UNBOUNDED PRECEDING) AS run FROM isl)",
        f"""retrain AS (SELECT 'retrain' AS kind, batch, CAST(run AS VARCHAR) || ' consecutive months above threshold (' || crossed || ')' AS reason
  FROM runs WHERE breach AND run = {C.TRIGGER_CONSECUTIVE_MONTHS})""",
        "bidx AS (SELECT batch, row_number() OVER (ORDER BY batch) AS bi FROM summ)",
        f"""mbr AS (SELECT m.*, b.bi, lag(b.bi) OVER (PARTITION BY m.col ORDER BY b.bi) AS prev
  FROM missing m JOIN bidx b ON m.batch = b.batch WHERE m.increase > {C.TRIGGER_MAX_MISSING_INCREASE}e0)""",
        f"""missing_alerts AS (SELECT 'investigate' AS kind, batch,
  'missing values jumped vs reference: ' || string_agg(col || ' +' || CAST(CAST(floor(increase * 100 + 0.5) AS BIGINT) AS VARCHAR) || '%', ', '
     ORDER BY -increase, list_position({('[' + ', '.join(repr(c) for c in INPUTS) + ']')}, col)) AS reason
  FROM mbr WHERE prev IS NULL OR prev <> bi - 1 GROUP BY batch)""",
        """category_alerts AS (SELECT 'investigate' AS kind, batch,
  'categories never seen in training: ' || string_agg(col || '=' || v, ', ' ORDER BY col, v) AS reason
  FROM (SELECT col, v, min(batch) AS batch FROM newcats GROUP BY col, v) GROUP BY batch)""",
    ]


@register("retrain_alerts", lambda: S.with_ctes(*retrain_ctes(), select="SELECT * FROM retrain"))
def q_retrain(spark, sf_dir):
    """D-7, D-8: retrain alert once per episode of consecutive breaching months."""
    return monitor.retrain_alerts(Monitoring(spark, sf_dir).summaries)


@register("missing_alerts", lambda: S.with_ctes(*retrain_ctes(), select="SELECT * FROM missing_alerts"))
def q_missing_alerts(spark, sf_dir):
    """D-9: missing-value jump alerts (suppressed while the jump persists)."""
    m = Monitoring(spark, sf_dir)
    return monitor.missing_alerts(m.summaries, m.missing, INPUTS)


#: Months of the thinned view in which half of the loans lack a column: a jump
#: that lasts two months, and one that comes back.
THINNED = {"revol_util": ("2001-03", "2001-04", "2001-07"), "dti": ("2001-04", "2001-05")}


def _sql_missing_jumps():
    thin = ", ".join(f"CASE WHEN batch IN ({S._q(months)}) AND substr(md5(loan_id), 1, 1) < '8' THEN NULL ELSE {c} END AS {c}"
                     for c, months in THINNED.items())
    quality = quality_ctes()
    return S.with_ctes(
        *policy_ctes(), production_cte(), decided_cte("production", "prod_dec"),
        "train AS (SELECT * FROM scored WHERE split = 'train')",
        f"prod_thin AS (SELECT * REPLACE ({thin}) FROM prod_dec)",
        *[c.replace("FROM prod_dec", "FROM prod_thin") for c in quality[:3]],
        "bidx AS (SELECT batch, row_number() OVER (ORDER BY batch) AS bi FROM (SELECT DISTINCT batch FROM prod_thin))",
        *[c for c in retrain_ctes() if c.startswith(("mbr AS", "missing_alerts AS"))],
        select="SELECT * FROM missing_alerts")


@register("missing_jumps", _sql_missing_jumps)
def q_missing_jumps(spark, sf_dir):
    """D-9 on a view of the production months in which values go missing: each
    jump alerts in its first month, is silent while it lasts, and alerts again
    after a recovery."""
    m = Monitoring(spark, sf_dir)
    lost = F.substring(F.md5(F.col("loan_id").cast("string")), 1, 1) < "8"
    current = m.current.withColumns({
        c: F.when(F.col("batch").isin(*months) & lost, F.lit(None)).otherwise(F.col(c)) for c, months in THINNED.items()})
    missing = monitor.missing_increase(m.reference, current, INPUTS)
    return monitor.missing_alerts(current.select("batch").distinct(), missing, INPUTS)


@register("category_alerts", lambda: S.with_ctes(*retrain_ctes(), select="SELECT * FROM category_alerts"))
def q_category_alerts(spark, sf_dir):
    """D-10: each new category alerts once, in its first month."""
    return monitor.category_alerts(Monitoring(spark, sf_dir).new_cats)


def _sql_alert_log():
    return S.with_ctes(*retrain_ctes(), select="""
SELECT kind, batch, reason, 1 AS seq FROM missing_alerts
UNION ALL SELECT kind, batch, reason, 2 FROM category_alerts
UNION ALL SELECT kind, batch, reason, 3 FROM retrain""")


@register("alert_log", _sql_alert_log)
def q_alert_log(spark, sf_dir):
    """D-11: the alert log (order within a month: missing, category, retrain)."""
    m = Monitoring(spark, sf_dir)
    return monitor.alert_log(
        monitor.missing_alerts(m.summaries, m.missing, INPUTS),
        monitor.category_alerts(m.new_cats),
        monitor.retrain_alerts(m.summaries),
    ).select("kind", "batch", "reason", "seq")
