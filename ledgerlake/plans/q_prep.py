"""Registered queries: learned preprocessing (L-1 .. L-11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.operators import preprocess
from ledgerlake.operators.profile import unpivot
from ledgerlake.plans import oracle_sql as S
from ledgerlake.plans.registry import ratio, register
from ledgerlake.plans.stages import Stages

P = C.DEFAULT
_q = S._q
EPS10 = "2.220446049250313e-15"


def _train_test_ctes() -> list[str]:
    return [
        *S.base(P)[:4],
        "train AS (SELECT * FROM splits WHERE split = 'train')",
        "test AS (SELECT * FROM splits WHERE split = 'test')",
    ]


def _log_expr(c: str) -> str:
    cap = f"(SELECT q FROM caps WHERE \"column\" = '{c}')"
    return f"(CASE WHEN {c} IS NOT NULL THEN ln(1 + least(greatest(CAST({c} AS DOUBLE), 0e0), {cap})) END)"


def _stat_ctes() -> list[str]:
    caps = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", quantile_cont({c}, {C.CAP_PERCENTILE}) AS q FROM train" for c in C.SKEWED_AMOUNT
    )
    meds = [f"SELECT 'log_{c}' AS \"column\", quantile_cont({_log_expr(c)}, 0.5) AS q FROM train" for c in C.SKEWED_AMOUNT]
    meds += [f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.5) AS q FROM train" for c in C.NUMERIC + C.NUMERIC_WITH_INDICATOR]
    modes = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", first(level ORDER BY n DESC, level ASC) AS mode FROM "
        f"(SELECT {c} AS level, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY {c})"
        for c in C.ORDINAL
    )
    levels = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", coalesce(CAST({c} AS VARCHAR), 'unknown') AS level FROM train" for c in C.NOMINAL
    )
    return [
        f"caps AS ({caps})",
        f"meds AS ({' UNION ALL '.join(meds)})",
        f"modes AS ({modes})",
        f"lv AS (SELECT \"column\", level, count(*) AS n FROM ({levels}) GROUP BY ALL)",
        "tot AS (SELECT count(*) AS n_train FROM train)",
        f"cls AS (SELECT lv.*, n >= {C.RARE_CATEGORY_MIN_FREQUENCY}e0 * (SELECT n_train FROM tot) AS frequent FROM lv)",
        """outs_all AS (
  SELECT "column", level, frequent,
         CASE WHEN frequent THEN "column" || '_' || level ELSE "column" || '_infrequent_sklearn' END AS output_column
  FROM cls)""",
        """nout AS (
  SELECT "column", count(DISTINCT output_column) AS n_out, min(level) AS first_level FROM outs_all GROUP BY "column")""",
        """vocab AS (
  SELECT o.*, (n.n_out = 2 AND o.output_column = f.output_column) AS dropped
  FROM outs_all o JOIN nout n ON o."column" = n."column"
  JOIN outs_all f ON f."column" = n."column" AND f.level = n.first_level)""",
    ]


# --- prep_stats ------------------------------------------------------------------

def _sql_prep_stats():
    return S.with_ctes(*_train_test_ctes(), *_stat_ctes(), select=f"""
SELECT "column", 'cap' AS stat, {S.rhu('q', 6)} AS value, CAST(NULL AS VARCHAR) AS text FROM caps
UNION ALL SELECT "column", 'median', {S.rhu('coalesce(q, 0e0)', 6)}, NULL FROM meds
UNION ALL SELECT "column", 'mode', NULL, mode FROM modes""")


@register("prep_stats", _sql_prep_stats)
def q_prep_stats(spark, sf_dir):
    """L-1, L-2, L-3, L-6: caps, medians (after log) and modes fitted on train."""
    st = Stages(spark, sf_dir)
    stats = preprocess.fit(st.train, "tree")
    rows = [r for r in preprocess.stats_long(stats) if r[1] in ("cap", "median", "mode")]
    df = spark.createDataFrame(rows, "column string, stat string, value double, text string")
    return df.select("column", "stat", ratio("value"), "text")


# --- onehot_vocabulary -------------------------------------------------------------

def _sql_vocab():
    return S.with_ctes(*_train_test_ctes(), *_stat_ctes(), select="""
SELECT v."column", v.level, l.n AS loans, v.frequent, v.output_column, v.dropped
FROM vocab v JOIN lv l ON v."column" = l."column" AND v.level = l.level""")


@register("onehot_vocabulary", _sql_vocab)
def q_vocab(spark, sf_dir):
    """L-7, L-11: trained levels, frequency class, output column, dropped flag."""
    st = Stages(spark, sf_dir)
    stats = preprocess.fit(st.train, "tree")
    rows = []
    for c in C.NOMINAL:
        freq = set(stats.frequent[c])
        for lv in stats.levels[c]:
            out = f"{c}_{lv}" if lv in freq else f"{c}_{preprocess.INFREQUENT}"
            rows.append((c, lv, stats.level_counts[c][lv], lv in freq, out, out == stats.dropped.get(c)))
    return spark.createDataFrame(rows, "column string, level string, loans long, frequent boolean, output_column string, dropped boolean")


# --- prep_matrix -------------------------------------------------------------------

def _enc_long(src: str) -> str:
    """Long-form encoded rows of ``src`` (loan_id, feature, value), unscaled."""
    parts = []
    for c in C.SKEWED_AMOUNT:
        med = f"coalesce((SELECT q FROM meds WHERE \"column\" = 'log_{c}'), 0e0)"
        parts.append(f"SELECT loan_id, 'log_{c}' AS feature, coalesce({_log_expr(c)}, {med}) AS value FROM {src}")
    for c in C.NUMERIC + C.NUMERIC_WITH_INDICATOR:
        med = f"coalesce((SELECT q FROM meds WHERE \"column\" = '{c}'), 0e0)"
        parts.append(f"SELECT loan_id, '{c}', coalesce(CAST({c} AS DOUBLE), {med}) FROM {src}")
    for c in C.NUMERIC_WITH_INDICATOR:
        parts.append(f"SELECT loan_id, 'missingindicator_{c}', CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END FROM {src}")
    for c in C.STRUCTURAL_MISSING:
        parts.append(f"SELECT loan_id, '{c}', coalesce(CAST({c} AS DOUBLE), 999e0) FROM {src}")
    for c, levels in preprocess.ordinal_levels().items():
        arr = "[" + ", ".join(f"'{v}'" for v in levels) + "]"
        pos = f"list_position({arr}, coalesce({c}, (SELECT mode FROM modes WHERE \"column\" = '{c}')))"
        parts.append(f"SELECT loan_id, '{c}', CAST(coalesce({pos} - 1, -1) AS DOUBLE) FROM {src}")
    for c in C.BOOLEAN:
        parts.append(f"SELECT loan_id, '{c}', CAST({c} AS DOUBLE) FROM {src}")
    for c in C.NOMINAL:
        parts.append(f"""SELECT r.loan_id, o.output_column,
  CASE WHEN o.frequent THEN (CASE WHEN r.lvl = o.level THEN 1e0 ELSE 0e0 END)
       ELSE (CASE WHEN r.lvl IN (SELECT level FROM vocab WHERE "column" = '{c}' AND frequent) THEN 0e0 ELSE 1e0 END) END
FROM (SELECT loan_id, coalesce(CAST({c} AS VARCHAR), 'unknown') AS lvl FROM {src}) r
JOIN (SELECT DISTINCT output_column, frequent, CASE WHEN frequent THEN level END AS level FROM vocab
      WHERE "column" = '{c}' AND NOT dropped) o ON TRUE""")
    return " UNION ALL ".join(parts)


def _sql_prep_matrix():
    return S.with_ctes(
        *_train_test_ctes(), *_stat_ctes(),
        f"enc_train AS ({_enc_long('train')})",
        f"enc_test AS ({_enc_long('test')})",
        f"""sc AS (SELECT feature, avg(value) AS mean,
  CASE WHEN stddev_pop(value) < {EPS10} THEN 1e0 ELSE stddev_pop(value) END AS scale FROM enc_train GROUP BY feature)""",
        select=f"""
SELECT t.loan_id, t.feature, {S.rhu('(t.value - sc.mean) / sc.scale', 6)} AS value
FROM enc_test t JOIN sc ON t.feature = sc.feature""")


@register("prep_matrix", _sql_prep_matrix)
def q_prep_matrix(spark, sf_dir):
    """L-1 .. L-10 (linear variant, incl. scaling): test rows transformed with
    statistics fitted on train only; long form (loan_id, feature, value)."""
    st = Stages(spark, sf_dir)
    stats = preprocess.fit(st.train, "linear")
    wide = preprocess.apply(st.test, stats, keep=("loan_id",))
    long = unpivot(wide, preprocess.feature_names(stats), keep=("loan_id",))
    return long.select("loan_id", F.col("column").alias("feature"), ratio("value"))
