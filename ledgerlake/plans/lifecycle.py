"""The three lifecycles as Spark jobs.

* ``train_and_evaluate``: prepare -> contract -> split -> CV (three families)
  -> select -> refit -> calibrate (first half of the validation year) -> tune
  the thresholds (second half) -> score the test year once, both families ->
  ``package`` into the registry, whose gate decides on promotion.
* ``score_applications``: quarantine -> derive -> preprocess -> model ->
  calibrator -> decision; all narrow, no shuffle.
* ``monitor``: reference = train scored by the bundle; production months
  scored once; drift, quality and alerts for all months in one job.

Only fitted statistics and metric rows reach the driver.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.functions.features import applications_to_loans, credit_policy_columns, derive_features
from ledgerlake.operators import contract, evaluate, labels, metrics, models, monitor, policy, preprocess, splits
from ledgerlake.session import cut_lineage
from ledgerlake.sources.io import BundleMetadata
from ledgerlake.sources.loan_store import loan_table, loan_window
from ledgerlake.sources.registry import BundleRegistry


@dataclass
class Decider:
    """A complete decision unit: model + calibrator + threshold + economics."""

    fitted: models.FittedModel
    calibrator: object
    threshold: float
    profit: policy.ProfitModel

    def decide(self, df: DataFrame, amount_col: str = "loan_amnt") -> DataFrame:
        scored = self.fitted.score(df, out="risk_score")
        calibrated = models.calibrate(scored, self.calibrator, score="risk_score", out="probability_of_default")
        return policy.decide(calibrated, self.threshold, self.profit, amount_col=amount_col)


def prepared_part(spark: SparkSession, sf_dir: str, name: str, p: C.Params = C.DEFAULT) -> DataFrame:
    """One split as the later stages see it: its own issue months only, labels
    and features, and of the source's columns no others than allowed (P-12)."""
    w = p.split_windows()[name]
    rows = labels.transform(loan_window(spark, sf_dir, w.start, w.end), p, check_statuses=False)
    return splits.split_part(labels.prepared_columns(rows), name, p)


#: Families with a fitted model; the first leads the comparisons.
FAMILIES = ("gbt", "logistic_regression")


def train_and_evaluate(spark: SparkSession, sf_dir: str, p: C.Params = C.DEFAULT,
                       families: tuple[str, ...] = FAMILIES, run_cv: bool = True) -> dict:
    """3.1 for all ``families`` together: every family is selected by CV,
    refitted and calibrated; tuning, the test year and the paired comparisons
    are grouped jobs over one long scored table. Without ``run_cv`` the first
    sampled configuration stands in for the winner."""
    labels.assert_statuses_classified(loan_table(spark, sf_dir))  # C-1 over all rows

    train, validation, test = (prepared_part(spark, sf_dir, n, p) for n in ("train", "validation", "test"))
    contract.validate(train)
    contract.check_missingness(train)

    cv_rows = []
    if run_cv:
        cv_rows = models.cv_grade_prior(train, p)
        for family in families:
            cv_rows += models.cv_logistic(train, p) if family == "logistic_regression" else models.cv_gbt(train, p)
    cv = models.cv_frame(spark, cv_rows)
    best = {r["family"]: r for r in models.select_best(models.cv_summary(cv)).collect()}
    first = {"logistic_regression": {"C": 0.1}, "gbt": models.sample_configs(p.gbt_search, 1, p.seed)[0]}
    fitted = {}
    for family in families:
        row = best.get(family)
        iters = [i for i in row["best_iters"] if i is not None] if row else [models.MIN_TREES]
        fitted[family] = models.refit(train, family, json.loads(row["config"]) if row else first[family], iters, p)

    profit = policy.fit_profit_model(train)
    calib, tune = splits.calibration_tuning(validation, p)
    # scored first: the fit's filter on a score would carry the whole scoring expression, inputs and all
    calibrators = {f: models.fit_isotonic(cut_lineage(m.score(calib).select("risk_score", "target"))) for f, m in fitted.items()}
    scorers = {f: lambda df, f=f: models.calibrate(fitted[f].score(df), calibrators[f]) for f in families}
    # tuning never sees the test frame
    tuned = evaluate.tune(cut_lineage(evaluate.long_scores(tune, scorers)), list(families))

    test_scored = cut_lineage(evaluate.long_scores(test, scorers))  # the test year, scored once
    out = {
        "deciders": {f: Decider(fitted[f], calibrators[f], tuned[f].threshold, profit) for f in families},
        "tuned": tuned, "profit": profit, "cv_rows": cv_rows, "best": best,
        "policy_table": evaluate.evaluate(test_scored, tuned, profit),
        "quality": metrics.quality(test_scored, group=[evaluate.FAMILY]),
        "paired": models.paired_comparison(cv, models.select_best(models.cv_summary(cv))),
    }
    if len(families) > 1:
        pairs = evaluate.comparisons(*families[:2])
        draws = policy.bootstrap_differences(evaluate.paired_flags(test_scored, tuned, profit), pairs, p.bootstrap_draws, p.seed)
        out["bootstrap"] = policy.bootstrap_summary(draws)
    return out


def package(registry: BundleRegistry, name: str, family: str, run: dict, p: C.Params = C.DEFAULT) -> str:
    """S-6: a family of a training run as a complete bundle of the registry."""
    decider, tuned = run["deciders"][family], run["tuned"][family]
    returns = {(r["family"], r["policy"]): r["return_per_dollar"] for r in run["policy_table"].collect()}
    window = p.split_windows()["train"]
    meta = BundleMetadata(
        family, decider.threshold, tuned.risk_at_threshold, decider.profit.lgd, decider.profit.prepay_factor,
        categorical_vocabulary=preprocess.vocabulary(decider.fitted.stats), train_window={"start": window.start, "end": window.end},
        cv_log_loss=float(run["best"][family]["log_loss"]) if family in run["best"] else None,
        test_return_per_dollar=float(returns[family, "threshold"]))
    return registry.add(name, meta, decider.fitted.stats, decider.fitted.model, decider.calibrator)


def judging_rows(spark: SparkSession, sf_dir: str, p: C.Params = C.DEFAULT) -> DataFrame:
    """The rows on which the gate judges bundles: the tuning half of the
    validation year, never the test year."""
    return splits.calibration_tuning(prepared_part(spark, sf_dir, "validation", p), p)[1]


def score_applications(apps: DataFrame, decider: Decider) -> tuple[DataFrame, DataFrame]:
    """3.2: (decisions for accepted requests, rejected requests with reasons)."""
    q = contract.quarantine(apps)
    accepted = credit_policy_columns_if_needed(derive_features(
        applications_to_loans(q.filter("accepted")), strict_dates=False))
    return decider.decide(accepted), q.filter(~F.col("accepted"))


def credit_policy_columns_if_needed(df: DataFrame) -> DataFrame:
    return df if "not_credit_policy" in df.columns else credit_policy_columns(df)


def run_monitoring(spark: SparkSession, sf_dir: str, decider: Decider, p: C.Params = C.DEFAULT) -> dict:
    """3.3: all months in one job keyed by batch."""
    pw = p.production
    reference = decider.decide(prepared_part(spark, sf_dir, "train", p))
    current = decider.decide(labels.production_frame(loan_window(spark, sf_dir, pw.start, pw.end), p))
    numeric, categorical = C.monitored_columns()
    inputs = numeric + categorical
    drift = monitor.numeric_drift(reference, current, numeric + [C.PREDICTION_COLUMN]).unionByName(
        monitor.categorical_drift(reference, current, categorical))
    missing = monitor.missing_increase(reference, current, inputs)
    new = monitor.new_categories(reference, current, categorical)
    summaries = monitor.batch_summaries(current, drift, missing, new, inputs)
    alerts = monitor.alert_log(monitor.missing_alerts(summaries, missing, inputs),
                               monitor.category_alerts(new), monitor.retrain_alerts(summaries))
    return {"summaries": summaries, "alerts": alerts, "drift": drift}
