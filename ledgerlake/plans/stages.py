"""Shared pipeline stages for the registered queries.

Everything is lazy; fitted statistics (profit model, thresholds) are the only
values brought to the driver, each as a handful of numbers.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.operators import labels, policy, splits
from ledgerlake.sources.loan_store import loan_table, loan_window, source_key, stage_table


def closed_form_score(prefix: str = "") -> Column:
    """The deterministic score of the loan fixture (used where a trained model
    is not needed: policy, drift, metric and audit queries)."""
    g = F.col("grade_idx")
    z = (
        F.lit(-3.2) + F.lit(0.32) * g - F.lit(0.012) * (F.col("fico_mid") - F.lit(700.0))
        + F.lit(2.5) * F.least(F.coalesce(F.col("loan_to_income"), F.lit(0.2)), F.lit(1.0))
    )
    return F.floor(F.lit(1e6) / (F.lit(1.0) + F.exp(-z)) + F.lit(0.5)) / F.lit(1e6)


def add_scores(df: DataFrame) -> DataFrame:
    """Raw score and probability columns (closed form: the two are equal)."""
    s = closed_form_score()
    return df.withColumn("risk_score", s).withColumn("probability_of_default", F.col("risk_score"))


class Stages:
    """Lazily built stages over one testdata folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: C.Params = C.DEFAULT,
                 check_statuses: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.p = params
        self.check_statuses = check_statuses

    @cached_property
    def source(self) -> str:
        """The state of the source files when these stages were asked for."""
        return source_key(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return loan_table(self.spark, self.sf_dir, self.source)

    @cached_property
    def prepared(self) -> DataFrame:
        return labels.transform(self.raw, self.p, check_statuses=self.check_statuses)

    @cached_property
    def with_split(self) -> DataFrame:
        return splits.assign_split(self.prepared, self.p)

    def stored(self, name: str, build, partition_by: str | None = None, params=None) -> DataFrame:
        """A derived stage, written once for these files and parameters."""
        return stage_table(self.spark, self.sf_dir, name, build, partition_by, self.source, (self.p, params))

    def raw_window(self, start: str, end: str) -> DataFrame:
        """Raw loans of the issue months in [start, end] (partition pruned)."""
        return loan_window(self.spark, self.sf_dir, start, end, self.source)

    def part(self, name: str) -> DataFrame:
        """One split. The C-1 guard runs once over all rows (``prepared``);
        the split itself reads only the months of its window."""
        if self.check_statuses:
            self.prepared  # noqa: B018 -- runs the guard once
        w = self.p.split_windows()[name]
        windowed = labels.transform(self.raw_window(w.start, w.end), self.p, check_statuses=False)
        return splits.split_part(windowed, name, self.p)

    @cached_property
    def train(self) -> DataFrame:
        return self.part("train")

    @cached_property
    def validation(self) -> DataFrame:
        return self.part("validation")

    @cached_property
    def test(self) -> DataFrame:
        return self.part("test")

    @cached_property
    def calib_tune(self) -> tuple[DataFrame, DataFrame]:
        return splits.calibration_tuning(self.validation, self.p)

    @cached_property
    def production(self) -> DataFrame:
        w = self.p.production
        return labels.production_frame(self.raw_window(w.start, w.end), self.p)

    # --- fitted statistics (driver gets numbers only) ---------------------

    @cached_property
    def profit(self) -> policy.ProfitModel:
        return policy.fit_profit_model(self.train)

    @cached_property
    def tuned(self) -> dict:
        """Threshold (A-6), matched threshold (A-7), risk at threshold (A-8) on
        the tuning half only."""
        _, tune = self.calib_tune
        tune = add_scores(tune)
        curve = policy.threshold_curve(tune)
        thr = policy.choose_threshold(curve)
        share = policy.grade_ab_share(tune)
        return {
            "threshold": thr,
            "matched_share": share,
            "matched_threshold": policy.threshold_for_share(tune, share),
            "calibrated_risk_at_threshold": policy.risk_at_threshold(tune, thr),
        }

    # --- two families that SQL can score too --------------------------------

    @cached_property
    def scorers(self) -> dict:
        """The closed form and the grade prior of the train rows (fitted once)."""
        from ledgerlake.operators import metrics

        rates, overall = metrics.fit_grade_prior(self.train)

        def prior(df: DataFrame) -> DataFrame:
            scored = metrics.predict_grade_prior(df, rates, overall, out="risk_score")
            return scored.withColumn("probability_of_default", F.col("risk_score"))

        return {"closed_form": add_scores, "grade_prior": prior}

    def families(self, df: DataFrame) -> DataFrame:
        from ledgerlake.operators import evaluate

        kept = ["loan_id", "grade", "grade_idx", "fico_mid", "loan_to_income", "target", "funded_amnt", "realized_profit",
                "installment", "term_months"]
        return evaluate.scored_in_one_read(df.select(*kept), self.scorers)

    @cached_property
    def tuned_families(self) -> dict:
        from ledgerlake.operators import evaluate

        # Tuning goes over its rows several times: scored and written once.
        read = ["family", "risk_score", "probability_of_default", "grade", "target", "funded_amnt", "realized_profit"]
        scored = self.stored("tuning-families", lambda: self.families(self.calib_tune[1]).select(*read))
        return evaluate.tune(scored, ["closed_form", "grade_prior"])

    def decided(self, df: DataFrame) -> DataFrame:
        """P-17 with the tuned threshold and the train profit model (serving
        amount: loan_amnt)."""
        return policy.decide(add_scores(df), self.tuned["threshold"], self.profit, amount_col="loan_amnt")

    @cached_property
    def features(self) -> DataFrame:
        from ledgerlake.functions.features import credit_policy_columns, derive_features

        return credit_policy_columns(derive_features(self.raw))

    def test_policies(self) -> tuple[DataFrame, dict[str, Column]]:
        """Scored test rows and the five policy columns of the evaluation."""
        t = self.tuned
        pm = self.profit
        test = policy.with_gain(add_scores(self.test))
        ev = policy.expected_return(F.col("probability_of_default"), F.col("gain"), F.col("funded_amnt"),
                                    pm.lgd, pm.prepay_factor)
        test = test.withColumn("_ev_pos", ev > 0)
        pos = F.col("_ev_pos")
        s = F.col("risk_score")
        cols = {
            "expected_value": pos,
            "threshold": (s < F.lit(t["threshold"])) & pos,
            "matched_to_grade_AB": (s < F.lit(t["matched_threshold"])) & pos,
            "fund_all": F.lit(True),
            "grade_AB": F.col("grade").isin("A", "B"),
        }
        return test, cols
