"""A registry of decision bundles in a shared folder, and the promotion gate
over what is saved there (S-6, G-1, G-2).

``bundles/<name>`` holds one complete bundle each (``io.save_bundle``: versions,
metadata last). ``promotions`` is an append-only table of the gate's decisions;
the champion is the bundle of the last one that promoted. A run that fails
between the two leaves the champion as it was.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.operators import gate, models, policy
from ledgerlake.sources import io

_PROMOTIONS = "seq long, bundle string, promote boolean, candidate_return double, champion_return double, margin double, reason string"
#: Model class of a family; families without one score by an expression.
MODELS = {"logistic_regression": LogisticRegressionModel, "gbt": GBTClassificationModel}

Scorer = Callable[[DataFrame], DataFrame]


class BundleRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def add(self, name: str, meta: io.BundleMetadata, stats=None, model=None, calibrator=None) -> str:
        """Save a complete bundle; refuses a name that is taken."""
        io.save_bundle(self.spark, f"{self.root}/bundles/{name}", meta, stats, model, calibrator)
        return name

    def history(self) -> DataFrame:
        """All decisions so far (no row before the first)."""
        try:
            return self.spark.read.schema(_PROMOTIONS).json(f"{self.root}/promotions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _PROMOTIONS)

    def champion(self) -> str | None:
        row = self.history().filter("promote").orderBy(F.desc("seq")).first()
        return row["bundle"] if row else None

    def decider(self, name: str, expressions: dict[str, Callable[[dict], Scorer]] | None = None) -> Scorer:
        """The saved bundle as a function that adds ``decision`` to a frame of
        loans. ``expressions``: for families without a model, a scorer from
        the bundle's rates."""
        path = f"{self.root}/bundles/{name}"
        family = io.load_bundle(self.spark, path, None, None)[0].model_family
        calibrated = family in MODELS
        meta, stats, model, calibrator = io.load_bundle(
            self.spark, path, MODELS.get(family), IsotonicRegressionModel if calibrated else None)
        profit = policy.ProfitModel(meta.lgd, meta.prepay_factor)

        def decide(df: DataFrame) -> DataFrame:
            if calibrated:
                scored = models.calibrate(models.FittedModel(family, stats, model, {}).score(df), calibrator)
            else:
                scored = (expressions or {})[family](meta.rates)(df)
            return policy.decide(scored, meta.threshold, profit, amount_col="funded_amnt")

        return decide

    def gate(self, candidate: str, rows: DataFrame, margin: float = C.PROMOTION_MARGIN,
             expressions: dict[str, Callable[[dict], Scorer]] | None = None) -> dict:
        """G-1, G-2: candidate and champion, both loaded from the registry,
        decide the same scan of judging rows; the decision is appended and
        returned. Without a champion the candidate is promoted."""
        champion = self.champion()
        sides = {"candidate": candidate} | ({"champion": champion} if champion else {})
        seen = rows
        for side, name in sides.items():
            seen = self.decider(name, expressions)(seen).select(
                *seen.columns, F.col("decision").alias(f"_{side}"))
        each = F.array(*[F.struct(F.lit(s).alias("bundle"), F.col(f"_{s}").alias("decision")) for s in sides])
        long = seen.select("funded_amnt", "realized_profit", F.explode(each).alias("d")).select("funded_amnt", "realized_profit", "d.*")
        found = gate.promotion_decision(gate.bundle_returns(long), margin).first().asDict()
        last = self.history().agg(F.max("seq")).first()[0] or 0
        row = (last + 1, candidate, *[found[c] for c in ("promote", "candidate_return", "champion_return", "margin", "reason")])
        self.spark.createDataFrame([row], _PROMOTIONS).coalesce(1).write.mode("append").json(f"{self.root}/promotions")
        return found


def rate_scorer(column: str) -> Callable[[dict], Scorer]:
    """Scores by the rate of a level of ``column``; levels without one by ""."""

    def make(rates: dict) -> Scorer:
        rate = reduce(lambda e, level: F.when(F.col(column) == level, F.lit(float(rates[level]))).otherwise(e),
                      [level for level in sorted(rates) if level], F.lit(float(rates[""])))
        return lambda df: df.withColumn("risk_score", rate).withColumn("probability_of_default", F.col("risk_score"))

    return make
