"""Money: profit model, policies, curve, thresholds, bootstrap, gate (A-1 .. A-9, P-13 .. P-17, G-*)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.operators import gate, policy


def frame(spark, rows):
    return spark.createDataFrame(rows, "loan_id string, funded_amnt double, installment double, term_months int, "
                                       "realized_profit double, target int, risk_score double")


def test_contractual_gain(spark):
    df = policy.with_gain(frame(spark, [("a", 10000.0, 330.0, 36, 0.0, 0, 0.1)]))
    assert df.first()["gain"] == pytest.approx(1880.0)


def test_profit_model_dollar_weighted(spark):
    # default loses 4000 of 10000; repaid earns 940 of a 1880 contractual gain
    df = frame(spark, [("a", 10000.0, 330.0, 36, -4000.0, 1, 0.1), ("b", 10000.0, 330.0, 36, 940.0, 0, 0.1)])
    pm = policy.fit_profit_model(df)
    assert pm.lgd == pytest.approx(0.4) and pm.prepay_factor == pytest.approx(0.5)
    df2 = frame(spark, [("a", 100000.0, 3000.0, 36, -50000.0, 1, 0.1), ("b", 1000.0, 30.0, 36, -100.0, 1, 0.1),
                        ("c", 1000.0, 30.0, 36, 10.0, 0, 0.1)])
    assert policy.fit_profit_model(df2).lgd == pytest.approx(50100 / 101000)


def test_evaluate_policy_and_degenerate_cases(spark):
    df = frame(spark, [("a", 10000.0, 1.0, 36, 1500.0, 0, 0.1), ("b", 10000.0, 1.0, 36, -6000.0, 1, 0.2),
                       ("c", 10000.0, 1.0, 36, 1500.0, 0, 0.3)])
    res = {r["policy"]: r for r in policy.evaluate_policies(df, {"all": F.lit(True), "none": F.lit(False)}).collect()}
    assert res["all"]["total_profit"] == pytest.approx(-3000.0)
    assert res["all"]["return_per_dollar"] == pytest.approx(-0.1)
    assert res["all"]["default_rate_funded"] == pytest.approx(1 / 3)
    assert res["none"]["return_per_dollar"] == 0.0 and res["none"]["default_rate_funded"] == 0.0


def test_threshold_curve_equals_naive(spark):
    rng = np.random.default_rng(0)
    n = 400
    scores = np.round(rng.uniform(0, 0.7, n), 3)
    scores[:20] = [0.02, 0.025, 0.5, 0.595, 0.6, 0.0, 0.005, 0.3, 0.3, 0.3, 0.12, 0.125, 0.13, 0.135, 0.59, 0.599, 0.045, 0.05, 0.055, 0.06]
    rows = [(str(i), 1000.0 + i, 1.0, 36, float(rng.normal(50, 300)), int(rng.integers(0, 2)), float(s)) for i, s in enumerate(scores)]
    df = frame(spark, rows)
    curve = {round(r["threshold"], 6): r for r in policy.threshold_curve(df).collect()}
    assert len(curve) == 116
    funded = np.array([r[1] for r in rows]); profit = np.array([r[4] for r in rows]); target = np.array([r[5] for r in rows])
    for t in C.threshold_grid():
        m = scores < t
        r = curve[round(t, 6)]
        assert r["loans_funded"] == int(m.sum())
        cap = funded[m].sum()
        assert r["return_per_dollar"] == pytest.approx(profit[m].sum() / cap if cap else 0.0)
        assert r["default_rate_funded"] == pytest.approx(target[m].mean() if m.any() else 0.0)


def test_choose_threshold_ties_take_lowest_and_min_share(spark):
    df = frame(spark, [(str(i), 1000.0, 1.0, 36, 100.0, 0, 0.01) for i in range(10)])
    curve = policy.threshold_curve(df)
    assert policy.choose_threshold(curve) == pytest.approx(0.02)
    with pytest.raises(ValueError):
        policy.choose_threshold(curve, min_share=1.5)


def test_threshold_for_share_is_linear_quantile(spark):
    vals = [0.1, 0.4, 0.2, 0.9, 0.5, 0.3]
    df = frame(spark, [(str(i), 1.0, 1.0, 36, 0.0, 0, v) for i, v in enumerate(vals)])
    for q in (0.1, 0.5, 0.73, 1.0):
        assert policy.threshold_for_share(df, q) == pytest.approx(float(np.quantile(vals, q)))
    with pytest.raises(ValueError):
        policy.threshold_for_share(df, 0.0)


def test_bootstrap_identical_policies_straddle_zero(spark):
    df = frame(spark, [(str(i), 1000.0, 1.0, 36, float((i % 7) * 40 - 100), i % 2, 0.1) for i in range(200)])
    df = df.withColumn("a", F.col("loan_id").cast("int") % 3 == 0).withColumn("b", F.col("loan_id").cast("int") % 3 == 0)
    diffs = policy.bootstrap_differences(df, {"same": ("a", "b")}, draws=50, seed=42)
    s = policy.bootstrap_summary(diffs).first()
    assert s["mean_difference"] == 0.0 and s["ci_low"] <= 0.0 <= s["ci_high"] and s["draws"] == 50


def test_poisson_weights_have_mean_one(spark):
    df = spark.range(20000).select(policy.poisson_weight(policy.uniform_from_hash(F.col("id").cast("string"))).alias("w"))
    r = df.agg(F.avg("w"), F.variance("w")).first()
    assert r[0] == pytest.approx(1.0, abs=0.03) and r[1] == pytest.approx(1.0, abs=0.05)


def test_decision_basis_precedence(spark):
    rows = [("hi", 10000.0, 330.0, 36, 0.0, 0, 0.5), ("neg", 10000.0, 1.0, 36, 0.0, 0, 0.05), ("ok", 10000.0, 330.0, 36, 0.0, 0, 0.05)]
    df = frame(spark, rows).withColumn("loan_amnt", F.col("funded_amnt")).withColumn("probability_of_default", F.col("risk_score"))
    out = {r["loan_id"]: r for r in policy.decide(df, 0.14, policy.ProfitModel(0.4, 0.8)).collect()}
    assert out["hi"]["decision_basis"] == "score_above_threshold" and out["hi"]["decision"] == "decline"
    assert out["neg"]["decision_basis"] == "negative_expected_return" and out["neg"]["decision"] == "decline"
    assert out["ok"]["decision"] == "fund"


def _returns(spark, cand, champ):
    rows = [("candidate", 10000.0, p, "fund") for p in cand] + [("champion", 10000.0, p, "fund") for p in champ]
    df = spark.createDataFrame(rows, "bundle string, funded_amnt double, realized_profit double, decision string")
    return gate.bundle_returns(df)


def test_gate_vectors(spark):
    first = gate.promotion_decision(_returns(spark, [1500.0, 1500.0], [])).first()
    assert first["promote"] and first["reason"] == "no model in production yet"
    better = gate.promotion_decision(_returns(spark, [1500.0, 1500.0], [1500.0, -6000.0])).first()
    assert better["promote"]
    same = gate.promotion_decision(_returns(spark, [1500.0, -6000.0], [1500.0, -6000.0])).first()
    assert not same["promote"] and "below" in same["reason"]
    df = spark.createDataFrame([("candidate", 10000.0, 1500.0, "decline")], "bundle string, funded_amnt double, realized_profit double, decision string")
    assert gate.bundle_returns(df).first()["return_per_dollar"] == 0.0


def test_bootstrap_sums_equal_the_exploded_draws(spark):
    """The tasks' sums are those of one row a (loan, draw) with its weight,
    and the weights have the mean and variance of Poisson(1)."""
    rows = [(f"l{i}", 100.0 + i, float(i % 13 - 4), i % 3 > 0, i % 5 > 1) for i in range(400)]
    df = spark.createDataFrame(rows, "loan_id string, funded_amnt double, realized_profit double, a boolean, b boolean")
    got = {(r["comparison"], r["draw"]): r["difference"] for r in policy.bootstrap_differences(
        df, {"ab": ("a", "b"), "ba": ("b", "a")}, draws=40, seed=42).collect()}
    s, t = policy.draw_seeds(F.concat_ws("-", F.lit("42"), F.col("loan_id")))
    each = df.select("*", s.alias("s"), t.alias("t"), F.explode(F.sequence(F.lit(0), F.lit(39))).alias("draw"))
    each = each.withColumn("w", policy.poisson_weight(policy.draw_uniform(F.col("s"), F.col("t"), F.col("draw"))))
    ret = lambda p: F.sum(F.when(F.col(p), F.col("w") * F.col("realized_profit"))) / F.sum(F.when(F.col(p), F.col("w") * F.col("funded_amnt")))
    want = {r["draw"]: r["d"] for r in each.groupBy("draw").agg((ret("a") - ret("b")).alias("d")).collect()}
    assert len(got) == 80 and all(got["ab", d] == pytest.approx(w, abs=1e-12) for d, w in want.items())
    assert all(got["ba", d] == pytest.approx(-w, abs=1e-12) for d, w in want.items())
    m = each.agg(F.avg("w").alias("mean"), F.var_pop("w").alias("var")).first()
    assert m["mean"] == pytest.approx(1, abs=0.05) and m["var"] == pytest.approx(1, abs=0.08)


def _counted(df):
    """``df`` and a counter of its rows' evaluations."""
    from pyspark.sql import functions as F

    seen = df.sparkSession.sparkContext.accumulator(0)

    def one(x: int) -> int:
        seen.add(1)
        return x

    return df.withColumn("target", F.udf(one, "int").asNondeterministic()("target")), seen


def test_grade_prior_reads_its_train_rows_once(spark):
    from ledgerlake.operators import metrics

    train, seen = _counted(spark.createDataFrame([("A", 0)] * 6 + [("G", 1)] * 3 + [(None, None)], "grade string, target int"))
    rates, overall = metrics.fit_grade_prior(train)
    for _ in range(2):
        got = {r["grade"]: r["probability_of_default"] for r in metrics.predict_grade_prior(
            spark.createDataFrame([("A",), ("G",), ("Z",)], "grade string"), rates, overall).collect()}
        assert got == {"A": 0.0, "G": 1.0, "Z": 3 / 9}
    assert seen.value == 10


def test_families_score_a_row_once(spark):
    from pyspark.sql import functions as F

    from ledgerlake.operators import evaluate

    df, seen = _counted(spark.createDataFrame([("a", 1), ("b", 0), ("b", 0), (None, None)], "loan_id string, target int"))

    def scorer(x):
        return lambda d: d.withColumn("risk_score", F.lit(x)).withColumn("probability_of_default", F.col("risk_score") / 2)

    got = evaluate.scored_in_one_read(df, {"one": scorer(0.5), "two": scorer(0.25)})
    assert got.columns == ["loan_id", "target", "family", "risk_score", "probability_of_default"]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == sorted([(i, t, f, s, s / 2) for i, t in (("a", 1), ("b", 0), ("b", 0), (None, None))
                           for f, s in (("one", 0.5), ("two", 0.25))], key=str)
    assert seen.value == 4
