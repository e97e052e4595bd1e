"""Drift, quality and alert rules (D-2 .. D-11), checked against hand-made
vectors and brute-force NumPy definitions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import monitor


def summaries(spark, months):
    rows = [(b, float(ds), float(pd)) for b, ds, pd in months]
    return spark.createDataFrame(rows, "batch string, drift_share double, prediction_drift double")


def retrain_batches(spark, months):
    return [r["batch"] for r in monitor.retrain_alerts(summaries(spark, months)).orderBy("batch").collect()]


def test_one_bad_month_does_not_retrain(spark):
    assert retrain_batches(spark, [("2016-01", 0.9, 0), ("2016-02", 0, 0)]) == []


def test_two_bad_months_retrain(spark):
    assert retrain_batches(spark, [("2016-01", 0.9, 0), ("2016-02", 0.8, 0)]) == ["2016-02"]


def test_prediction_drift_alone_and_only_broken_threshold_named(spark):
    out = monitor.retrain_alerts(summaries(spark, [("2016-01", 0, 0.4), ("2016-02", 0, 0.4)])).collect()
    assert [r["batch"] for r in out] == ["2016-02"]
    assert "prediction drift" in out[0]["reason"] and "drift share" not in out[0]["reason"]
    assert out[0]["reason"] == "2 consecutive months above threshold (prediction drift 0.400 > 0.15)"


def test_continuing_episode_alerts_once(spark):
    assert retrain_batches(spark, [(f"2016-{i:02d}", 0.9, 0) for i in range(1, 7)]) == ["2016-02"]


def test_clean_month_resets_run(spark):
    months = [("2016-01", 0.9, 0), ("2016-02", 0.9, 0), ("2016-03", 0, 0), ("2016-04", 0.9, 0), ("2016-05", 0.9, 0)]
    assert retrain_batches(spark, months) == ["2016-02", "2016-05"]


def _missing(spark, rows):
    return spark.createDataFrame(rows, "batch string, column string, increase double")


def test_missing_jump_realerts_after_recovery(spark):
    s = summaries(spark, [("2016-01", 0, 0), ("2016-02", 0, 0), ("2016-03", 0, 0), ("2016-04", 0, 0)])
    m = _missing(spark, [("2016-01", "dti", 0.9), ("2016-02", "dti", 0.9), ("2016-04", "dti", 0.9)])
    out = monitor.missing_alerts(s, m, ["dti"]).orderBy("batch").collect()
    assert [r["batch"] for r in out] == ["2016-01", "2016-04"]
    assert out[0]["reason"] == "missing values jumped vs reference: dti +90%"


def test_small_missing_increase_ignored(spark):
    s = summaries(spark, [("2016-01", 0, 0)])
    assert monitor.missing_alerts(s, _missing(spark, [("2016-01", "revol_util", 0.05)]), ["revol_util"]).count() == 0


def test_new_category_reported_once_and_new_pair_again(spark):
    rows = [("2016-01", "addr_state", "ND"), ("2016-02", "addr_state", "ND"), ("2016-03", "addr_state", "ND"),
            ("2016-03", "home_ownership", "ANY")]
    new = spark.createDataFrame(rows, "batch string, column string, value string")
    out = monitor.category_alerts(new).orderBy("batch").collect()
    assert [r["batch"] for r in out] == ["2016-01", "2016-03"]
    assert "home_ownership=ANY" in out[-1]["reason"] and "addr_state" not in out[-1]["reason"]


def w1_normed(ref, cur):
    ref, cur = np.sort(np.asarray(ref, float)), np.sort(np.asarray(cur, float))
    pts = np.unique(np.concatenate([ref, cur]))
    fr = np.searchsorted(ref, pts, side="right") / len(ref)
    fc = np.searchsorted(cur, pts, side="right") / len(cur)
    return float(np.sum(np.abs(fr - fc)[:-1] * np.diff(pts))) / max(float(np.std(ref)), 0.001)


def js_distance(ref, cur):
    levels = sorted(set(ref) | set(cur))
    p = np.array([ref.count(v) for v in levels], float) / len(ref)
    q = np.array([cur.count(v) for v in levels], float) / len(cur)
    m = (p + q) / 2
    def kl(a):
        return sum(x * math.log(x / y) for x, y in zip(a, m) if x > 0)
    return math.sqrt((kl(p) + kl(q)) / 2)


@pytest.mark.parametrize("rows_per_range", [500_000, 7])
def test_numeric_drift_matches_brute_force(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(monitor, "ROWS_PER_RANGE", rows_per_range)  # few values a range: every edge case at a border
    rng = np.random.default_rng(1)
    ref = np.round(rng.normal(50, 10, 500), 1)
    months = {"2016-01": np.round(rng.normal(50, 10, 120), 1), "2016-02": np.round(rng.normal(60, 15, 80), 1),
              "2016-03": ref[:100] * 3, "2016-04": np.round(rng.uniform(-100, 300, 50), 0)}
    ref_df = spark.createDataFrame([(float(v),) for v in ref], "x double")
    cur_df = spark.createDataFrame([(b, float(v)) for b, vs in months.items() for v in vs], "batch string, x double")
    got = {r["batch"]: r["drift"] for r in monitor.numeric_drift(ref_df, cur_df, ["x"]).collect()}
    for b, vs in months.items():
        assert got[b] == pytest.approx(w1_normed(ref, vs), rel=1e-9, abs=1e-12)
    assert got["2016-03"] > 0.15


def test_numeric_drift_of_several_columns_on_one_profile(spark):
    """One profile serves any months; columns with nulls, one value, no value
    on a side, and values outside the reference's range."""
    rng = np.random.default_rng(3)
    ref = {"a": list(rng.normal(0, 1, 300)), "b": [5.0] * 300, "c": [None] * 300,
           "d": [None if i % 3 else float(v) for i, v in enumerate(rng.uniform(0, 9, 300))]}
    cur = {"a": list(rng.normal(40, 1, 60)), "b": [5.0] * 30 + [7.0] * 30, "c": [1.0] * 60, "d": [None] * 30 + [float(v) for v in rng.uniform(3, 5, 30)]}
    months = ["m1"] * 30 + ["m2"] * 30
    ddl = "a double, b double, c double, d double"
    ref_df = spark.createDataFrame([tuple(None if v is None else float(v) for v in r) for r in zip(*ref.values())], ddl)
    cur_df = spark.createDataFrame([(m, *[None if v is None else float(v) for v in r]) for m, r in zip(months, zip(*cur.values()))],
                                   f"batch string, {ddl}")
    profile = monitor.reference_profile(ref_df, list(ref))
    for part in (cur_df, cur_df.filter("batch = 'm2'")):
        got = {(r["batch"], r["column"]): r["drift"] for r in monitor.numeric_drift(profile, part, list(ref)).collect()}
        seen = {r["batch"] for r in part.select("batch").distinct().collect()}
        want = {}
        for m in seen:
            for c in ref:
                values = [v for v, k in zip(cur[c], months) if k == m and v is not None]
                known = [v for v in ref[c] if v is not None]
                if values and known:
                    want[m, c] = w1_normed(np.array(known), np.array(values))
        assert got == {k: pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in want.items()}


def test_identical_month_has_zero_drift(spark):
    vals = [float(v) for v in range(100)]
    ref_df = spark.createDataFrame([(v,) for v in vals], "x double")
    cur_df = spark.createDataFrame([("2016-01", v) for v in vals], "batch string, x double")
    assert monitor.numeric_drift(ref_df, cur_df, ["x"]).first()["drift"] == pytest.approx(0.0, abs=1e-12)


def test_categorical_drift_matches_brute_force(spark):
    ref = ["A"] * 50 + ["B"] * 30 + ["C"] * 20
    months = {"2016-01": ["A"] * 10 + ["B"] * 10, "2016-02": ["D"] * 5 + ["A"] * 5, "2016-03": list(ref)}
    ref_df = spark.createDataFrame([(v,) for v in ref], "g string")
    cur_df = spark.createDataFrame([(b, v) for b, vs in months.items() for v in vs], "batch string, g string")
    got = {r["batch"]: r["drift"] for r in monitor.categorical_drift(ref_df, cur_df, ["g"]).collect()}
    for b, vs in months.items():
        assert got[b] == pytest.approx(js_distance(ref, vs), abs=1e-12)


def test_missing_increase_and_new_categories(spark):
    ref = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (None, "x"), (4.0, "y")], "v double, g string")
    cur = spark.createDataFrame([("m1", None, "x"), ("m1", None, "z"), ("m1", 3.0, None)], "batch string, v double, g string")
    inc = {r["column"]: r["increase"] for r in monitor.missing_increase(ref, cur, ["v", "g"]).collect()}
    assert inc == {"v": pytest.approx(round(2 / 3 - 1 / 4, 4)), "g": pytest.approx(round(1 / 3, 4))}
    new = [(r["column"], r["value"]) for r in monitor.new_categories(ref, cur, ["g"]).collect()]
    assert new == [("g", "z")]
