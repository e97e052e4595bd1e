"""Distributed running sums / as-of lookups, and the group audit (A-10 .. A-12)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import windows
from ledgerlake.operators import audit


@pytest.fixture
def force_buckets(monkeypatch):
    monkeypatch.setattr(windows, "SINGLE_TASK_ROWS", 0)


def test_running_sums_bucketed_equal_cumsum(spark, force_buckets):
    rng = np.random.default_rng(2)
    rows = [(g, float(v), int(w)) for g in ("a", "b") for v, w in zip(rng.permutation(500), rng.integers(1, 9, 500))]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    out = windows.running_sums(df, ["v"], ["w"], ["g"], buckets=8).collect()
    for g in ("a", "b"):
        mine = sorted((r["v"], r["cum_w"]) for r in out if r["g"] == g)
        base = sorted((v, w) for gg, v, w in rows if gg == g)
        assert [c for _, c in mine] == list(np.cumsum([w for _, w in base]))


def test_hot_group_is_split_among_many_groups(spark, monkeypatch):
    """20,000 groups of one row and one of 6,000: only the hot one is split,
    into ranges by its size, and its sums are exact."""
    monkeypatch.setattr(windows, "SINGLE_TASK_ROWS", 1000)
    monkeypatch.setattr(windows, "ROWS_PER_BUCKET", 500)
    df = spark.range(26000).selectExpr("if(id < 6000, -1, id) AS g", "cast(id AS double) AS v", "id % 7 AS w")
    bucketed, split = windows._with_bucket(df, "v", ["g"], 2)
    ranges = {r["hot"]: r["n"] for r in bucketed.groupBy((F.col("g") == -1).alias("hot"))
              .agg(F.countDistinct("_bkt").alias("n")).collect()}
    assert split and ranges[True] == 12 and ranges[False] == 1
    out = windows.running_sums(df, ["v"], ["w"], ["g"], buckets=2)
    want = np.cumsum(np.arange(6000) % 7)
    assert [r["cum_w"] for r in out.filter("g = -1").orderBy("v").collect()] == list(want)
    assert out.filter("g >= 0 AND cum_w != w").count() == 0 and out.count() == 26000


def test_carry_backward_and_forward(spark, force_buckets):
    rows = [("g", float(k), 1 if k % 7 == 0 else 0, f"v{k}" if k % 7 == 0 else None) for k in range(200)]
    df = spark.createDataFrame(rows, "g string, k double, tie int, val string")
    fwd = {r["k"]: r["val_asof"] for r in windows.carry(df, ["k", "tie"], "val", ["g"], forward=True, buckets=6).collect()}
    bwd = {r["k"]: r["val_asof"] for r in windows.carry(df, ["k", "tie"], "val", ["g"], forward=False, buckets=6).collect()}
    for k in range(200):
        assert fwd[float(k)] == f"v{(k // 7) * 7}"
        nxt = -(-k // 7) * 7
        assert bwd[float(k)] == (f"v{nxt}" if nxt < 200 else None)


def test_group_audit_drops_small_groups_and_measures_error(spark):
    rows = [("CA", True, 0.1, 0)] * 60 + [("CA", True, 0.1, 1)] * 20 + [("CA", False, 0.5, 1)] * 20
    rows += [("NV", False, 0.4, 1)] * 150 + [("NV", True, 0.2, 0)] * 50 + [("WY", True, 0.1, 0)] * 5
    df = spark.createDataFrame(rows, "addr_state string, funded boolean, risk_score double, target int")
    g = {r["group"]: r for r in audit.by_group(df, columns=("addr_state",), min_count=100).collect()}
    assert set(g) == {"CA", "NV"}
    assert g["CA"]["fund_rate"] == pytest.approx(0.8) and g["CA"]["default_if_funded"] == pytest.approx(0.25)
    assert g["NV"]["n_funded"] == 50 and g["NV"]["default_if_funded"] == 0.0


def test_disparity_correlation_one_and_extremes(spark):
    groups = spark.createDataFrame(
        [("addr_state", "A", 1000, 0.7, 0.30, 0.20, 0.1, 900), ("addr_state", "B", 1000, 0.4, 0.90, 0.05, 0.2, 500)],
        "column string, group string, n long, fund_rate double, mean_score double, default_rate double, default_if_funded double, n_funded long",
    )
    d = audit.disparity(groups, min_funded=800).first()
    assert d["score_vs_outcome_correlation"] == pytest.approx(-1.0) or d["score_vs_outcome_correlation"] == pytest.approx(1.0)
    assert d["fund_rate_min_group"] == "B" and d["fund_rate_max_group"] == "A"
    assert d["fund_rate_spread"] == pytest.approx(0.3)
    assert d["default_if_funded_min"] == d["default_if_funded_max"] == pytest.approx(0.1)


def test_disparity_undefined_correlation_is_null(spark):
    groups = spark.createDataFrame([("c", "A", 10, 0.5, 0.3, 0.2, None, 0)],
                                   "column string, group string, n long, fund_rate double, mean_score double, default_rate double, default_if_funded double, n_funded long")
    d = audit.disparity(groups, min_funded=800).first()
    assert d["score_vs_outcome_correlation"] is None and d["default_if_funded_min"] is None


@pytest.mark.parametrize("mode", ["single_task", "bucketed", "many_groups"])
def test_exact_percentiles_equal_numpy(spark, monkeypatch, mode):
    """Distributed exact quantiles equal numpy 'linear' and Spark's percentile,
    with ties, a single-value group and an all-null group; also when there are
    too many groups to broadcast anything (shuffle joins)."""
    from ledgerlake.functions import quantiles
    from ledgerlake.functions.quantiles import exact_percentiles

    if mode == "bucketed":
        monkeypatch.setattr(windows, "SINGLE_TASK_ROWS", 0)
    if mode == "many_groups":
        monkeypatch.setattr(windows, "SINGLE_TASK_ROWS", 0)
        monkeypatch.setattr(windows, "BROADCAST_EDGES", 0)
        monkeypatch.setattr(quantiles, "bounded_broadcast", lambda side: side)
    rng = np.random.default_rng(4)
    a = np.round(rng.normal(size=700), 1)  # many ties
    b = rng.uniform(size=301)
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b] + [("c", 3.5)] + [("d", None)] * 3
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.7, 0.995, 1.0]
    got = {(r["g"], r["prob"]): r["q"] for r in exact_percentiles(df, "x", probs, ["g"], buckets=5).collect()}
    for g, vals in (("a", a), ("b", b), ("c", np.array([3.5]))):
        for q in probs:
            assert got[(g, q)] == pytest.approx(float(np.quantile(vals, q)), abs=1e-12)
    assert not any(k[0] == "d" for k in got)
    spark_p = df.groupBy("g").agg(F.percentile("x", F.lit(0.7)).alias("p")).collect()
    for r in spark_p:
        if r["p"] is not None:
            assert got[(r["g"], 0.7)] == r["p"]
    whole = {r["prob"]: r["q"] for r in exact_percentiles(df, "x", [0.5], buckets=5).collect()}
    allv = np.concatenate([a, b, [3.5]])
    assert whole[0.5] == pytest.approx(float(np.quantile(allv, 0.5)), abs=1e-12)


@pytest.mark.parametrize("accuracy, bracket_rows", [(2000, 10**6), (20, 5), (8, 1)])
def test_selected_percentiles_equal_numpy(spark, accuracy, bracket_rows):
    """Quantiles by selection over several columns at once, with ties, nulls,
    infinities, one value and none, also when brackets are cut again."""
    from ledgerlake.functions.quantiles import order_statistics

    rng = np.random.default_rng(6)
    cols = {
        "smooth": list(rng.normal(size=900)), "ties": [float(x) for x in rng.integers(0, 4, 900)],
        "half": [float(x) if x > 0 else None for x in rng.normal(size=900)], "one": [7.5] + [None] * 899,
        "none": [None] * 900, "two": [1.0, 2.0] * 450, "edge": [float("-inf")] * 3 + list(rng.exponential(size=894)) + [float("inf")] * 3,
    }
    df = spark.createDataFrame([tuple(None if v is None else float(v) for v in r) for r in zip(*cols.values())],
                               ", ".join(f"{c} double" for c in cols)).repartition(5)
    probs = [0.0, 0.1, 0.5, 0.75, 0.995, 1.0]
    found = order_statistics(df, {c: F.col(c) for c in cols}, dict.fromkeys(cols, probs), bracket_rows, accuracy)
    for c, values in cols.items():
        known = sorted(v for v in values if v is not None)
        for q in probs:
            got = found[c, q]
            if not known:
                assert got.n == 0 and got.value() is None
                continue
            pos = (len(known) - 1) * q
            assert (got.low, got.high) == (known[int(np.floor(pos))], known[int(np.ceil(pos))])
            if c != "edge":
                assert got.value() == pytest.approx(float(np.quantile(known, q)), abs=1e-12)
                assert got.value(np.exp) == pytest.approx(float(np.quantile(np.exp(known), q)), rel=1e-12)
