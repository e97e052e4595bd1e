"""The three lifecycles end to end on the smallest testdata: two families are
trained, evaluated, packaged, gated and loaded again; applications are decided
and months are monitored by the deployed bundle."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerlake import config as C

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="testdata not present")


def test_train_package_gate_and_monitor(spark, tmp_path, monkeypatch):
    from ledgerlake.operators import models
    from ledgerlake.plans import lifecycle
    from ledgerlake.sources.registry import BundleRegistry

    monkeypatch.setattr(models, "MIN_TREES", 3)
    p = replace(C.DEFAULT, gbt_configs=1, gbt_max_iter=6, gbt_patience=2, logreg_c=(0.1,), bootstrap_draws=50)
    run = lifecycle.train_and_evaluate(spark, SF, p)
    table = {(r["family"], r["policy"]): r for r in run["policy_table"].collect()}
    assert len(table) == 8 and table["baseline", "fund_all"]["share_funded"] == 1.0
    assert all(0 <= r["share_funded"] <= 1 for r in table.values())
    assert {r["family"] for r in run["quality"].collect()} == set(lifecycle.FAMILIES)
    assert {r["pair"] for r in run["paired"].collect()} == {
        "gbt_vs_logistic_regression", "gbt_vs_grade_prior", "logistic_regression_vs_grade_prior"}
    boot = run["bootstrap"].collect()
    assert len(boot) == 5 and all(r["draws"] == 50 and r["ci_low"] <= r["ci_high"] for r in boot)

    registry = BundleRegistry(spark, str(tmp_path / "registry"))
    rows = lifecycle.judging_rows(spark, SF, p).cache()
    assert registry.champion() is None
    for name, family in (("a", "logistic_regression"), ("b", "gbt"), ("c", "gbt")):
        before = registry.champion()
        lifecycle.package(registry, name, family, run, p)
        found = registry.gate(name, rows, p.promotion_margin)
        if before is None:
            assert found["promote"] and found["champion_return"] is None
        else:
            assert found["promote"] == (found["candidate_return"] - found["champion_return"] > p.promotion_margin)
        assert registry.champion() == (name if found["promote"] else before)
    assert registry.history().count() == 3
    with pytest.raises(FileExistsError):
        lifecycle.package(registry, "a", "gbt", run, p)

    loaded = registry.decider("b")(rows).select("loan_id", "decision").collect()
    direct = run["deciders"]["gbt"].decide(rows, amount_col="funded_amnt").select("loan_id", "decision").collect()
    assert sorted(map(tuple, loaded)) == sorted(map(tuple, direct)) and len(loaded) > 100

    watched = lifecycle.run_monitoring(spark, SF, run["deciders"]["gbt"], p)
    months = watched["summaries"].collect()
    assert months and all(0 <= r["drift_share"] <= 1 for r in months)
    assert watched["drift"].filter(F.col("column") == C.PREDICTION_COLUMN).count() == len(months)
