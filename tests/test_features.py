"""Row-level derivations, labels, filters, splits (P-1 .. P-11, C-1, F-1 .. F-7)."""

import datetime as dt

import pytest
from conftest import raw_frame, raw_row
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.functions.features import derive_features
from ledgerlake.operators import labels, splits


@pytest.mark.parametrize("text,years", [("10+ years", 10), ("< 1 year", 0), ("3 years", 3), (None, None), ("n/a", None)])
def test_emp_length_years(spark, text, years):
    df = derive_features(raw_frame(spark, [raw_row(emp_length=text)]))
    assert df.first()["emp_length_years"] == years


def test_derived_numbers(spark):
    r = derive_features(raw_frame(spark, [raw_row(annual_inc=60000.0, loan_amnt=12000.0, issue_d="Jun-2013")])).first()
    assert r["term_months"] == 36
    assert r["fico_mid"] == 692.0
    assert r["loan_to_income"] == pytest.approx(0.2)
    assert r["credit_history_months"] == pytest.approx((dt.date(2013, 6, 1) - dt.date(2003, 8, 1)).days / 30.44)
    assert r["issue_date"] == dt.date(2013, 6, 1)


def test_zero_income_and_dti_sentinel_become_null(spark):
    r = derive_features(raw_frame(spark, [raw_row(annual_inc=0.0, dti=999.0)])).first()
    assert r["loan_to_income"] is None and r["installment_to_income"] is None
    assert r["dti"] is None


def test_labels_and_credit_policy_flag(spark):
    rows = [
        raw_row(id="a", loan_status="Fully Paid"),
        raw_row(id="b", loan_status="Charged Off"),
        raw_row(id="c", loan_status="Default"),
        raw_row(id="d", loan_status="Current"),
        raw_row(id="e", loan_status=C.CREDIT_POLICY_PREFIX + "Charged Off"),
    ]
    out = {r["id"]: r for r in labels.transform(raw_frame(spark, rows), C.DEFAULT).collect()}
    assert {k: v["target"] for k, v in out.items()} == {"a": 0, "b": 1, "c": 1, "e": 1}
    assert out["e"]["not_credit_policy"] and out["e"]["status_clean"] == "Charged Off"
    assert out["a"]["realized_profit"] == pytest.approx(1500.0)


def test_unclassified_status_raises(spark):
    with pytest.raises(ValueError, match="Settled In Full"):
        labels.transform(raw_frame(spark, [raw_row(loan_status="Settled In Full")]), C.DEFAULT)


def test_maturity_window_and_term_filter(spark):
    rows = [raw_row(id="in"), raw_row(id="late", issue_d="Jan-2001"), raw_row(id="sixty", term=" 60 months")]
    ids = [r["id"] for r in labels.transform(raw_frame(spark, rows), C.DEFAULT).collect()]
    assert ids == ["in"]


def test_split_boundaries(spark):
    days = ["1998-12-01", "1999-01-01", "1999-12-01", "2000-01-01", "2001-06-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("issue_date"))
    got = [r["split"] for r in splits.assign_split(df).orderBy("issue_date").collect()]
    assert got == ["train", "validation", "validation", "test", "unused"]


def test_folds_expand_and_never_see_the_future(spark):
    days = [f"{y}-06-01" for y in (1995, 1996, 1997, 1998)]
    df = spark.createDataFrame([(d, 0) for d in days], "d string, target int").select(
        F.col("d").cast("date").alias("issue_date"), "target")
    rows = splits.fold_roles(df).collect()
    by = {}
    for r in rows:
        by.setdefault((r["fold"], r["role"]), []).append(r["issue_date"].year)
    assert by[(1, "train")] == [1995] and by[(1, "validate")] == [1996]
    assert sorted(by[(3, "train")]) == [1995, 1996, 1997] and by[(3, "validate")] == [1998]
    for (fold, role), years in by.items():
        if role == "train":
            assert max(years) < C.DEFAULT.folds[fold - 1].validate_year


def test_empty_fold_raises(spark):
    df = spark.createDataFrame([("1995-06-01", 0)], "d string, target int").select(
        F.col("d").cast("date").alias("issue_date"), "target")
    with pytest.raises(ValueError, match="empty fold"):
        splits.fold_frames(df)
