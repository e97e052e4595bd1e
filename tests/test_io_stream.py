"""Sources/sinks (S-1, S-3, S-4, S-6), request quarantine (C-5), streaming (D-12)."""

import os
import tempfile

import pytest
from conftest import raw_frame, raw_row
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.operators import contract
from ledgerlake.sources import io


def test_csv_ingest_projection_bad_cells_and_footer(spark):
    d = tempfile.mkdtemp(prefix="ll-csv-")
    header = ",".join(f.name for f in io.raw_schema().fields) + ",not_allowed"
    base = raw_row()
    vals = [str(base[f.name]) if base[f.name] is not None else "" for f in io.raw_schema().fields]
    good = ",".join(vals) + ",x"
    bad = good.replace("10000.0", "oops", 1)
    footer = "Total amount funded in policy code 1: 123" + "," * (len(vals))
    with open(f"{d}/loans.csv", "w") as fh:
        fh.write("\n".join([header, good, bad, footer]) + "\n")
    df = io.read_loans_csv(spark, d)
    rows = df.collect()
    assert "not_allowed" not in df.columns
    assert len(rows) == 2
    assert sorted([r["loan_amnt"] for r in rows], key=lambda v: (v is None, v)) == [10000.0, None]


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    """Another column order and 120 unlisted columns between; an absent listed
    column raises, and so does a second file with another header."""
    names = [f.name for f in io.raw_schema().fields][::-1]
    mixed = [x for i, n in enumerate(names) for x in (n, *(f"other_{i}_{k}" for k in range(4)))]
    base = raw_row(id="77", loan_amnt=12345.0, grade="C", loan_status="Charged Off")
    line = ",".join(str(base[n]) if n in base and base[n] is not None else ("99" if n not in base else "") for n in mixed)
    folder = tmp_path / "loans"
    folder.mkdir()
    (folder / "a.csv").write_text(",".join(mixed) + "\n" + line + "\n")
    rows = io.read_loans_csv(spark, str(folder)).collect()
    assert len(rows) == 1
    assert all(rows[0][n] == base[n] for n in names)
    (tmp_path / "b.csv").write_text(",".join(n for n in mixed if n != "grade") + "\n")
    with pytest.raises(ValueError, match="grade"):
        io.read_loans_csv(spark, str(tmp_path / "b.csv"))
    (folder / "z.csv").write_text(",".join(mixed[::-1]) + "\n" + line + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        io.read_loans_csv(spark, str(folder)).collect()


def test_partitioned_write_replaces_only_present_partitions(spark):
    d = tempfile.mkdtemp(prefix="ll-part-") + "/batches"
    io.write_partitioned(spark.createDataFrame([("2016-01", 1), ("2016-02", 2)], "batch string, x int"), d, "batch")
    io.write_partitioned(spark.createDataFrame([("2016-02", 5)], "batch string, x int"), d, "batch")
    got = {r["batch"]: r["x"] for r in spark.read.parquet(d).collect()}
    assert got == {"2016-01": 1, "2016-02": 5}


def test_bundle_refuses_overwrite(spark):
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel

    from ledgerlake.operators.preprocess import PrepStats

    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())])
    train = spark.createDataFrame([(Vectors.dense([0.0]), 0.0), (Vectors.dense([1.0]), 1.0)] * 5, schema)
    model = LogisticRegression().fit(train)
    iso = IsotonicRegression().fit(spark.createDataFrame([(0.1, 0.0), (0.9, 1.0)], "features double, label double"))
    meta = io.BundleMetadata("logistic_regression", 0.14, 0.2, 0.37, 0.83)
    path = tempfile.mkdtemp(prefix="ll-bundle-") + "/b"
    io.save_bundle(spark, path, meta, PrepStats(kind="linear"), model, iso)
    with pytest.raises(FileExistsError):
        io.save_bundle(spark, path, meta, PrepStats(kind="linear"), model, iso)
    io.save_bundle(spark, path, meta, PrepStats(kind="linear"), model, iso, force=True)
    m2, stats, lr, cal = io.load_bundle(spark, path, LogisticRegressionModel, IsotonicRegressionModel)
    assert m2.threshold == 0.14 and stats.kind == "linear" and lr.numFeatures == 1


def test_failed_save_leaves_the_bundle_as_it_was(spark, tmp_path):
    class Saves:
        def __init__(self, fails=False):
            self.fails = fails

        def write(self):
            return self

        def save(self, path):
            if self.fails:
                raise OSError("disk")

        @classmethod
        def load(cls, path):
            return path

    from ledgerlake.operators.preprocess import PrepStats

    path, stats = str(tmp_path / "b"), PrepStats(kind="linear")
    meta = io.BundleMetadata("logistic_regression", 0.14, 0.2, 0.37, 0.83)
    with pytest.raises(OSError):
        io.save_bundle(spark, path, meta, stats, Saves(), Saves(fails=True))
    with pytest.raises(FileNotFoundError):
        io.load_bundle(spark, path, Saves, Saves)
    io.save_bundle(spark, path, meta, stats, Saves(), Saves())
    before = io.load_bundle(spark, path, Saves, Saves)
    other = io.BundleMetadata("gbt", 0.5, 0.2, 0.37, 0.83)
    with pytest.raises(OSError):
        io.save_bundle(spark, path, other, stats, Saves(), Saves(fails=True), force=True)
    assert io.load_bundle(spark, path, Saves, Saves)[2:] == before[2:]
    io.save_bundle(spark, path, other, stats, Saves(), Saves(), force=True)
    after = io.load_bundle(spark, path, Saves, Saves)
    assert after[0].threshold == 0.5 and after[2] != before[2]


def test_quarantine_keeps_rows_that_no_rule_can_compute(spark):
    """Zero, negative and null amounts, no term, a month that names none: each
    is rejected with its reasons, and the accepted side derives."""
    from ledgerlake.functions.features import applications_to_loans, derive_features

    ok = dict(loan_amnt=12000.0, int_rate=11.99, installment=398.52)
    apps = contract.loans_as_applications(raw_frame(spark, [
        raw_row(id="ok", **ok),
        raw_row(id="zero", **ok | {"loan_amnt": 0.0}),
        raw_row(id="neg", **ok | {"loan_amnt": -5.0}),
        raw_row(id="null", **ok | {"loan_amnt": None, "int_rate": None}),
        raw_row(id="term", **ok | {"term": " 00 months"}),
        raw_row(id="rate", **ok | {"int_rate": -1200.0}),
        raw_row(id="free", **ok | {"int_rate": 0.0, "term": " 00 months"}),
        raw_row(id="month", **ok | {"issue_d": "Foo-2015"}),
        raw_row(id="line", **ok | {"earliest_cr_line": "Abc-1999"}),
    ]))
    q = contract.quarantine(apps)
    out = {r["id"]: r["reasons"] for r in q.collect()}
    assert out["ok"] == [] and out["zero"] == ["loan_amnt"] and out["neg"][0] == "loan_amnt"
    assert {"loan_amnt", "int_rate"} <= set(out["null"]) and "term_months" in out["term"]
    assert "int_rate" in out["rate"] and {"term_months", "int_rate"} <= set(out["free"])
    assert out["month"] == ["application_date_invalid"] and out["line"] == ["earliest_cr_line_invalid"]
    loans = derive_features(applications_to_loans(q), strict_dates=False)
    dates = {r["id"]: r["issue_date"] for r in loans.select("id", "issue_date").collect()}
    assert dates["month"] is None and str(dates["ok"]) == "1997-06-01"


def test_quarantine_rejects_inconsistent_installment(spark):
    apps = contract.loans_as_applications(raw_frame(spark, [
        raw_row(id="ok", loan_amnt=12000.0, int_rate=11.99, installment=398.52),
        raw_row(id="bad", loan_amnt=12000.0, int_rate=11.99, installment=14.77),
        raw_row(id="many", home_ownership="ANY", emp_length="n/a", fico_range_high=600.0, fico_range_low=700.0),
    ]))
    out = {r["id"]: r for r in contract.quarantine(apps).collect()}
    assert out["ok"]["accepted"]
    assert out["bad"]["reasons"] == ["installment_inconsistent"]
    assert {"home_ownership", "emp_length", "fico_range_order"} <= set(out["many"]["reasons"])


def test_schema_violations_and_forbidden_columns(spark):
    df = spark.createDataFrame([(0, 400.0, "H"), (1, 1000.0, "A")], "target int, loan_amnt double, grade string")
    assert contract.forbidden_columns(["total_rec_int", "total_pymnt", "funded_amnt", "x"]) == ["total_rec_int"]
    with pytest.raises(ValueError):
        contract.assert_no_forbidden_columns(df.withColumn("recoveries_x", F.lit(1)))


def test_missingness_raises_but_structural_is_exempt(spark):
    from tests_helpers import wide_train

    train = wide_train(spark, annual_inc_null=True)
    with pytest.raises(ValueError, match="annual_inc"):
        contract.check_missingness(train)
    contract.check_missingness(wide_train(spark, annual_inc_null=False))


def test_streaming_monthly_summary(spark):
    folder = tempfile.mkdtemp(prefix="ll-stream-in-")
    rows = [("2016-01", "fund", 0.1, True), ("2016-01", "decline", 0.3, False), ("2016-02", "fund", 0.2, False)]
    df = spark.createDataFrame(rows, "batch string, decision string, probability_of_default double, outcome_known boolean")
    df.write.mode("overwrite").parquet(folder + "/in")
    from ledgerlake.streaming import monitor_stream

    ck, sink = tempfile.mkdtemp(prefix="ll-stream-ck-"), tempfile.mkdtemp(prefix="ll-stream-out-") + "/summary"
    q = monitor_stream.start_summary(spark, folder + "/in", df.schema, ck, sink)
    q.awaitTermination(120)
    got = {r["batch"]: r for r in spark.read.parquet(sink).collect()}
    assert got["2016-01"]["loans"] == 2 and got["2016-01"]["fund_rate"] == 0.5 and got["2016-02"]["loans"] == 1
    # a later file updates one month: only its partition is replaced (update semantics)
    spark.createDataFrame([("2016-02", "fund", 0.4, True)], df.schema).write.mode("append").parquet(folder + "/in")
    q = monitor_stream.start_summary(spark, folder + "/in", df.schema, ck, sink)
    q.awaitTermination(120)
    got = {r["batch"]: r for r in spark.read.parquet(sink).collect()}
    assert len(got) == 2 and got["2016-01"]["loans"] == 2
    assert got["2016-02"]["loans"] == 2 and got["2016-02"]["fund_rate"] == 1.0


def test_write_report_single_file_only_when_asked_for(spark, tmp_path):
    import glob

    from ledgerlake.sources import io

    df = spark.range(40).repartition(4).selectExpr("id", "id * 2 AS twice")
    io.write_report(df, str(tmp_path / "small"), single_file=True)
    assert len(glob.glob(str(tmp_path / "small" / "part-*"))) == 1
    io.write_report(df, str(tmp_path / "big"))
    assert len(glob.glob(str(tmp_path / "big" / "part-*"))) > 1
    back = spark.read.json(str(tmp_path / "big"))
    assert back.count() == 40 and back.agg({"twice": "sum"}).first()[0] == 2 * sum(range(40))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="testdata not present")
def test_streaming_drift_equals_batch_and_retry_is_idempotent(spark):
    from ledgerlake.plans.q_monitor import Monitoring
    from ledgerlake.sources.io import write_partitioned
    from ledgerlake.streaming import monitor_stream

    m = Monitoring(spark, "/root/testdata/sf0.001")
    folder = tempfile.mkdtemp(prefix="ll-stream-cur-") + "/in"
    m.current.write.parquet(folder)
    ck, sink = tempfile.mkdtemp(prefix="ll-stream-ck-"), tempfile.mkdtemp(prefix="ll-stream-out-")
    q = monitor_stream.start_drift(spark, folder, m.current.schema, m.reference, ck, sink)
    q.awaitTermination(300)
    got = spark.read.parquet(f"{sink}/drift")
    assert got.select("batch_id").distinct().count() == 1  # all files in one micro-batch
    want = {(r["batch"], r["column"]): r["drift"] for r in m.drift.collect()}
    have = {(r["batch"], r["column"]): r["drift"] for r in got.collect()}
    assert have.keys() == want.keys()
    for k, v in want.items():
        assert have[k] == pytest.approx(v, rel=1e-9, abs=1e-12)
    # a retried micro-batch rewrites its own partition: no duplicate rows
    bid = got.first()["batch_id"]
    write_partitioned(got.filter(F.col("batch_id") == bid), f"{sink}/drift", "batch_id")
    assert spark.read.parquet(f"{sink}/drift").count() == len(want)


def test_streaming_month_split_over_micro_batches_equals_batch(spark):
    """Every month's rows land in two micro-batches: the valid drift, summaries
    and alerts are those of the whole months."""
    from ledgerlake.operators import monitor
    from ledgerlake.plans.q_monitor import INPUTS, Monitoring
    from ledgerlake.streaming import monitor_stream

    m = Monitoring(spark, "/root/testdata/sf0.001")
    folder = tempfile.mkdtemp(prefix="ll-stream-cur-") + "/in"
    schema = m.current.schema
    ck, sink = tempfile.mkdtemp(prefix="ll-stream-ck-"), tempfile.mkdtemp(prefix="ll-stream-out-")
    for half in (0, 1):
        part = m.current.filter(F.pmod(F.xxhash64("loan_id"), F.lit(2)) == half)
        part.coalesce(1).write.mode("append").parquet(folder)
        assert monitor_stream.start_drift(spark, folder, schema, m.reference, ck, sink).awaitTermination(300)
    assert spark.read.parquet(f"{sink}/drift").select("batch_id").distinct().count() == 2
    want = {(r["batch"], r["column"]): r["drift"] for r in m.drift.collect()}
    rows = monitor_stream.latest(spark, sink, "drift").collect()
    have = {(r["batch"], r["column"]): r["drift"] for r in rows}
    assert len(rows) == len(want) and have.keys() == want.keys()
    for k, v in want.items():
        assert have[k] == pytest.approx(v, rel=1e-9, abs=1e-12)
    columns = m.summaries.columns
    assert sorted(map(tuple, monitor_stream.latest(spark, sink, "summaries").select(columns).collect())) == \
        sorted(map(tuple, m.summaries.collect()))
    log = monitor.alert_log(monitor.missing_alerts(m.summaries, m.missing, INPUTS), monitor.category_alerts(m.new_cats),
                            monitor.retrain_alerts(m.summaries))
    written = spark.read.parquet(f"{sink}/alerts/batch_id=1").select(log.columns)
    assert sorted(map(str, written.collect())) == sorted(map(str, log.collect()))
