import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="ledgerlake-test-ckpt-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("ledgerlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s


def raw_row(**overrides):
    """One raw loan row with plausible defaults (reference test shape)."""
    row = {
        "id": "1", "loan_amnt": 10000.0, "funded_amnt": 10000.0, "term": " 36 months", "int_rate": 12.0,
        "installment": 330.0, "grade": "B", "sub_grade": "B3", "emp_length": "3 years",
        "home_ownership": "RENT", "annual_inc": 60000.0, "verification_status": "Verified",
        "purpose": "credit_card", "addr_state": "CA", "dti": 15.0, "delinq_2yrs": 0.0,
        "earliest_cr_line": "Aug-2003", "fico_range_low": 690.0, "fico_range_high": 694.0,
        "inq_last_6mths": 0.0, "mths_since_last_delinq": None, "mths_since_last_record": None,
        "open_acc": 10.0, "pub_rec": 0.0, "revol_bal": 5000.0, "revol_util": 50.0, "total_acc": 20.0,
        "initial_list_status": "f", "pub_rec_bankruptcies": 0.0, "acc_now_delinq": 0.0,
        "collections_12_mths_ex_med": 0.0, "issue_d": "Jun-1997", "loan_status": "Fully Paid",
        "total_pymnt": 11500.0, "recoveries": 0.0,
    }
    row.update(overrides)
    return row


def raw_frame(spark, rows):
    from ledgerlake.sources.io import raw_schema

    schema = raw_schema()
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
