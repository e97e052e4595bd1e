"""The month-partitioned loan table: pruned windows return exactly the rows of
the unpruned date filters, and the month column never leaks into outputs."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="testdata not present")


def test_windows_prune_and_match_date_filters(spark):
    from ledgerlake import config as C
    from ledgerlake.operators import labels, splits
    from ledgerlake.plans.stages import Stages
    from ledgerlake.sources.loan_store import MONTH_COL, loan_table, loan_window

    raw = loan_table(spark, SF)
    assert MONTH_COL not in raw.columns
    w = C.DEFAULT.split_windows()["test"]
    plan = loan_window(spark, SF, w.start, w.end).select("loan_status")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and MONTH_COL in plan

    st = Stages(spark, SF)
    full = labels.transform(raw, C.DEFAULT, check_statuses=False)
    for name in ("train", "validation", "test"):
        pruned = st.part(name).select("loan_id")
        plain = splits.split_part(full, name, C.DEFAULT).select("loan_id")
        assert pruned.count() == plain.count() > 0
        assert pruned.exceptAll(plain).count() == 0
    prod_plain = labels.production_frame(raw, C.DEFAULT).select("loan_id")
    assert st.production.select("loan_id").exceptAll(prod_plain).count() == 0
    assert st.production.count() == prod_plain.count()


def test_stages_follow_files_and_parameters(spark, tmp_path):
    """A stage is built once for one state of the files and one set of
    parameters; a changed file or parameter gives a new one."""
    import shutil
    from dataclasses import replace

    import pyarrow.parquet as pq

    from ledgerlake import config as C
    from ledgerlake.plans.stages import Stages
    from ledgerlake.sources.loan_store import SOURCES

    for t in SOURCES:
        copy = shutil.copytree if os.path.isdir(f"{SF}/{t}.parquet") else shutil.copyfile
        copy(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    built = []

    def stage(p=C.DEFAULT, params=None):
        st = Stages(spark, str(tmp_path), p)
        return st.stored("probe", lambda: (built.append(1), spark.range(len(built)))[1], params=params).count()

    assert [stage(), stage()] == [1, 1] and len(built) == 1
    assert stage(params=("other",)) == 2 and stage(replace(C.DEFAULT, seed=1)) == 3 and stage() == 1
    before = Stages(spark, str(tmp_path)).raw.count()
    path = tmp_path / "lineitem.parquet"
    table = pq.read_table(path)
    pq.write_table(table.slice(0, 100), path / "more.parquet" if path.is_dir() else path)
    assert stage() == 4
    assert Stages(spark, str(tmp_path)).raw.count() == (before + 100 if path.is_dir() else 100)


def test_a_month_is_few_files_and_texts_are_kept(spark, tmp_path):
    """The stored rows of a month are not scattered over a file for each task,
    and the view read back equals the view made directly."""
    import shutil

    from ledgerlake.sources.loan_store import MONTH_COL, SOURCES, _stored, loan_table
    from ledgerlake.sources.tables import KEPT_TEXTS, loans

    for t in SOURCES:
        (shutil.copytree if os.path.isdir(f"{SF}/{t}.parquet") else shutil.copyfile)(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        stored = _stored(spark, str(tmp_path))
        months = stored.select(MONTH_COL).distinct().count()
        assert months <= len(stored.inputFiles()) <= 2 * months  # 40 tasks: far more files before
        assert set(KEPT_TEXTS) <= set(stored.columns) and "loan_id" not in stored.columns
        back, direct = loan_table(spark, str(tmp_path)), loans(spark, str(tmp_path))
        assert back.columns == direct.columns and back.dtypes == direct.dtypes
        assert back.exceptAll(direct).count() == 0 and direct.exceptAll(back).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_compared_texts_travel_as_numbers(spark, tmp_path):
    """The joined rows hold no text, and the view over them equals the view
    over the given columns, also where a text is null, unknown or longer."""
    import datetime as dt

    from pyspark.sql import functions as F
    from pyspark.sql.types import StringType

    from ledgerlake.sources.tables import loan_columns, loans, narrow_rows

    flags, status = ["N", "A", "R", "X", None, "NA"], ["F", "O", None]
    prios = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", None, "", "12"]
    kinds = ["ECONOMY TIN", "SMALL", "MEDIUM X", "PROMO Y", "STANDARD Z", "LARGE", None, "small", "ECONOM"]
    segments = ["BUILDING", "MACHINERY", "FURNITURE", "HOUSEHOLD", None, "BUILDINGS"]
    days = [dt.datetime(1995, 3, 2), dt.datetime(1997, 7, 4, 5), dt.datetime(2001, 8, 9), None]
    tables = {
        "lineitem": ([(i % 40, i % 31, i % 7, i % 8, float(i % 50 + 1), 100.0 + i, (i % 11) / 100, (i % 9) / 100,
                       flags[i % 6], status[i % 3], days[i % 4]) for i in range(600)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": ([(i % 38, i % 12, 1000.0 + i, prios[i % 7]) for i in range(41)],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"),
        "customer": ([(i, i % 25, -5.0 + i, segments[i % 6]) for i in range(12)],
                     "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(i % 30, i % 51, kinds[i % 9]) for i in range(33)], "p_partkey long, p_size int, p_type string"),
    }
    frames = {name: spark.createDataFrame(rows, ddl) for name, (rows, ddl) in tables.items()}
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    assert not [f.name for f in narrow_rows(spark, str(tmp_path)).schema if isinstance(f.dataType, StringType)]
    plain = (frames["lineitem"].join(frames["orders"].withColumn("o_priority", F.substring("o_orderpriority", 1, 1)),
                                     F.col("l_orderkey") == F.col("o_orderkey"))
             .join(frames["customer"], F.col("o_custkey") == F.col("c_custkey"))
             .join(frames["part"], F.col("l_partkey") == F.col("p_partkey")))
    want, got = loan_columns(plain), loans(spark, str(tmp_path))
    assert want.count() > 600 and want.dtypes == got.dtypes
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
