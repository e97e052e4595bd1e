"""Readers for the given parquet tables (S-2) and the loan-shaped view built
over them.

The loan view turns each ``lineitem`` row into one deterministic loan
(``lineitem`` join ``orders`` join ``customer`` join ``part``). Every column
is a built-in expression, so the whole view stays inside whole-stage codegen;
the three joins are plain equi-joins that Catalyst/AQE plan by size (sort-merge
at scale, broadcast when a dimension is small at runtime).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.config import CREDIT_POLICY_PREFIX

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


#: Bytes of (compressed) files that a partition of a join may hold.
PARTITION_FILE_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _c2(x: Column) -> Column:
    """Cents rounding that both engines evaluate identically."""
    return F.floor(x * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)


def _mon(k: Column) -> Column:
    return F.lit("JanFebMarAprMayJunJulAugSepOctNovDec").substr(k * 3 - 2, F.lit(3))


_STATES_24 = "AKALARAZCACOCTDCDEFLGAHIIDILINKSKYLAMAMDMEMIMNMO"


def issue_month(ship: Column) -> Column:
    """The text of the issue month ('Jun-1997')."""
    return F.concat(_mon(F.month(ship)), F.lit("-"), F.year(ship).cast("string"))


#: Texts of the given columns that the view only compares: the values that it
#: knows (of ``p_type`` the beginnings). Any other value counts as none.
MARKS = {
    "l_returnflag": ("N", "A", "R"),
    "l_linestatus": ("F",),
    "p_type": ("ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD"),
    "o_priority": ("1", "2", "3"),
    "c_mktsegment": ("BUILDING", "MACHINERY", "FURNITURE"),
}
#: Every mark is a digit of one number.
MARK_BASE = 8


def _marks(**texts: Column) -> Column:
    """The places of some texts among their known values, as digits of one number."""
    total = F.lit(0)
    for name, text in texts.items():
        place = F.lit(0)
        for i, known in enumerate(MARKS[name], start=1):
            place = F.when(text.startswith(known) if name == "p_type" else text == known, F.lit(i)).otherwise(place)
        total = total + place * F.lit(MARK_BASE ** list(MARKS).index(name))
    return total


def with_marks(rows: DataFrame) -> DataFrame:
    """The columns of ``MARKS`` from the numbers of ``narrow_rows``: the known
    value (its beginning), or null for any other."""
    code = F.col("_marks")
    texts = {name: F.get(F.array(*[F.lit(v) for v in known]), F.floor(code / MARK_BASE ** i).cast("int") % MARK_BASE - 1)
             for i, (name, known) in enumerate(MARKS.items())}
    return rows.withColumns(texts).drop("_marks")


def narrow_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined given columns behind the loan view, one narrow row a loan.

    The narrow sides meet first (customers go to their orders, parts to the
    lines), so that the lines are dealt once by part and once by order, with no
    more than the columns that the view is computed from; texts that the view
    only compares travel as digits of one number (``_marks``). A side that is
    small is broadcast."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
        _marks(l_returnflag=F.col("l_returnflag"), l_linestatus=F.col("l_linestatus")).alias("_lm"),
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", _marks(o_priority=F.substring("o_orderpriority", 1, 1)).alias("_om")
    )
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", _marks(c_mktsegment=F.col("c_mktsegment")).alias("_cm")
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", _marks(p_type=F.col("p_type")).alias("_pm"))
    owned = orders.join(customer, orders.o_custkey == customer.c_custkey).drop("o_custkey")
    owned = owned.withColumn("_om", F.col("_om") + F.col("_cm")).drop("_cm")
    # Hash-partition the lines on the orders join key. At scale this is the
    # exchange the join with the orders needs anyway; when the dimensions are
    # broadcast instead, it still spreads the work over many tasks even if the
    # input file is a single split. l_orderkey has a few lines per key.
    n = _partitions(spark, sf_dir, "lineitem")
    li = li.repartition(n, "l_partkey") if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else li
    li = li.join(part, li.l_partkey == part.p_partkey).withColumn("_lm", F.col("_lm") + F.col("_pm")).drop("p_partkey", "_pm")
    li = li.repartition(n, "l_orderkey")
    rows = li.join(owned, li.l_orderkey == owned.o_orderkey).drop("o_orderkey")
    return rows.withColumn("_marks", F.col("_lm") + F.col("_om")).drop("_lm", "_om")


def loan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``narrow_rows`` with the compared texts as columns."""
    return with_marks(narrow_rows(spark, sf_dir))


def _partitions(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Shuffle partitions for joins of a table: the session's, or more if its
    files are large (what a task sorts then stays in memory)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size = files.agg(F.sum("length")).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_FILE_BYTES))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loan rows (the 34 allowlisted + bookkeeping columns, plus
    ``loan_id``, ``grade_idx`` and ``l_shipdate``)."""
    return loan_columns(loan_rows(spark, sf_dir))


#: Columns of the view that are costly to make and cheap to keep (few distinct texts).
KEPT_TEXTS = ("term", "grade", "sub_grade", "emp_length", "home_ownership", "verification_status", "issue_d",
              "earliest_cr_line", "loan_status", "purpose", "addr_state")


def loan_columns(rows: DataFrame) -> DataFrame:
    """The loan view over ``loan_rows``: expressions of the row alone, so a
    reader computes only the columns that it asks for. Columns of the view that
    ``rows`` holds already (``with_texts``) are taken as they are."""
    j, view = _view(rows)
    kept = set(rows.columns) & set(KEPT_TEXTS)
    return j.select(*[F.col(c) if c in kept else made for c, made in view.items()])


def with_texts(rows: DataFrame) -> DataFrame:
    """``rows`` and the view's ``KEPT_TEXTS``."""
    j, view = _view(rows)
    return j.select(*rows.columns, *[view[c] for c in KEPT_TEXTS])


def _view(j: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The rows with the parts that several columns share, and the view's
    columns over them."""
    g = F.round(F.col("l_discount") * 100).cast("int") % 7
    u = (F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729 + F.col("l_orderkey") * 31) % 1000
    n = F.when(F.col("l_linenumber") == 7, F.lit(60)).otherwise(F.lit(36))
    ship = F.col("l_shipdate")
    in_2001 = ship >= F.lit("2001-01-01").cast("timestamp")

    j = j.select(
        "*",
        g.alias("grade_idx"),
        u.alias("_u"),
        n.alias("_n"),
        (u < 50 + 50 * g).alias("_bad"),
    )
    loan_amnt = _c2(F.lit(500.0) + F.col("l_extendedprice") * F.lit(0.37))
    int_rate = _c2(F.lit(6.0) + 3 * F.col("grade_idx") + F.col("l_tax") * 10)
    j = j.withColumns({"_amt": loan_amnt, "_rate": int_rate})
    r = F.col("_rate") / 1200
    inst = _c2(F.col("_amt") * r / (F.lit(1.0) - F.pow(F.lit(1.0) + r, -F.col("_n"))))
    j = j.withColumn("_inst", inst)

    k = F.col("p_size") % 13
    emp_length = (
        F.when(k == 0, F.lit(None).cast("string"))
        .when(k == 1, F.lit("< 1 year"))
        .when(k == 2, F.lit("1 year"))
        .when(k <= 10, F.concat((k - 1).cast("string"), F.lit(" years")))
        .when(k == 11, F.lit("10+ years"))
        .otherwise(F.lit("n/a"))
    )
    seg = F.col("c_mktsegment")
    home = (
        F.when(in_2001 & (F.col("p_size") == 50), F.lit("ANY"))
        .when(seg == "BUILDING", F.lit("MORTGAGE"))
        .when(seg == "MACHINERY", F.lit("OWN"))
        .when(seg == "FURNITURE", F.lit("OTHER"))
        .otherwise(F.lit("RENT"))
    )
    annual_inc = (
        F.when(F.col("p_size") == 7, F.lit(None).cast("double"))
        .when(F.col("c_acctbal") < 0, F.lit(0.0))
        .when(ship >= F.lit("2001-07-01").cast("timestamp"), F.col("c_acctbal") * 45)
        .otherwise(F.col("c_acctbal") * 15)
    )
    prio = F.col("o_priority")
    verification = (
        F.when(prio.isin("1", "2"), F.lit("Verified"))
        .when(prio == "3", F.lit("Source Verified"))
        .otherwise(F.lit("Not Verified"))
    )
    year = F.year(ship)
    issue_d = issue_month(ship)
    earliest = F.concat(
        _mon(F.col("c_custkey") % 12 + 1), F.lit("-"),
        (year - 5 - F.col("c_custkey") % 20).cast("string"),
    )
    flag = F.col("l_returnflag")
    base_status = (
        F.when(in_2001 & (flag == "N"), F.lit("Current"))
        .when(in_2001 & (flag == "A"), F.lit("Late (31-120 days)"))
        .when(F.col("_bad") & (F.col("_u") < 5), F.lit("Default"))
        .when(F.col("_bad"), F.lit("Charged Off"))
        .otherwise(F.lit("Fully Paid"))
    )
    policy = (ship < F.lit("1996-01-01").cast("timestamp")) & (flag == "R") & (prio == "1")
    status = F.when(policy, F.concat(F.lit(CREDIT_POLICY_PREFIX), base_status)).otherwise(base_status)
    ptype = F.col("p_type")
    purpose = (
        F.when(ptype.startswith("ECONOMY"), F.lit("car"))
        .when(ptype.startswith("SMALL"), F.lit("credit_card"))
        .when(ptype.startswith("MEDIUM"), F.lit("debt_consolidation"))
        .when(ptype.startswith("PROMO"), F.lit("wedding"))
        .when(ptype.startswith("STANDARD"), F.lit("home_improvement"))
        .otherwise(F.lit("small_business"))
    )
    nk = F.col("c_nationkey")
    state = (
        F.when((nk == 24) & in_2001, F.lit("ND"))
        .when(nk == 24, F.lit("CA"))
        .otherwise(F.lit(_STATES_24).substr(nk * 2 + 1, F.lit(2)))
    )
    qty = F.col("l_quantity")
    dti = F.when(qty == 50, F.lit(999.0)).when(qty == 49, F.lit(None).cast("double")).otherwise(_c2(qty * 0.8))
    fico_low = (F.lit(620) + 5 * (F.col("c_custkey") % 40)).cast("double")
    pk = F.col("l_partkey")
    ck = F.col("c_custkey")
    total_pymnt = F.when(F.col("_bad"), _c2(F.col("_amt") * 0.635)).otherwise(
        _c2(F.col("_amt") + (F.col("_inst") * F.col("_n") - F.col("_amt")) * 0.83)
    )
    loan_id = F.concat_ws(
        "-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        pk.cast("string"), F.col("l_suppkey").cast("string"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
    )
    out = [
        loan_id.alias("loan_id"),
        F.col("_amt").alias("loan_amnt"),
        F.col("_amt").alias("funded_amnt"),
        F.concat(F.lit(" "), F.col("_n").cast("string"), F.lit(" months")).alias("term"),
        F.col("_rate").alias("int_rate"),
        F.when(F.col("l_suppkey") % 50 == 0, _c2(F.col("_inst") / 10)).otherwise(F.col("_inst")).alias("installment"),
        F.lit("ABCDEFG").substr(F.col("grade_idx") + 1, F.lit(1)).alias("grade"),
        F.concat(
            F.lit("ABCDEFG").substr(F.col("grade_idx") + 1, F.lit(1)),
            (F.lit(1) + qty.cast("int") % 5).cast("string"),
        ).alias("sub_grade"),
        emp_length.alias("emp_length"),
        home.alias("home_ownership"),
        annual_inc.alias("annual_inc"),
        verification.alias("verification_status"),
        issue_d.alias("issue_d"),
        earliest.alias("earliest_cr_line"),
        status.alias("loan_status"),
        purpose.alias("purpose"),
        state.alias("addr_state"),
        dti.alias("dti"),
        fico_low.alias("fico_range_low"),
        (fico_low + 4).alias("fico_range_high"),
        (F.col("l_linenumber") % 3).cast("double").alias("delinq_2yrs"),
        (F.col("l_suppkey") % 4).cast("double").alias("inq_last_6mths"),
        (2 + pk % 18).cast("double").alias("open_acc"),
        (ck % 2).cast("double").alias("pub_rec"),
        (5 + pk % 35).cast("double").alias("total_acc"),
        F.when(F.col("l_linenumber") % 3 == 0, (pk % 80).cast("double")).alias("mths_since_last_delinq"),
        F.when(ck % 10 == 0, (40 + pk % 60).cast("double")).alias("mths_since_last_record"),
        _c2(F.col("o_totalprice") / 10).alias("revol_bal"),
        F.when(pk % 1000 == 0, F.lit(None).cast("double")).otherwise((pk % 1000) / 10.0).alias("revol_util"),
        F.when(F.col("l_linestatus") == "F", F.lit("f")).otherwise(F.lit("w")).alias("initial_list_status"),
        F.when(ck % 100 == 0, F.lit(None).cast("double")).otherwise((ck % 2).cast("double")).alias("pub_rec_bankruptcies"),
        F.lit(0.0).alias("acc_now_delinq"),
        F.lit(0.0).alias("collections_12_mths_ex_med"),
        F.lit(0.0).alias("recoveries"),
        total_pymnt.alias("total_pymnt"),
        F.col("grade_idx"),
        F.col("l_shipdate"),
        ]
    return j, dict(zip(j.select(*out).columns, out))
