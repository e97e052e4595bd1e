"""Data contract (C-2 .. C-6).

Every rule is a boolean column; all violations of all rules are counted in
ONE aggregate pass (``count_if`` per rule), then unpivoted into a tidy
(column, rule, violations) table. Nothing row-level leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import config as C

# --- C-2 processed schema ---------------------------------------------------

# (column, expected Spark type, nullable)
PROCESSED_TYPES = (
    ("target", T.ByteType(), False),
    ("issue_date", T.DateType(), False),
    ("loan_amnt", T.DoubleType(), False),
    ("int_rate", T.DoubleType(), False),
    ("installment", T.DoubleType(), False),
    ("grade", T.StringType(), False),
    ("annual_inc", T.DoubleType(), True),
    ("dti", T.DoubleType(), True),
    ("fico_mid", T.DoubleType(), False),
    ("term_months", T.ShortType(), False),
    ("realized_profit", T.DoubleType(), False),
)


def value_rules() -> list[tuple[str, str, Column]]:
    """(column, rule name, violation predicate). A null in a non-nullable
    column is its own 'not_null' violation; value checks skip nulls."""
    c = F.col
    rules = [
        ("target", "isin_0_1", ~c("target").isin(0, 1)),
        ("loan_amnt", "in_range_500_40000", ~c("loan_amnt").between(500, 40000)),
        ("int_rate", "in_range_0_40", ~c("int_rate").between(0, 40)),
        ("installment", "gt_0", ~(c("installment") > 0)),
        ("grade", "isin_A_G", ~c("grade").isin(*C.GRADES)),
        ("annual_inc", "ge_0", ~(c("annual_inc") >= 0)),
        ("dti", "lt_999", ~(c("dti") < 999)),
        ("fico_mid", "in_range_600_900", ~c("fico_mid").between(600, 900)),
        ("term_months", "eq_36", ~(c("term_months") == 36)),
    ]
    for name, _, nullable in PROCESSED_TYPES:
        if not nullable:
            rules.append((name, "not_null", c(name).isNull()))
    return rules


def type_violations(df: DataFrame) -> list[str]:
    """Schema-level part of C-2 (driver-side, no data read)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name, dtype, _ in PROCESSED_TYPES:
        if name not in fields:
            out.append(f"{name}: missing column")
        elif fields[name] != dtype:
            out.append(f"{name}: expected {dtype.simpleString()}, got {fields[name].simpleString()}")
    return out


def schema_violations(df: DataFrame, group_col: str | None = None) -> DataFrame:
    """C-2: violations per (group, column, rule) in one pass."""
    rules = value_rules()
    aggs = [F.count_if(F.coalesce(pred, F.lit(False))).alias(f"r{i}") for i, (_, _, pred) in enumerate(rules)]
    grouped = df.groupBy(group_col).agg(*aggs) if group_col else df.agg(*aggs)
    structs = [
        F.struct(F.lit(col).alias("column"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, (col, rule, _) in enumerate(rules)
    ]
    keep = [group_col] if group_col else []
    return grouped.select(*keep, F.explode(F.array(*structs)).alias("v")).select(*keep, "v.*")


def validate(df: DataFrame) -> DataFrame:
    """Raise if the frame breaks the contract (types, values, forbidden
    columns); otherwise return it unchanged."""
    assert_no_forbidden_columns(df)
    problems = type_violations(df)
    bad = schema_violations(df).filter(F.col("violations") > 0).collect()
    problems += [f"{r['column']}: {r['rule']} x{r['violations']}" for r in bad]
    if problems:
        raise ValueError(f"schema validation failed: {problems}")
    return df


# --- C-3 forbidden columns ----------------------------------------------------

def forbidden_columns(columns: list[str]) -> list[str]:
    return [
        c for c in columns
        if c.startswith(C.FORBIDDEN_PREFIXES) and c not in C.FORBIDDEN_ALLOWED
    ]


def assert_no_forbidden_columns(df: DataFrame) -> None:
    leaked = forbidden_columns(df.columns)
    if leaked:
        raise ValueError(f"post-issuance columns found in processed data: {leaked}")


# --- C-4 missingness -------------------------------------------------------------

def missingness(train: DataFrame) -> DataFrame:
    """Null share per candidate column on the train split (one aggregate).

    Candidates: skewed + numeric + indicator + nominal; structural columns are
    listed too but exempt.
    """
    candidates = list(C.SKEWED_AMOUNT) + list(C.NUMERIC) + list(C.NUMERIC_WITH_INDICATOR) + list(C.NOMINAL)
    listed = candidates + list(C.STRUCTURAL_MISSING)
    shares = train.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in listed])
    structs = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("null_share"), F.lit(c in C.STRUCTURAL_MISSING).alias("exempt"))
        for c in listed
    ]
    long = shares.select(F.explode(F.array(*structs)).alias("m")).select("m.*")
    return long.withColumn(
        "too_empty", (~F.col("exempt")) & (F.col("null_share") > C.MAX_MISSING_FRACTION)
    )


def check_missingness(train: DataFrame) -> None:
    bad = missingness(train).filter("too_empty").collect()
    if bad:
        raise ValueError(
            f"columns exceed max_missing_fraction={C.MAX_MISSING_FRACTION} in training data: "
            f"{ {r['column']: round(r['null_share'], 4) for r in bad} }"
        )


# --- C-5 application quarantine ------------------------------------------------------

def application_rules(apps: DataFrame) -> list[tuple[str, Column]]:
    """(reason code, violation predicate) for request rows.

    Field rules come first, then the cross-field rules. Unlike a validator
    that stops at the first error, every reason of every row is reported. The
    rules never fail on a row: a month that has the form of one but names none
    has its own code, and the installment rule is silent where there is no
    scheduled installment (a field rule has rejected such a row).
    """
    from ledgerlake.functions.features import expected_installment, try_month_date

    c = F.col
    present = lambda name: c(name).isNotNull()
    rules = [
        ("loan_amnt", ~(present("loan_amnt") & (c("loan_amnt") > 0) & (c("loan_amnt") <= 40000))),
        ("term_months", ~(present("term_months") & (c("term_months") == 36))),
        ("int_rate", ~(present("int_rate") & (c("int_rate") > 0) & (c("int_rate") <= 40))),
        ("installment", ~(present("installment") & (c("installment") > 0))),
        ("grade", ~(present("grade") & c("grade").isin(*C.GRADES))),
        ("sub_grade", ~(present("sub_grade") & c("sub_grade").rlike(C.SUB_GRADE_PATTERN))),
        ("purpose", ~(present("purpose") & c("purpose").isin(*C.PURPOSE_LEVELS))),
        ("initial_list_status", ~(present("initial_list_status") & c("initial_list_status").isin(*C.INITIAL_LIST_LEVELS))),
        ("application_date", ~(present("application_date") & c("application_date").rlike(C.MONTH_PATTERN))),
        ("annual_inc", ~(present("annual_inc") & (c("annual_inc") >= 0))),
        ("emp_length", ~(c("emp_length").isNull() | c("emp_length").isin(*C.EMP_LENGTH_LEVELS))),
        ("home_ownership", ~(present("home_ownership") & c("home_ownership").isin(*C.HOME_OWNERSHIP_LEVELS))),
        ("verification_status", ~(present("verification_status") & c("verification_status").isin(*C.VERIFICATION_LEVELS))),
        ("addr_state", ~(present("addr_state") & c("addr_state").rlike(C.STATE_PATTERN))),
        ("earliest_cr_line", ~(present("earliest_cr_line") & c("earliest_cr_line").rlike(C.MONTH_PATTERN))),
        ("fico_range_low", ~(present("fico_range_low") & c("fico_range_low").between(300, 900))),
        ("fico_range_high", ~(present("fico_range_high") & c("fico_range_high").between(300, 900))),
    ]
    for name in ("delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "total_acc", "acc_now_delinq"):
        rules.append((name, ~(present(name) & (c(name) >= 0))))
    scheduled = expected_installment(c("loan_amnt"), c("int_rate"), c("term_months").cast("double"))
    for name in ("application_date", "earliest_cr_line"):
        rules.append((f"{name}_invalid", c(name).rlike(C.MONTH_PATTERN) & try_month_date(c(name)).isNull()))
    rules += [
        ("fico_range_order", c("fico_range_high") < c("fico_range_low")),
        ("addr_state_not_us", ~c("addr_state").isin(*C.US_STATES)),
        ("installment_inconsistent", F.abs(F.try_divide(c("installment"), scheduled) - 1) > C.INSTALLMENT_TOLERANCE),
    ]
    return rules


def quarantine(apps: DataFrame) -> DataFrame:
    """C-5: attach ``reasons`` (array of rule codes, rule order) and ``accepted``.

    Narrow: no shuffle; accepted/rejected tables are two filters of this one.
    """
    rules = application_rules(apps)
    reasons = F.array_compact(F.array(*[F.when(F.coalesce(pred, F.lit(False)), F.lit(code)) for code, pred in rules]))
    return apps.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0)


def loans_as_applications(raw: DataFrame) -> DataFrame:
    """Raw loan rows shaped as requests (issue_d -> application_date,
    term -> term_months, status flag -> not_credit_policy)."""
    from ledgerlake.functions.features import term_months

    return raw.withColumnRenamed("issue_d", "application_date").withColumns(
        {
            "term_months": term_months(F.col("term")).cast("int"),
            "not_credit_policy": F.col("loan_status").startswith(C.CREDIT_POLICY_STARTS),
        }
    )


# --- C-6 vocabulary gap ------------------------------------------------------------

def contract_vocabulary(spark) -> DataFrame:
    """Closed sets the request contract accepts, per nominal column."""
    rows = (
        [("home_ownership", v) for v in C.HOME_OWNERSHIP_LEVELS]
        + [("verification_status", v) for v in C.VERIFICATION_LEVELS]
        + [("purpose", v) for v in C.PURPOSE_LEVELS]
        + [("addr_state", v) for v in C.US_STATES]
        + [("initial_list_status", v) for v in C.INITIAL_LIST_LEVELS]
    )
    return spark.createDataFrame(rows, "column string, level string")


def trained_vocabulary(train: DataFrame, columns=C.NOMINAL) -> DataFrame:
    """Distinct levels per nominal column on the train split (nulls -> 'unknown',
    as the one-hot imputer does)."""
    structs = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit("unknown")).alias("level")) for c in columns]
    return train.select(F.explode(F.array(*structs)).alias("v")).select("v.*").distinct()


def vocabulary_gap(spark, train: DataFrame) -> DataFrame:
    """C-6: accepted-but-never-trained levels (left anti join; not fatal)."""
    return contract_vocabulary(spark).join(trained_vocabulary(train), ["column", "level"], "left_anti")
