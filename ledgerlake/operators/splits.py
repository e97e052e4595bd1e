"""Time splits and expanding-window folds (F-5, F-6, F-7, C-7, A-17).

All of these are narrow column expressions or one aggregate: rows are tagged
in place, never copied per fold by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import config as C


def _between(c: Column, start: str, end: str) -> Column:
    return c.between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def split_expr(p: C.Params = C.DEFAULT, date_col: str = "issue_date") -> Column:
    """F-5: train / validation / test (bounds inclusive, train first) else unused."""
    d = F.col(date_col)
    expr = F.lit("unused")
    for name, w in reversed(list(p.split_windows().items())):
        expr = F.when(_between(d, w.start, w.end), F.lit(name)).otherwise(expr)
    return expr


def assign_split(df: DataFrame, p: C.Params = C.DEFAULT) -> DataFrame:
    return df.withColumn("split", split_expr(p))


def split_part(df: DataFrame, name: str, p: C.Params = C.DEFAULT) -> DataFrame:
    """One split, filtered on the date window so the predicate reaches the scan."""
    w = p.split_windows()[name]
    return df.filter(_between(F.col("issue_date"), w.start, w.end))


def calibration_tuning(validation: DataFrame, p: C.Params = C.DEFAULT) -> tuple[DataFrame, DataFrame]:
    """F-6: calibration half (< mid) and tuning half (>= mid)."""
    mid = F.lit(p.calibration_end).cast("date")
    return validation.filter(F.col("issue_date") < mid), validation.filter(F.col("issue_date") >= mid)


def fold_roles(df: DataFrame, p: C.Params = C.DEFAULT) -> DataFrame:
    """F-7: one row per (loan, fold, role) where role is train or validate.

    A loan belongs to every fold whose train window covers it and to at most
    one validation year; the membership is computed per row as an array and
    exploded, so no join and no per-fold rescan is needed.
    """
    d = F.col("issue_date")
    tags = []
    for i, f in enumerate(p.folds, start=1):
        tags.append(F.when(d <= F.lit(f.train_end).cast("date"), F.struct(F.lit(i).alias("fold"), F.lit("train").alias("role"))))
        tags.append(F.when(F.year(d) == f.validate_year, F.struct(F.lit(i).alias("fold"), F.lit("validate").alias("role"))))
    tagged = df.withColumn("_tag", F.explode(F.array_compact(F.array(*tags))))
    return tagged.select("*", "_tag.fold", "_tag.role").drop("_tag")


def fold_conditions(p: C.Params = C.DEFAULT) -> dict[int, tuple[Column, Column]]:
    """F-7 as conditions: fold -> (train side, validation side)."""
    d = F.col("issue_date")
    return {i: (d <= F.lit(f.train_end).cast("date"), F.year(d) == f.validate_year) for i, f in enumerate(p.folds, start=1)}


def fold_frames(train: DataFrame, p: C.Params = C.DEFAULT) -> list[tuple[int, DataFrame, DataFrame]]:
    """F-7 as DataFrame pairs (used by CV); an empty side raises."""
    out = []
    for i, f in enumerate(p.folds, start=1):
        tr = train.filter(F.col("issue_date") <= F.lit(f.train_end).cast("date"))
        va = train.filter(F.year("issue_date") == f.validate_year)
        if tr.limit(1).count() == 0 or va.limit(1).count() == 0:
            raise ValueError(f"empty fold: {f}")
        out.append((i, tr, va))
    return out


def fold_sizes(train: DataFrame, p: C.Params = C.DEFAULT) -> DataFrame:
    """Rows and default rate per (fold, role): one aggregate over the tags."""
    return fold_roles(train, p).groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("loans"),
        F.avg("target").alias("default_rate"),
        F.min("issue_date").cast("string").alias("first_issue_date"),
        F.max("issue_date").cast("string").alias("last_issue_date"),
    )


def split_profile(prepared: DataFrame, p: C.Params = C.DEFAULT) -> DataFrame:
    """A-17: loans, default rate, average loan and rate per split."""
    return assign_split(prepared, p).filter(F.col("split") != "unused").groupBy("split").agg(
        F.count(F.lit(1)).alias("loans"),
        F.avg("target").alias("default_rate"),
        F.avg("loan_amnt").alias("avg_loan"),
        F.avg("int_rate").alias("avg_int_rate"),
    )


def split_overlap(df_with_split: DataFrame, key_cols: list[str]) -> DataFrame:
    """C-7: keys that appear in more than one split (one shuffle on the key).

    Returns one summary row: distinct keys and keys found in several splits.
    """
    per_key = df_with_split.groupBy(*key_cols).agg(F.countDistinct("split").alias("n_splits"))
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("n_splits") > 1).alias("keys_in_several_splits"),
    )
