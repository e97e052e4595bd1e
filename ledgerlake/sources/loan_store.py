"""The loan table, written once per application.

The loan view joins four large tables; every stage (labels, splits, fitted
statistics, monitoring) reads it several times. As the reference pipeline
does with its ingest stage, the joined rows are written once as a parquet table
in the shared folder named by ``spark.checkpoint.dir``, with the given columns
and the view's few-valued texts (half of the view's bytes), and every later read
is a column-pruned scan that computes the other columns it needs. The write also cuts the lineage, so a
lost executor never forces the four-way join to be recomputed.

The table is partitioned by issue month (``issue_ym`` = 'yyyy-MM', parsed with
the same pattern as ``issue_date``). Every split and the monitoring window are
date ranges, so ``loan_window`` adds the matching month range as a partition
filter: the test year reads its own twelve folders, not the whole table. Rows
whose month cannot be parsed land in the null partition, which every window
keeps, so the strict date parse downstream still sees (and rejects) them.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.session import session_folder
from ledgerlake.sources.tables import issue_month, loan_columns, narrow_rows, with_marks, with_texts

MONTH_COL = "issue_ym"

_LOCK = threading.RLock()  # stage builds read the loan table under the same lock
# (application id, folder, table, files, parameters) -> (path, schema). The schema is the one
# written (partition column last, as text): reads neither list the folder
# again nor infer the partition column's type.
_WRITTEN: dict[tuple[str, ...], tuple[str, StructType]] = {}


#: The given tables behind the loan view.
SOURCES = ("lineitem", "orders", "customer", "part")


def source_key(spark: SparkSession, sf_dir: str) -> str:
    """The state of the files behind the loan view: their paths, sizes and
    times, listed by Spark (no content is read). Part of every stage's key, so
    a changed file gives new stages."""
    paths = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCES]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    one = F.xxhash64("path", "length", F.col("modificationTime").cast("string")).cast("decimal(38,0)")
    row = files.agg(F.count(F.lit(1)), F.sum(one)).first()
    return f"{row[0]}:{row[1]}"


def params_key(params) -> str:
    """The parameters that a stage depends on, for its key."""
    return hashlib.sha1(repr(params).encode()).hexdigest()[:12]


def _write_once(spark: SparkSession, sf_dir: str, name: str, build, partition_by: str | None,
                source: str | None = None, params=None) -> DataFrame:
    source = source or source_key(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name, source, params_key(params))
    with _LOCK:
        hit = _WRITTEN.get(key)
        if hit is None:
            tag = hashlib.sha1("|".join(key[1:]).encode()).hexdigest()[:12]
            path = session_folder(spark, f"{name}-{tag}")
            df = build()
            writer = df.write.mode("overwrite")
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
            fields = [f for f in df.schema.fields if f.name != partition_by]
            if partition_by:
                fields.append(StructField(partition_by, StringType()))
            hit = _WRITTEN[key] = (path, StructType(fields))
    path, schema = hit
    return spark.read.schema(schema).parquet(path)


def _stored(spark: SparkSession, sf_dir: str, source: str | None = None) -> DataFrame:
    """The rows behind the loan view, written by month; the view's columns are
    computed from them as they are read."""

    def build():
        month = F.date_format(F.try_to_date(issue_month(F.col("l_shipdate")), "MMM-yyyy"), "yyyy-MM")
        # A month's rows meet in few tasks: a file for each month and task is
        # too many small ones. A rebalance splits a month with many rows. The
        # rows travel narrow, their texts are made where they are written.
        return with_texts(with_marks(narrow_rows(spark, sf_dir).withColumn(MONTH_COL, month).hint("rebalance", MONTH_COL)))

    return _write_once(spark, sf_dir, "loans", build, MONTH_COL, source)


def loan_table(spark: SparkSession, sf_dir: str, source: str | None = None) -> DataFrame:
    """All loans (the raw columns only). ``source``: the files' state if it is
    known already."""
    return loan_columns(_stored(spark, sf_dir, source))


def loan_window(spark: SparkSession, sf_dir: str, start: str, end: str, source: str | None = None) -> DataFrame:
    """Loans whose issue month lies in [start, end] ('yyyy-MM-dd' bounds),
    plus unparseable months. A superset of the date filter the caller still
    applies, evaluated on partition values only."""
    m = F.col(MONTH_COL)
    keep = m.between(F.lit(start[:7]), F.lit(end[:7])) | m.isNull()
    return loan_columns(_stored(spark, sf_dir, source).filter(keep))


def stage_table(spark: SparkSession, sf_dir: str, name: str, build, partition_by: str | None = None,
                source: str | None = None, params=None) -> DataFrame:
    """A derived stage (e.g. the scored monthly batches) written once per
    application, state of the source files and ``params`` next to the loan
    table, and read back by every later query. ``build`` is called only on the
    first request. A partition column is read back as text."""
    return _write_once(spark, sf_dir, name, build, partition_by, source, params)
