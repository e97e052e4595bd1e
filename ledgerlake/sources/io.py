"""Sources and sinks (S-1, S-3, S-4, S-5, S-6).

* S-1: the raw loan CSV is read with an explicit schema (types never
  inferred), its columns taken by the name in the header, PERMISSIVE mode (an
  unparsable cell becomes null), projection to the allowlist + bookkeeping
  columns at the source, and file-footer rows (null status) dropped.
  ``multiline=True`` keeps quoted newlines inside a record, but makes a file
  unsplittable; it is off unless asked for.
* S-3/S-4: partitioned parquet writes (``split``, ``batch``) with dynamic
  partition overwrite, so re-writing one month replaces only that month.
* S-5: report tables as JSON lines.
* S-6: the decision bundle -- fitted preprocessing statistics, the MLlib model,
  the isotonic calibrator and a one-row metadata table. Every save writes a new
  version folder and then appends the metadata row that names it, so a reader
  sees a complete bundle or none; an existing bundle is not superseded unless
  forced.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import config as C

_STRING = {"term", "grade", "sub_grade", "emp_length", "home_ownership", "verification_status", "purpose",
           "addr_state", "earliest_cr_line", "initial_list_status", "issue_d", "loan_status"}


def raw_schema(extra: tuple[str, ...] = ("id",)) -> T.StructType:
    """Explicit schema of the raw loan file: the kept columns with their types
    (everything numeric is double, text stays text)."""
    cols = list(dict.fromkeys(list(extra) + list(C.ALLOWLIST) + list(C.BOOKKEEPING)))
    return T.StructType([
        T.StructField(c, T.StringType() if (c in _STRING or c in extra) else T.DoubleType(), True) for c in cols
    ])


def read_loans_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   multiline: bool = False) -> DataFrame:
    """S-1: CSV scan with projection at the source and footer rows dropped.

    Spark matches a CSV schema to the file by position, so the schema is laid
    out in the order of the header (unlisted columns as text, never parsed) and
    the columns are then selected by name. A column of ``schema`` that the
    header lacks raises, and so does a file of the folder whose header differs
    (``enforceSchema``)."""
    schema = schema or raw_schema()
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
    header = reader.option("inferSchema", False).csv(path).columns
    absent = [f.name for f in schema.fields if f.name not in header]
    if absent:
        raise ValueError(f"columns absent from the CSV header: {absent}")
    listed = {f.name: f for f in schema.fields}
    in_file = T.StructType([listed.get(name, T.StructField(name, T.StringType(), True)) for name in header])
    df = reader.option("mode", "PERMISSIVE").option("enforceSchema", False).schema(in_file).csv(path)
    keep = [c for c in list(C.ALLOWLIST) + list(C.BOOKKEEPING) if c in listed]
    extra = [f.name for f in schema.fields if f.name not in keep]
    return df.select(*extra, *keep).filter(F.col("loan_status").isNotNull())


def write_partitioned(df: DataFrame, path: str, by: str | list[str]) -> None:
    """S-3/S-4: parquet partitioned by ``by``; only the partitions present in
    ``df`` are replaced (dynamic partition overwrite). The mode is a writer
    option, not a session setting, so concurrent writers (streaming batches)
    do not race on it. Rewriting the same partitions is idempotent."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """S-5: a tidy report table as JSON lines; in one file only if asked for."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").json(path)


_METADATA = "seq long, version string, metadata string, prep_stats string"


# --- S-6 decision bundle ---------------------------------------------------------------

@dataclass
class BundleMetadata:
    model_family: str
    threshold: float
    calibrated_risk_at_threshold: float
    lgd: float
    prepay_factor: float
    feature_columns: list[str] = field(default_factory=C.feature_columns)
    categorical_vocabulary: dict[str, list[str]] = field(default_factory=dict)
    train_window: dict[str, str] = field(default_factory=dict)
    cv_log_loss: float | None = None
    test_return_per_dollar: float | None = None
    #: Families without a fitted model: rate per level ("" for all others).
    rates: dict[str, float] = field(default_factory=dict)
    schema_version: int = 1


def _saved(spark: SparkSession, root: str):
    """The latest metadata row of a bundle, None if there is no bundle. Any
    other failure to read it (permissions, network) is raised."""
    try:
        rows = spark.read.schema(_METADATA).json(f"{root}/metadata")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.orderBy(F.col("seq").desc()).first()


def save_bundle(spark: SparkSession, path: str, meta: BundleMetadata, stats, model, calibrator,
                force: bool = False) -> str:
    """Write the complete bundle, or refuse when one already exists. The
    metadata row comes last: a save that fails before leaves the bundle as it
    was."""
    root = path.rstrip("/")
    last = _saved(spark, root)
    if last is not None and not force:
        raise FileExistsError(f"bundle already exists at {root}; pass force=True to replace it")
    version = uuid.uuid4().hex
    for name, part in (("model", model), ("calibrator", calibrator)):
        if part is not None:
            part.write().save(f"{root}/versions/{version}/{name}")
    row = (last["seq"] + 1 if last else 1, version, json.dumps(asdict(meta), sort_keys=True),
           stats.to_json() if stats is not None else None)
    spark.createDataFrame([row], _METADATA).coalesce(1).write.mode("append").json(f"{root}/metadata")
    return root


def load_bundle(spark: SparkSession, path: str, model_class, calibrator_class):
    """Read the bundle back: (metadata, prep stats, model, calibrator); the
    last three are None where the family has none."""
    from ledgerlake.operators.preprocess import PrepStats

    root = path.rstrip("/")
    row = _saved(spark, root)
    if row is None:
        raise FileNotFoundError(f"no bundle at {root}")
    version = f"{root}/versions/{row['version']}"
    meta = BundleMetadata(**json.loads(row["metadata"]))
    stats = PrepStats.from_json(row["prep_stats"]) if row["prep_stats"] else None
    model = model_class.load(f"{version}/model") if model_class is not None else None
    return meta, stats, model, calibrator_class.load(f"{version}/calibrator") if calibrator_class is not None else None
