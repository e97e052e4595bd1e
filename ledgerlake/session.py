"""Session helpers: a local session for tests/bench, checkpoint location, and a
size-checked broadcast."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default upper bound (rows) for a side that is broadcast explicitly. Bigger
# sides fall back to a shuffle join that Catalyst/AQE plans on its own.
BROADCAST_MAX_ROWS = 100_000


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlake") -> SparkSession:
    """A local session configured the way the library expects (tests, bench).

    ``LEDGERLAKE_EVENT_LOG=<folder>`` writes Spark's event log there (stage
    and task times for profiling; the web UI stays off)."""
    builder = SparkSession.builder
    event_dir = os.environ.get("LEDGERLAKE_EVENT_LOG")
    if event_dir:
        builder = (builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
                   .config("spark.eventLog.compress", "false"))
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared, fault-tolerant folder and is
    used as is. Only when it is unset (local tests) is a scratch folder made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one.

    Used for small reduced tables that are read by several passes."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def session_folder(spark: SparkSession, name: str) -> str:
    """A folder for tables written by this application under the shared
    checkpoint location (one subfolder per application id)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/ledgerlake-{spark.sparkContext.applicationId}/{name}"


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after proving it is small.

    The side is counted first (one cheap aggregate over an already reduced
    table); above the bound the plain DataFrame is returned and the join is
    planned as a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def round_half_up(col, digits: int):
    """floor(x*10^k + 0.5)/10^k: identical on Spark and DuckDB (no decimal
    text rounding), used for every reported rounding."""
    scale = float(10 ** digits)
    return F.floor(col * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
