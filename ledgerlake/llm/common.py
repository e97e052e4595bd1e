"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.session import session_folder

#: The six ASCII white-space characters of the word and line definitions.
ASCII_SPACE = b" \t\n\x0b\x0c\r"

#: Rows per Arrow batch. Whole texts travel to Python, so a batch is kept far
#: below Spark's default of 10,000 rows: a few hundred long texts fit a worker.
ARROW_BATCH_ROWS = 512

#: Arrow types by Spark's names of them.
ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32()),
}


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small for the jobs that this session runs next (the
    setting is read when a plan runs, so it stays set)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))


def named(name: str) -> Column:
    """The column of exactly this name, dots and back-quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def stage_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return session_folder(spark, f"llm/{name}-{uuid.uuid4().hex[:10]}")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back:
    several passes share one computation and a lost executor loses nothing."""
    path = stage_folder(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, name: str, folders: list[str]) -> DataFrame:
    """``stored``, with its folder added to ``folders``."""
    path = stage_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    folders.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Delete stages that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the files of a job's shuffles go when the job ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: Rows of a few numbers that may be broadcast.
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, name: str) -> DataFrame:
    """A side of a join, written and counted: broadcast up to
    ``BROADCAST_ROWS`` rows, so that the other side is not dealt by its (maybe
    hot) keys; above that, left to a shuffle join whose skew AQE splits."""
    side = stored(df, name)
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def batch_columns(
    df: DataFrame,
    keep: list[str],
    use: list[str],
    make: Callable[[], Callable[..., dict[str, list]]],
    out: dict[str, str],
) -> DataFrame:
    """Add computed columns batch by batch in Python.

    ``keep`` columns pass through as they are (nulls and 64-bit ids stay
    exact); ``make()`` runs once a task and gives a function from the lists of
    the ``use`` columns to a dict of equally long lists, typed by ``out``."""
    place = {c: f"c{i}" for i, c in enumerate(dict.fromkeys(keep + use))}  # names that no job trips over
    picked = df.select(*[named(c).alias(p) for c, p in place.items()])
    made = StructType.fromDDL(", ".join(f"r{i} {v}" for i, v in enumerate(out.values())))
    schema = StructType([picked.schema[place[k]] for k in keep] + made.fields)

    def run(batches):
        fn = make()
        for b in batches:
            got = fn(*[b.column(b.schema.get_field_index(place[c])).to_pylist() for c in use])
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(place[k])) for k in keep]
                + [pa.array(got[k], type=ARROW[v]) for k, v in out.items()],
                names=schema.names,
            )

    return picked.mapInArrow(run, schema).toDF(*keep, *out)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (in any case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
