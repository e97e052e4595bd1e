"""D-12: monitoring loan files as they land (Structured Streaming).

Scored production files arrive in a folder (one or more parquet files per
month). A streaming query keeps the per-month summary (loans, fund rate,
mean probability, outcome coverage) in update mode. The drift query lands every
micro-batch's rows by month, runs the batch drift/quality operators against the
fixed reference over all that has landed for the months that changed, and
writes the alert log of all months.

The sinks are parquet folders whose partitions are replaced (dynamic
overwrite): the summary by month, the drift tables by micro-batch id. A
micro-batch that is retried after a lost executor or a restart rewrites the
same partitions instead of appending duplicates, and no result is kept on the
driver. A month's valid rows are those of the last micro-batch that computed
it (``latest``); its summary row is written last and makes them valid.

``window(ts, '1 month')`` is not accepted by Spark (months have no fixed
length), so the month key ``batch`` is the grouping key, as in the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerlake import config as C
from ledgerlake.operators import monitor
from ledgerlake.sources.io import write_partitioned


_NO_ROWS_POSSIBLE = {
    "missing": "batch string, column string, increase double, batch_id long",
    "new_categories": "batch string, column string, value string, batch_id long",
}


def _arriving(spark: SparkSession, folder: str, schema: StructType, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(folder)


def monthly_stream(spark: SparkSession, folder: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Streaming per-month summary of the arriving scored loans."""
    rows = _arriving(spark, folder, schema, max_files)
    return rows.groupBy("batch").agg(
        F.count(F.lit(1)).alias("loans"),
        F.avg((F.col("decision") == "fund").cast("double")).alias("fund_rate"),
        F.avg("probability_of_default").alias("mean_probability"),
        F.avg(F.col("outcome_known").cast("double")).alias("outcome_known"),
    )


def start_summary(spark: SparkSession, folder: str, schema: StructType, checkpoint: str, sink_path: str,
                  trigger_once: bool = True):
    """Run the summary in update mode: each micro-batch's updated months
    replace their ``batch`` partitions under ``sink_path``, so the folder
    always holds the latest value per month."""

    def process(updated: DataFrame, batch_id: int) -> None:
        write_partitioned(updated, sink_path, "batch")

    writer = (
        monthly_stream(spark, folder, schema).writeStream.outputMode("update")
        .foreachBatch(process).option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="1 minute")
    return writer.start()


def latest(spark: SparkSession, sink_path: str, name: str) -> DataFrame:
    """The valid rows of a drift table (``drift``, ``missing``,
    ``new_categories``, ``summaries``): each month's last computation."""
    reader = spark.read.schema(_NO_ROWS_POSSIBLE[name]) if name in _NO_ROWS_POSSIBLE else spark.read
    last = (spark.read.parquet(f"{sink_path}/summaries").groupBy("batch")
            .agg(F.max("batch_id").cast("long").alias("batch_id")))
    rows = reader.parquet(f"{sink_path}/{name}").withColumn("batch_id", F.col("batch_id").cast("long"))
    return rows.join(last, ["batch", "batch_id"], "left_semi").drop("batch_id")


def alerts(spark: SparkSession, sink_path: str) -> DataFrame:
    """The alert log over all months so far."""
    numeric, categorical = C.monitored_columns()
    summaries, new = latest(spark, sink_path, "summaries"), latest(spark, sink_path, "new_categories")
    missing = monitor.missing_alerts(summaries, latest(spark, sink_path, "missing"), numeric + categorical)
    return monitor.alert_log(missing, monitor.category_alerts(new), monitor.retrain_alerts(summaries))


def start_drift(spark: SparkSession, folder: str, schema: StructType, reference: DataFrame, checkpoint: str,
                sink_path: str, trigger_once: bool = True, max_files: int | None = None):
    """Per micro-batch: drift and data-quality tables over the whole of each
    month that got rows, written under ``sink_path`` partitioned by
    ``batch_id`` (a retried batch replaces its own partition), and the alert
    log of all months as it is then (``alerts/batch_id=N``)."""
    numeric, categorical = C.monitored_columns()
    inputs = numeric + categorical
    watched = numeric + [C.PREDICTION_COLUMN]
    profile = monitor.reference_profile(reference, watched)  # once, not a micro-batch
    landed_path = f"{sink_path}/landed"
    landed_schema = StructType([*schema.fields, StructField("batch_id", LongType())])

    def process(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        here, tag = batch_df.sparkSession, F.lit(batch_id).cast("long")
        write_partitioned(batch_df.withColumn("batch_id", tag), landed_path, ["batch", "batch_id"])
        months = [r["batch"] for r in batch_df.select("batch").distinct().collect()]  # calendar months
        rows = (here.read.schema(landed_schema).parquet(landed_path)
                .filter(F.col("batch").isin(*months) & (F.col("batch_id") <= batch_id)).drop("batch_id"))

        def write(table: DataFrame, name: str) -> DataFrame:
            write_partitioned(table.withColumn("batch_id", tag), f"{sink_path}/{name}", "batch_id")
            reader = here.read.schema(StructType([*table.schema.fields, StructField("batch_id", LongType())]))
            return reader.parquet(f"{sink_path}/{name}").filter(F.col("batch_id") == batch_id).drop("batch_id")

        num = monitor.numeric_drift(profile, rows, watched)
        drift = write(num.unionByName(monitor.categorical_drift(reference, rows, categorical)), "drift")
        missing = write(monitor.missing_increase(reference, rows, inputs), "missing")
        new = write(monitor.new_categories(reference, rows, categorical), "new_categories")
        write(monitor.batch_summaries(rows, drift, missing, new, inputs), "summaries")
        alerts(here, sink_path).write.mode("overwrite").parquet(f"{sink_path}/alerts/batch_id={batch_id}")

    stream = _arriving(spark, folder, schema, max_files)
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="1 minute")
    return writer.start()
