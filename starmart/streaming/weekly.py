"""Near-real-time observations: weekly windows over a file stream (T3-02).

A Structured Streaming query reads new Parquet files as they land, keeps
weekly windows (Monday start) per group in state, and hands every
micro-batch to ``foreachBatch``, which rewrites the aggregate table, or in
append mode one folder of it for each batch, and a folder of alerts for each
batch.  A batch that is replayed after a restart overwrites its own folder, so
nothing stands twice.  The checkpoint lives under the shared checkpoint folder.

``mode="append"`` with a watermark emits each window once, after it closes,
and lets Spark drop its state (bounded state for an endless stream);
``mode="complete"`` re-emits all windows each batch (batch-equivalent output,
used when a finite stream is drained with ``availableNow``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.numeric import sum_parts, sum_value
from starmart.session import scratch_path

# Weeks start on Monday: the epoch (1970-01-01) is a Thursday, so windows are
# shifted by four days.
WEEK = "7 days"
MONDAY_OFFSET = "4 days"


def weekly_windows(stream: DataFrame, ts: str, group: Sequence[str], value: str,
                   watermark: str = "7 days") -> DataFrame:
    """Streaming aggregate: per week and group, rows and exact value sum.

    Event time must be a TIMESTAMP for the watermark.  A TIMESTAMP_NTZ wall
    clock is turned into the instant with that wall clock in UTC, so weeks
    (Monday 00:00 to Monday 00:00) do not depend on the session time zone.
    """
    if dict(stream.dtypes)[ts] == "timestamp_ntz":
        t = F.col(ts)
        stream = stream.withColumn(ts, F.make_timestamp(
            F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t),
            F.date_part(F.lit("SECOND"), t), F.lit("UTC")))
    return (stream.withWatermark(ts, watermark)
            .groupBy(F.window(ts, WEEK, WEEK, MONDAY_OFFSET).alias("w"), *group)
            .agg(F.count(F.lit(1)).alias("n_rows"), *sum_parts(value, "value")))


def finish(agg: DataFrame, group: Sequence[str]) -> DataFrame:
    # The window start is Monday 00:00 UTC; take its UTC calendar date.
    start_day = F.floor(F.unix_seconds(F.col("w.start")) / F.lit(86400)).cast("int")
    total = sum_value("value_exact", "value_plain", "value_n", "value_fit")
    n = F.nullif("value_n", F.lit(0)).cast("double")  # NULL values don't count
    return agg.select(F.date_from_unix_date(start_day).alias("week_start"), *group, "n_rows",
                      total.alias("value_sum"), (total / n).alias("avg_value"))


def run_weekly_stream(spark: SparkSession, source_dir: str, schema: T.StructType, ts: str,
                      group: Sequence[str], value: str, out_path: str,
                      checkpoint: str | None = None, mode: str = "complete",
                      alert_path: str | None = None, alert_above: float | None = None,
                      available_now: bool = True, max_files_per_trigger: int = 1000):
    """Start (and, with ``available_now``, drain) the weekly stream.

    Returns the finished ``StreamingQuery``.
    """
    checkpoint = checkpoint or scratch_path(spark, "weekly-stream-ckpt")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    agg = weekly_windows(stream, ts, group, value)

    def sink(batch: DataFrame, epoch: int) -> None:
        out = finish(batch, group)
        if mode == "complete":
            out.write.mode("overwrite").parquet(out_path)
        else:
            out.write.mode("overwrite").parquet(f"{out_path}/batch_id={epoch}")
        if alert_path is not None and alert_above is not None:
            alerts = out.where(F.col("avg_value") > F.lit(alert_above))
            # Complete mode gives all windows again, so its alerts replace the last ones.
            at = alert_path if mode == "complete" else f"{alert_path}/batch_id={epoch}"
            alerts.write.mode("overwrite").parquet(at)

    writer = (agg.writeStream.outputMode(mode).foreachBatch(sink)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def forget_last_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """Remove the record that the last batch was done, as after a crash before it was
    written: the next start runs that batch again.  Returns its number."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(conf)
    done = sorted(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit())
    if not done:
        return None
    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{done[-1]}"), False)
    return done[-1]
