"""Structured Streaming forms of the incremental mechanisms.

Each job is a transformation of a streaming DataFrame plus a sink; run it with an
``availableNow`` trigger for a bounded catch-up or continuously otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def table_stream(spark: SparkSession, folder: str, file: str, max_files: int = 1000) -> DataFrame:
    """Stream of the parquet files of one table inside a folder."""
    schema = spark.read.parquet(f"{folder}/{file}").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", file)
        .option("maxFilesPerTrigger", max_files).parquet(folder)
    )


def usage_counts(events: DataFrame, keys: list[str], ts: str = "ts", window: str = "1 day",
                 late: str = "2 days") -> DataFrame:
    """Calls per time window and key; state older than the watermark is dropped."""
    return (
        events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
        .groupBy(F.window(ts, window).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("calls"))
        .select(F.col("w.start").alias("window_start"), *keys, "calls")
    )


def first_seen(occurrences: DataFrame, run: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """First occurrence of every identity of a run; ``run`` is its date or time.

    The identities of a run leave the state once a run that is ``late`` younger was seen; an occurrence of a run that is closed so
    is dropped.  One without a run belongs to none and is dropped too.  Up to there the result equals the batch form.
    """
    timed = occurrences.withColumn(run, F.col(run).cast("timestamp")).filter(F.col(run).isNotNull())
    return timed.withWatermark(run, late).dropDuplicatesWithinWatermark([run, *keys])


def write_batches(path: str, transform: Callable[[DataFrame], DataFrame] | None = None):
    """Idempotent sink: every micro-batch owns one partition and overwrites only that.

    A batch that runs again after a failure replaces its own output, so a resumed stream
    leaves no duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        (
            out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
        )

    return write


def run_available(stream: DataFrame, checkpoint: str, sink, mode: str = "append") -> StreamingQuery:
    """Process everything that is there, then stop; the checkpoint makes it resumable."""
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .foreachBatch(sink).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def latest(spark: SparkSession, path: str, keys: list[str], values: list[str]) -> DataFrame:
    """Newest values of every key from batches that an update-mode stream wrote with :func:`write_batches`."""
    rows = spark.read.parquet(path)
    return rows.groupBy(*keys).agg(*[F.max_by(v, "batch_id").alias(v) for v in values])
