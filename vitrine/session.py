"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE merges small shuffle partitions and splits skewed ones at run time, so the
# partition count only has to be large enough for the largest shuffle of a job.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build(master: str | None = None, app: str = "vitrine", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table that a job uses several times, and read it back.

    The written table also cuts the lineage, so a lost executor never sends the job back
    to the first scan.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session.

    A cluster names that folder in ``spark.checkpoint.dir``.  Only a local session, which has one machine, may do without the
    setting and use its warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
