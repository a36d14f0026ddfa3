"""Session settings the operators rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; every one can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# A table's static size is that of its files, in which a row of sorted ids takes two or three bytes. In the driver's memory a
# broadcast row takes a hundred, and a salted join repeats it: without this factor a file just below the limit for broadcasts
# fills a driver of 1 GB. Sizes that adaptive execution measures are of rows in memory and stay as they are.
TABLE_CONF = {"spark.sql.sources.fileCompressionFactor": "10"}


def build_session(app_name: str = "tastegrid", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **TABLE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession, *more: dict[str, str]) -> SparkSession:
    """Apply the runtime settings, and ``more`` of them, to a session somebody else built."""
    for key, value in {k: v for conf in (RUNTIME_CONF, *more) for k, v in conf.items()}.items():
        spark.conf.set(key, value)
    return spark


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it from there, for a table that several passes use."""
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session: the one named by ``spark.checkpoint.dir``, which every executor must reach.

    A session without that setting keeps such files beside its warehouse tables, which are shared as well.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    context.setCheckpointDir(shared)
    return context._jsc.sc().getCheckpointDir().get()
