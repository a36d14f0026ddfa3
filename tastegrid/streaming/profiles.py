"""Rating profiles kept up to date over a stream of events.

Counts and sums per key and tumbling window live in the state store. Every micro-batch writes the groups it changed into a
folder of its own, so a batch that is repeated after a failure replaces what it wrote before; readers take the newest
state of a group. The watermark bounds the state: a window is forgotten once it ended ``delay`` before the newest event
of the earlier batches, and rows that come later than that are not counted (``late_rows`` tells them apart in a batch
table). Choose ``delay`` from how late the source really is.

Rows without a time belong to no window. A null key is a key, null values count as events only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tastegrid.sources.files import replace_partitions

STATE = ["n_events", "n_values", "total"]


def parquet_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """The Parquet files below a folder (or matching a pattern) as a stream of micro-batches, oldest file first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def window_states(events: DataFrame, key: str, value: str, at: str, width: str, delay: str) -> DataFrame:
    """(window_start, key, n_events, n_values, total): sums that grow as events come in; the same for a batch table."""
    timed = events.filter(F.col(at).isNotNull()).withWatermark(at, delay)
    grouped = timed.groupBy(F.window(at, width).alias("_window"), key).agg(
        F.count(F.lit(1)).alias("n_events"), F.count(value).alias("n_values"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("total"))
    return grouped.select(F.col("_window.start").alias("window_start"), key, *STATE)


def maintain(states: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the changed groups of every micro-batch below ``path``; ``checkpoint`` holds the offsets and the state.

    Without ``every`` (an interval) the query takes in all that is there now, in as many batches as the source
    cuts, and ends; started again with the same folders it goes on where it ended.
    """
    def store(batch: DataFrame, number: int) -> None:
        replace_partitions(batch.withColumn("batch", F.lit(number).cast("bigint")), path, ["batch"])

    writer = states.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def current(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """(window_start, keys, n_events, n_values, mean) of every window so far, from its newest state."""
    newest = F.max(F.struct("batch", *STATE)).alias("_s")
    return spark.read.parquet(path).groupBy("window_start", *keys).agg(newest).select(
        "window_start", *keys, "_s.n_events", "_s.n_values",
        (F.col("_s.total") / F.nullif(F.col("_s.n_values"), F.lit(0))).alias("mean"))


def late_rows(events: DataFrame, newest, at: str, width: str, delay: str) -> DataFrame:
    """The rows of a batch table that a stream whose earlier batches reached ``newest`` (a timestamp) would leave out."""
    bound = F.lit(newest).cast("timestamp") - F.expr(f"interval {delay}")
    return events.withColumn("_window", F.window(at, width)).filter(F.col("_window.end") <= bound).select(*events.columns)
