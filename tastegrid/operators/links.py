"""Movie id links to two other id systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.joins import prefer_first
from tastegrid.operators.ratings import first_per_key


def clean_links(small: DataFrame, full: DataFrame) -> DataFrame:
    """One valid link per movie, the small file's row first, with lengths, flags and a combined id."""
    both = small.withColumn("source", F.lit(0)).unionByName(full.withColumn("source", F.lit(1)))
    one = first_per_key(both.filter(F.col("movieId").isNotNull()), ["movieId"], ["source", "imdbId", "tmdbId"])
    valid = one.withColumn("tmdbId", F.coalesce("tmdbId", F.lit(-1)).cast("bigint")).filter(
        (F.col("imdbId") > 0) & (F.col("tmdbId") >= 0))
    padded = valid.withColumn("imdbId", F.format_string("%07d", "imdbId"))
    return padded.select(
        "movieId", "imdbId", "tmdbId",
        F.length("imdbId").alias("imdbId_length"),
        F.length(F.col("tmdbId").cast("string")).alias("tmdbId_length"),
        F.col("imdbId").isNotNull().cast("int").alias("has_imdbId"),
        (F.col("tmdbId") > 0).cast("int").alias("has_tmdbId"),
        F.concat_ws("_", "imdbId", F.col("tmdbId").cast("string")).alias("combined_id"),
    )


def merge_links(full: DataFrame, small: DataFrame, sentinel: bool = False) -> DataFrame:
    """Both files by (movieId, imdbId), the small file's tmdbId first; rows without one are dropped."""
    return prefer_first(full, small, ["movieId", "imdbId"], "tmdbId", -1 if sentinel else None)
