"""Cleaning, de-duplication, profiles and splits of (user, item, rating) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.functions.scores import decayed
from tastegrid.operators.joins import salted_join


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """One row per key: the one greatest by ``order``.

    An aggregate rather than a window: it combines before the shuffle, so a key with very many
    copies never meets in one task. ``order`` should be total within a key.
    """
    picked = F.max(F.struct(*order, *values)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[f"_row.{c}" for c in [*values, *order]])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one smallest by ``order`` (nulls first), as an aggregate."""
    picked = F.min(F.struct(*order, *values)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[f"_row.{c}" for c in [*order, *values]])


def merge_sources(small: DataFrame, full: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both files by column name, identical rows once."""
    return small.select(*columns).unionByName(full.select(*columns)).dropDuplicates()


def clean_ratings(df: DataFrame, low: float = 0.0, high: float = 5.0) -> DataFrame:
    """Rows without nulls and on the rating scale, with the date instead of the epoch seconds."""
    return (
        df.na.drop()
        .withColumn("rating_date", F.timestamp_seconds("timestamp").cast("date"))
        .drop("timestamp")
        .withColumns({c: F.col(c).cast(t) for c, t in
                      (("userId", "bigint"), ("movieId", "bigint"), ("rating", "double"))})
        .filter(F.col("rating").between(low, high))
    )


def profile(df: DataFrame, key: str, prefix: str, value: str = "rating") -> DataFrame:
    """Mean and count of the ratings per ``key`` in one aggregate."""
    return df.groupBy(key).agg(
        F.avg(value).alias(f"{prefix}_avg_rating"), F.count(value).alias(f"{prefix}_rating_count"))


def with_profiles(df: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Every rating with the profile of its user and of its item."""
    by_user = salted_join(df, profile(df, user, "user"), [user], "left", spread_by=[item])
    return salted_join(by_user, profile(df, item, "movie"), [item], "left", spread_by=[user])


def mean_centered(df: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """``rating_norm``: the rating less its user's mean."""
    means = df.groupBy(user).agg(F.avg("rating").alias("user_avg_rating"))
    return salted_join(df, means, [user], "inner", spread_by=[item]).withColumn(
        "rating_norm", F.col("rating") - F.col("user_avg_rating"))


def pair_means(df: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """One mean rating per (user, item)."""
    return df.groupBy(user, item).agg(F.avg("rating").alias("rating"))


def time_decayed(df: DataFrame, as_of: int, factor: float = 0.5, at: str = "ts") -> DataFrame:
    return df.withColumn("weighted_rating", decayed(F.col("rating"), F.unix_timestamp(at), as_of, factor))


def decayed_popularity(df: DataFrame, as_of: int, factor: float = 0.5, item: str = "movieId") -> DataFrame:
    """Sum of the decayed ratings per item."""
    return time_decayed(df, as_of, factor).groupBy(item).agg(F.sum("weighted_rating").alias("decayed_score"))


def random_split(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([train_share, 1 - train_share], seed=seed)
    return train, test


def key_split(df: DataFrame, user: str = "userId", item: str = "movieId", train_tenths: int = 8) -> DataFrame:
    """Label every row ``train`` or ``test`` by its key, the same on every run and cluster."""
    bucket = F.pmod(F.col(user).cast("bigint") * 31 + F.col(item).cast("bigint") * 17, F.lit(10))
    return df.withColumn("split", F.when(bucket < train_tenths, "train").otherwise("test"))


def holdout_last(df: DataFrame, n: int, order: Sequence[str], user: str = "userId", item: str = "movieId") -> DataFrame:
    """Label the ``n`` latest rows of every user ``test`` and all older ones ``train``.

    The ranking keeps ``n`` rows per user before the shuffle; the label comes back over the
    (user, item) key, which no user dominates. Needs one row per (user, item).
    """
    recent = Window.partitionBy(user).orderBy(*[F.desc(c) for c in order])
    held = df.select(user, item, *order).withColumn("_n", F.row_number().over(recent)).filter(F.col("_n") <= n)
    return df.join(held.select(user, item, F.lit("test").alias("split")), [user, item], "left").fillna(
        {"split": "train"})
