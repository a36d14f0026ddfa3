"""Decayed popularity as a stored state: sums that are added up, merged and moved to a later date without the old ratings.

A rating's weight is counted towards the end of its epoch, a fixed span of time. The state of an item is one sum per epoch; states of
any parts of the ratings are merged by adding, and the score at a date is every sum decayed from its epoch's end to that
date. Weights within an epoch lie between a fixed fraction and 1, so nothing overflows however long the history is. Epochs
that take no more ratings can be folded into a later one, which keeps a state as short as wanted.

Ratings without a value or a date do not count, as in ``ratings.decayed_popularity``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.functions.scores import decayed

EPOCH = 120 * 86400  # seconds
SUMS = 2**19         # ratings, and so sums at most, that one task is dealt


def end_of(epoch: Column) -> Column:
    return (epoch + 1) * EPOCH


def tasks_for(ratings: DataFrame) -> int:
    """Tasks that keep the sums of one bounded, whatever number of shuffle partitions the session has."""
    return max(ratings.sparkSession.sparkContext.defaultParallelism, math.ceil(ratings.count() / SUMS))


def decay_state(ratings: DataFrame, factor: float = 0.5, item: str = "movieId", at: str = "ts", tasks: int | None = None) -> DataFrame:
    """(item, epoch, mass): the ratings' sums, each as of the end of its epoch.

    Where an item has few ratings an epoch, nearly every rating is a sum of its own: combining before the shuffle gains
    nothing, and the sums of a task grow with the table. With ``tasks`` (see ``tasks_for``) the ratings are dealt to so many
    tasks and added up there; those of one item and epoch meet in one task, as one sum.
    """
    seconds = F.unix_timestamp(at)
    epoch = F.floor(seconds / EPOCH)
    masses = ratings.select(item, epoch.alias("epoch"), decayed(F.col("rating"), seconds, end_of(epoch), factor).alias("mass")).filter(
        "mass is not null")
    return _dealt(masses, tasks, item, "epoch").groupBy(item, "epoch").agg(F.sum("mass").alias("mass"))


def merged(first: DataFrame, *others: DataFrame, item: str = "movieId", tasks: int | None = None) -> DataFrame:
    """One state of several, from any split of the ratings. With ``tasks`` it lies by item, so that folding it moves nothing."""
    for other in others:
        first = first.unionByName(other)
    return _dealt(first, tasks, item).groupBy(item, "epoch").agg(F.sum("mass").alias("mass"))


def _dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    return df if tasks is None else df.repartition(tasks, *keys)


def folded(state: DataFrame, epoch: int, factor: float = 0.5, item: str = "movieId") -> DataFrame:
    """The state with everything before ``epoch`` moved to that epoch's end."""
    to = F.greatest(F.col("epoch"), F.lit(epoch).cast("bigint"))
    moved = state.select(item, to.alias("epoch"), decayed(F.col("mass"), end_of(F.col("epoch")), end_of(to), factor).alias("mass"))
    return moved.groupBy(item, "epoch").agg(F.sum("mass").alias("mass"))


def popularity_at(state: DataFrame, as_of: int, factor: float = 0.5, item: str = "movieId") -> DataFrame:
    """(item, decayed_score) at a date in epoch seconds."""
    now = decayed(F.col("mass"), end_of(F.col("epoch")), as_of, factor)
    return state.groupBy(item).agg(F.sum(now).alias("decayed_score"))
