"""Global and per-group ranking, and the most-popular-unseen recommender."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.operators.joins import salted_join
from tastegrid.session import materialize

# Positions per block in the two-level count of seen items; also the largest window group there.
BLOCK = 65536


def top_n(df: DataFrame, n: int, by: Sequence[str], order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per group under a total order, with their rank.

    Written as row_number <= n, which Spark also applies before the shuffle, so a large group
    sends ``n`` rows per task.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def global_positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Number all rows from 1 in a total ``order`` without bringing them into one partition.

    Rows are range-partitioned and sorted; a row's number is its place in its partition plus the
    size of the partitions before it. The ranged rows are checkpointed because their sizes and
    their places are read in two passes that must agree even if a task is recomputed.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(),
                      # The low 33 bits count the rows of the partition.
                      "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part").withColumn(
        name, F.col("_place") + F.col("_offset") + 1).drop("_part", "_place", "_offset")


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    """One row with one array: for every share the smallest value up to which at least that share of the rows lies.

    Exact at every size: rows are counted per value, and the counts are summed along sorted ranges of values, so
    no task holds more than one range. Nulls do not count; without values the array holds nulls.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    placed = materialize(counts.repartitionByRange(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_value").withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.sum("_n").alias("_size"))  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    up_to = F.sum("_n").over(Window.partitionBy("_part").orderBy("_value")) + F.col("_offset")
    summed = placed.join(F.broadcast(offsets), "_part").withColumn("_up_to", up_to).withColumn(
        "_all", placed.agg(F.sum("_n")).scalar())
    return summed.agg(F.array(*[
        F.min(F.when(F.col("_up_to") >= F.ceil(F.col("_all") * share), F.col("_value"))) for share in shares]).alias("quantiles"))


def popularity_order(ratings: DataFrame, item: str = "movieId") -> DataFrame:
    """(item, score, position): items by number of ratings, ties by id."""
    counts = ratings.groupBy(item).agg(F.count(F.lit(1)).alias("score"))
    return global_positions(counts, [F.desc("score"), F.asc(item)])


def most_popular_unseen(
    ratings: DataFrame, k: int, user: str = "userId", item: str = "movieId", block: int = BLOCK
) -> DataFrame:
    """(user, rank, item, score): for every user the ``k`` most rated items they have not rated.

    Works on the positions of the seen items instead of pairing users with items. If a user has
    seen c items ahead of their t-th unseen one, that one stands at position t + c; and a seen item
    at position p with s seen ones up to and including it has p - s unseen ones ahead, so c counts
    the seen items with p - s < t. ``s`` is counted in two levels, so the rows of a user who has
    rated very many items are ranked in groups of at most ``block``. Needs one row per (user, item).
    """
    ranked = popularity_order(ratings, item)
    seen = salted_join(
        ratings.select(user, item), ranked.select(item, "position"), [item], "inner", spread_by=[user]
    ).select(user, "position", F.floor((F.col("position") - 1) / block).alias("_block"))

    # Unseen items before each block; blocks that start after the k-th cannot matter.
    earlier = Window.partitionBy(user).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        seen.groupBy(user, "_block").agg(F.count(F.lit(1)).alias("_n"))
        .select(user, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_seen_before"))
        .filter(F.col("_block") * block - F.col("_seen_before") < k)
    )
    within = F.row_number().over(Window.partitionBy(user, "_block").orderBy("position"))
    ahead = seen.join(blocks, [user, "_block"]).select(
        user, (F.col("position") - F.col("_seen_before") - within).alias("_unseen_ahead"))
    shifts = ahead.filter(F.col("_unseen_ahead") < k).groupBy(
        user, (F.col("_unseen_ahead") + 1).cast("int").alias("rank")).agg(F.count(F.lit(1)).alias("_shift"))

    slots = ratings.select(user).distinct().select(
        user, F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"), F.lit(0).cast("bigint").alias("_shift"))
    up_to = Window.partitionBy(user).orderBy("rank")
    wanted = slots.unionByName(shifts).groupBy(user, "rank").agg(F.sum("_shift").alias("_shift")).select(
        user, "rank", (F.col("rank") + F.sum("_shift").over(up_to)).alias("position"))
    return salted_join(wanted, ranked, ["position"], "inner", spread_by=[user]).select(user, "rank", item, "score")
