"""Aggregates behind recommendation reports."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.joins import salted_join
from tastegrid.operators.ranking import global_positions
from tastegrid.session import materialize

TILE, USERS = 512, 4096  # items and users of one side of a correlation cell
CELLS = 2**18            # filled cells of the user x item matrix that one task makes into tiles, at some 500 bytes a tile


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_null, n_distinct) of every column, read once.

    Values are counted per (column, value) first, so neither a frequent value nor a column is
    brought into one task. A long text is represented by its digest.
    """
    def key(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.when(F.length(value) > 64, F.md5(value)).otherwise(value).alias(name)

    values = df.select(*[key(c) for c in df.columns]).unpivot(
        [], list(df.columns), "column_name", "value").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"))


def rating_distribution(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("n")).orderBy("rating")


def rec_counts(recs: DataFrame, item: str = "movieId") -> DataFrame:
    """Recommendations per item: the small table every report below starts from."""
    return recs.groupBy(item).agg(F.count(F.lit(1)).alias("n_recs"))


def top_recommended(recs: DataFrame, titles: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most recommended items, with titles; items without one are dropped afterwards."""
    top = rec_counts(recs).orderBy(F.desc("n_recs"), "movieId").limit(n)
    return titles.select("movieId", "title").filter(F.col("title").isNotNull()).join(F.broadcast(top), "movieId")


def genre_popularity(recs: DataFrame, genres: DataFrame) -> DataFrame:
    """Recommendations per genre; genres never recommended count 0, items without one are ``Unknown``."""
    joined = rec_counts(recs).join(genres.select("movieId", "genre_name"), "movieId", "full")
    return joined.groupBy(F.coalesce("genre_name", F.lit("Unknown")).alias("genre_name")).agg(
        F.coalesce(F.sum("n_recs"), F.lit(0)).alias("n_recs"))


def genre_diversity(recs: DataFrame, genres: DataFrame) -> DataFrame:
    """Distinct genres in every user's recommendations.

    Popular items stand in most lists, so their rows are spread by user.
    """
    joined = salted_join(recs.select("userId", "movieId"), genres.select("movieId", "genre_name"), ["movieId"], "left",
                         spread_by=["userId"])
    return joined.groupBy("userId").agg(
        F.count_distinct(F.coalesce("genre_name", F.lit("Unknown"))).alias("genre_diversity"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, n): equal-width bins between the column's extremes, the upper edge in the last bin.

    Rows are counted per value first and the counts are stored: ``df`` is computed once for edges and bins.
    """
    counts = materialize(df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n")))
    edges = counts.agg(F.struct(
        F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"))).scalar()
    low, high = F.col("_edges.low"), F.col("_edges.high")
    place = F.floor((F.col(column) - low) * bins / F.nullif(high - low, F.lit(0.0))) + 1
    return counts.withColumn("_edges", edges).groupBy(
        F.least(F.coalesce(place, F.lit(1)), F.lit(bins)).cast("bigint").alias("bin")).agg(F.sum("_n").alias("n"))


def recommended_avg_rating(recs: DataFrame, ratings: DataFrame) -> DataFrame:
    """Mean rating of every recommended item; ratings are averaged before the join."""
    means = ratings.groupBy("movieId").agg(F.avg("rating").alias("avg_rating"))
    return means.join(rec_counts(recs), "movieId", "left_semi")


def popular_vs_unpopular(recs: DataFrame, movies: DataFrame, threshold: int = 100) -> DataFrame:
    """Recommendations of items above and up to a vote count; items without one count in neither."""
    joined = rec_counts(recs).join(movies.select("movieId", "vote_count"), "movieId")
    popular = F.col("vote_count") > threshold
    return joined.agg(
        F.coalesce(F.sum(F.when(popular, F.col("n_recs"))), F.lit(0)).alias("popular_recs"),
        F.coalesce(F.sum(F.when(~popular, F.col("n_recs"))), F.lit(0)).alias("unpopular_recs"))


def matrix_tiles(means: DataFrame, width: int = 50, user: str = "userId", item: str = "movieId") -> DataFrame:
    """The user x item matrix in tiles of ``width`` item columns, missing cells 0.

    Row (user, tile) holds items ``tile * width`` to ``tile * width + width - 1`` in columns
    ``c0``..; tiles in which a user rated nothing are all 0 and left out. The matrix keeps a fixed
    number of columns however many items there are, and one row of a heavy user is a tile, not all
    their ratings. ``means`` holds one value per (user, item).

    Nearly every value is a tile of its own, so combining before the shuffle would hold wide rows for nothing: the narrow
    values are stored, and dealt to as many tasks as keep a task's tiles bounded.
    """
    tile = F.floor(F.col(item) / width).cast("bigint")
    placed = materialize(means.select(user, tile.alias("tile"), F.pmod(F.col(item), F.lit(width)).alias("_c"), "rating"))
    tasks = max(means.sparkSession.sparkContext.defaultParallelism, math.ceil(placed.count() / CELLS))
    placed = placed.repartition(tasks, user, "tile")
    cells = [F.sum(F.when(F.col("_c") == c, F.col("rating")).otherwise(0.0)).alias(f"c{c}") for c in range(width)]
    return placed.groupBy(user, "tile").agg(*cells)


def most_rated(ratings: DataFrame, n: int, item: str = "movieId") -> DataFrame:
    """The ``n`` items with most ratings (ties by id): the axes of a readable heat map."""
    return ratings.groupBy(item).agg(F.count(F.lit(1)).alias("n_ratings")).orderBy(F.desc("n_ratings"), item).limit(n)


def item_correlation(ratings: DataFrame, items: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Pearson correlation of every two of ``items`` over all users, unrated cells counting as 0.

    Items are numbered and cut into tiles; a cell takes two tiles and a bucket of users and multiplies two
    matrices of bounded size, so neither an item that everybody rated nor a user who rated every item is
    more than a column or row of many cells. The result has one row per pair of ``items``: choose them, for
    instance by ``most_rated(ratings, 100)``. Items rated alike by all users have no correlation and give
    null. Needs one rating per (user, item).
    """
    placed = global_positions(items.select(item).distinct(), [F.asc(item)], "_at").select(item, (F.col("_at") - 1).alias("_at"))
    size = placed.count()
    n_users = ratings.agg(F.count_distinct(user)).first()[0]
    tiles, buckets = max(1, math.ceil(size / TILE)), max(1, math.ceil(n_users / USERS))
    chosen = materialize(ratings.select(F.col(user).alias("_user"), item, "rating").join(placed, item))
    rows = chosen.withColumn("_tile", F.floor(F.col("_at") / TILE)).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).select(
        F.least("_tile", "_other").alias("p"), F.greatest("_tile", "_other").alias("q"),
        F.pmod(F.xxhash64("_user"), F.lit(buckets)).alias("bucket"), "_user", "_tile", "_at", "rating")
    tile = TILE

    def products(cell: pa.Table) -> pa.Table:
        p, q = cell["p"][0].as_py(), cell["q"][0].as_py()
        users, row = np.unique(cell["_user"].to_numpy(), return_inverse=True)
        own, at, x = (cell[c].to_numpy() for c in ("_tile", "_at", "rating"))

        def side(number):
            inside = own == number
            width = min(tile, size - number * tile)
            values, known = np.zeros((len(users), width)), np.zeros((len(users), width), np.float32)
            values[row[inside], at[inside] - number * tile] = x[inside]
            known[row[inside], at[inside] - number * tile] = 1
            return values, known

        (left, left_known), (right, right_known) = side(p), side(q)
        a, b = np.indices((left.shape[1], right.shape[1]))
        keep = (a + p * tile <= b + q * tile)
        total, common = left.T @ right, left_known.T @ right_known
        return pa.table({"a": a[keep] + p * tile, "b": b[keep] + q * tile, "sxy": total[keep],
                         "n_common": common[keep].astype("int64")})

    cells = rows.groupBy("p", "q", "bucket").applyInArrow(
        products, "a bigint, b bigint, sxy double, n_common bigint").groupBy("a", "b").agg(
        F.sum("sxy").alias("sxy"), F.sum("n_common").alias("n_common"))
    sums = chosen.groupBy("_at").agg(
        F.sum("rating").alias("s"), F.first(item).alias("id"))
    squares = cells.filter("a = b").select(F.col("a").alias("_at"), F.col("sxy").alias("ss"))
    stats = sums.join(squares, "_at")
    left = stats.select(F.col("_at").alias("a"), F.col("id").alias("movie_a"), F.col("s").alias("sa"),
                        F.col("ss").alias("ssa"))
    right = stats.select(F.col("_at").alias("b"), F.col("id").alias("movie_b"), F.col("s").alias("sb"),
                         F.col("ss").alias("ssb"))
    n = F.col("n")
    spread = F.sqrt(F.greatest(n * F.col("ssa") - F.col("sa") ** 2, F.lit(0.0))) * F.sqrt(
        F.greatest(n * F.col("ssb") - F.col("sb") ** 2, F.lit(0.0)))
    return (
        cells.filter("a < b").join(left, "a").join(right, "b").withColumn("n", F.lit(n_users))
        .select("movie_a", "movie_b", "n_common",
                ((n * F.col("sxy") - F.col("sa") * F.col("sb")) / F.nullif(spread, F.lit(0.0))).alias("correlation"))
    )
