"""Single requests: lists for one title or one user, composed from the operators.

``weights`` is a (movieId, term, tfidf) table, worth storing because each request reads it twice;
``movies`` has movieId, title and the metadata columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators import factorize, ratings as rating_ops, recommend, similarity
from tastegrid.session import materialize


def similar_movies(
    movies: DataFrame, weights: DataFrame, title: str, n: int = 10, include_self: bool = False
) -> DataFrame:
    """(movieId, title, similarity): the movies most similar to the first one with this title."""
    target = similarity.target_by_title(movies, title)
    found = similarity.similar_to_target(weights, target, "movieId", n, include_self)
    return movies.select("movieId", "title").join(F.broadcast(found), "movieId")


def hybrid_movies(
    movies: DataFrame, weights: DataFrame, ratings: DataFrame, user_id: int, title: str, n: int = 10
) -> DataFrame:
    """(movieId, title, score): similar movies, half similarity and half the user's mean-centred rating.

    No rows for a user without ratings.
    """
    own = materialize(ratings.filter(F.col("userId") == user_id))  # few rows, read three times: the ratings behind them are made once
    user = own.select("userId", F.lit(0).alias("seed_id")).limit(1)
    near = similar_movies(movies, weights, title, n).withColumn("seed_id", F.lit(0))
    scored = recommend.content_and_ratings(user, near, rating_ops.mean_centered(own), n)
    return movies.select("movieId", "title").join(F.broadcast(scored.select("movieId", "score")), "movieId")


def als_movies(
    model: factorize.AlsFit, movies: DataFrame, user_id: int, n: int = 10, seen: DataFrame | None = None
) -> DataFrame:
    """The user's list with metadata; missing metadata gets its defaults."""
    user = model.userFactors.filter(F.col("id") == user_id).select(F.col("id").alias("userId"))
    return recommend.attach_metadata(factorize.recommend_for(model, user, n, seen), movies, "left")


def svd_movies(svd: factorize.Svd, ratings: DataFrame, user_id: int, n: int = 10) -> DataFrame:
    """The user's best movies of the completed matrix, without those already rated."""
    one = factorize.Svd(svd.users.filter(F.col("id") == user_id), svd.items,
                        svd.means.filter(F.col("userId") == user_id), svd.values)
    return factorize.svd_predictions(one, n, ratings.filter(F.col("userId") == user_id))


def hybrid_lists(
    model: factorize.AlsFit, movies: DataFrame, user_id: int, movie_id: int, n: int = 10
) -> tuple[DataFrame, DataFrame]:
    """The user's collaborative list and the movie's same-genre list."""
    return als_movies(model, movies, user_id, n), recommend.same_genre_as(movies, movie_id, n)


def advanced_movies(
    model: factorize.AlsFit, movies: DataFrame, ratings: DataFrame, user_id: int, as_of: int,
    genre: str | None = None, min_votes: int | None = None, n: int = 10,
) -> DataFrame:
    """The user's list with metadata and time-decayed popularity, optionally of one genre or popularity."""
    user = model.userFactors.filter(F.col("id") == user_id).select(F.col("id").alias("userId"))
    return recommend.advanced(
        factorize.recommend_for(model, user, n), movies, rating_ops.decayed_popularity(ratings, as_of), genre, min_votes)
