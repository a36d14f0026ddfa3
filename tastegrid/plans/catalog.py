"""Named queries over one data folder; each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.functions import scrub
from tastegrid.operators import (
    analytics, blocks, credits, decay, evaluate, factorize, joins, keywords, links, lsh, movies, pairs, ranking, ratings, recommend,
    similarity, sketches, text,
)
from tastegrid.plans import requests
from tastegrid.session import TABLE_CONF, configure, materialize, shared_path
from tastegrid.sources import files
from tastegrid.sources.star_schema import MovieTables
from tastegrid.streaming import profiles

AS_OF = 1009843200       # 2002-01-01 UTC, after the last rating
K = 10                   # length of a recommendation list
KS = (1, 5, 10, 20, 50)  # cut-offs of the metric curve
HELD_OUT = 5             # latest ratings per user that are held out
LIKED = 3.0              # a held-out rating from here on is relevant
TARGET_TITLE = "small ring"
USER = 1
GENRE = "ECONOMY"
MIN_VOTES = 30
SIMILAR = 0.8            # least cosine of a pair of similar documents
HEAT_MAP = 100           # items on the axes of the correlation heat map
ORDER = ["ts", "ok", "ln"]
RATINGS_FILE = "userId BIGINT, movieId BIGINT, rating DOUBLE, timestamp BIGINT, ok BIGINT, ln INT"
EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def r6(column: str | Column) -> Column:
    return F.round(column, 6)


class Domain(MovieTables):
    """Derived tables shared by several queries."""

    @cached_property
    def movies(self) -> DataFrame:
        """(movieId, title, vote_count, vote_average, release_year, genre_id, genre_name): first genre only."""
        return movies.first_genre(self.movies_rated).select(
            F.col("id").alias("movieId"), "title", "vote_count", "vote_average",
            F.year("release_date").alias("release_year"), "genre_id", "genre_name")

    @cached_property
    def movie_genres(self) -> DataFrame:
        return movies.genre_rows(self.movie_parts).withColumnRenamed("id", "movieId")

    @cached_property
    def labelled_movies(self) -> DataFrame:
        """Movie columns of an enriched row, with the frequency index of the genre."""
        index = text.label_index(self.movies, "genre_name", "genres_indexed").drop("label_count")
        return joins.salted_join(self.movies, index, ["genre_name"], "left", spread_by=["movieId"]).select(
            "movieId", "title", "genre_id", "genre_name", "release_year",
            F.col("genres_indexed").cast("int").alias("genres_indexed"))

    @cached_property
    def recs(self) -> DataFrame:
        return ranking.most_popular_unseen(self.stored_ratings, K)

    @cached_property
    def split(self) -> DataFrame:
        return ratings.holdout_last(self.stored_ratings, HELD_OUT, ORDER)

    @cached_property
    def stored_split(self) -> DataFrame:
        return materialize(self.split.select("userId", "movieId", "rating", "split"))

    @cached_property
    def truth(self) -> DataFrame:
        return self.stored_split.filter((F.col("split") == "test") & (F.col("rating") >= LIKED)).select("userId", "movieId")

    @cached_property
    def trained_recs(self) -> DataFrame:
        """Lists of up to max(KS) from the training part of the split."""
        return ranking.most_popular_unseen(self.stored_split.filter(F.col("split") == "train"), max(KS))

    @cached_property
    def cast(self) -> DataFrame:
        return credits.cast_rows(self.cast_credits)

    @cached_property
    def crew(self) -> DataFrame:
        return credits.crew_rows(self.crew_credits)

    @cached_property
    def keyword_rows(self) -> DataFrame:
        return keywords.keyword_rows(self.keywords_raw)

    @cached_property
    def movie_text(self) -> DataFrame:
        named = movies.first_genre(self.movies_described)
        return movies.combined_text(
            named, credits.cast_features(self.cast), keywords.keyword_lists(self.keywords_raw))

    @cached_property
    def stored_movie_text(self) -> DataFrame:
        """The movies' texts written once: features are fitted and applied in separate passes."""
        return materialize(self.movie_text)

    @cached_property
    def document_weights(self) -> DataFrame:
        """(doc_id, term, tfidf). The texts are dealt by document before they are cut: their tokens then need no shuffle to be counted."""
        return text.tfidf(self.documents.repartition("doc_id"), "doc_id", "text")

    def nearest_documents(self, wanted: DataFrame | None = None) -> DataFrame:
        return similarity.nearest_documents(self.documents, "doc_id", "text", K, wanted=wanted)

    @cached_property
    def als_ratings(self) -> DataFrame:
        return self.stored_ratings.select("userId", "movieId", "rating")


QUERIES: dict[str, Callable[[Domain], DataFrame]] = {}


def query(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, folder: build(Domain(configure(spark, TABLE_CONF), folder))

    return {name: bind(build) for name, build in QUERIES.items()}


# --- Sources and cleaning -------------------------------------------------------------------------


@query
def profile_nulls(d: Domain) -> DataFrame:
    return analytics.column_profile(d.movies_raw)


@query
def clean_numeric(d: Domain) -> DataFrame:
    return movies.scrub_numbers(d.movies_rated).select("id", "budget", "popularity", "vote_count", "vote_average")


@query
def movies_clean(d: Domain) -> DataFrame:
    return movies.clean_movies(d.movies_raw).select(
        "id", "imdb_id", "title", "budget", "revenue", "runtime", "popularity", "vote_count", "vote_average",
        "status", "original_language", "adult", "video", "release_date", "release_year", "tagline", "overview")


@query
def ratings_clean(d: Domain) -> DataFrame:
    return ratings.clean_ratings(d.ratings_dirty).select("userId", "movieId", "rating", "rating_date", "ok", "ln")


@query
def ratings_accepted(d: Domain) -> DataFrame:
    """The rows of a dirty ratings file that parse."""
    return files.read_checked(d.spark, d.ratings_file, RATINGS_FILE)[0]


@query
def ratings_quarantine(d: Domain) -> DataFrame:
    """The rows of the same file that do not, with the columns at fault."""
    return files.read_checked(d.spark, d.ratings_file, RATINGS_FILE)[1]


@query
def unparsed_lists(d: Domain) -> DataFrame:
    """Every nested list whose text does not parse."""
    types = {"genres": scrub.GENRE_TYPE, "production_companies": scrub.COMPANY_TYPE, "production_countries": scrub.COUNTRY_TYPE}
    return movies.list_faults(d.movie_lists_cut, types)


@query
def ratings_union(d: Domain) -> DataFrame:
    return ratings.merge_sources(d.ratings_small, d.ratings_full, ["userId", "movieId", "rating", "timestamp"])


@query
def ratings_dedup(d: Domain) -> DataFrame:
    return d.ratings.select("userId", "movieId", "rating", F.unix_timestamp("ts").alias("timestamp"), "ok", "ln")


@query
def rating_dates(d: Domain) -> DataFrame:
    return d.ratings.select("userId", "movieId", F.to_date("ts").alias("rating_date"),
                            F.unix_timestamp("ts").alias("timestamp"))


@query
def links_clean(d: Domain) -> DataFrame:
    return links.clean_links(d.links_small, d.links_full)


@query
def links_outer_merge(d: Domain) -> DataFrame:
    return links.merge_links(d.links_full, d.links_small)


@query
def links_outer_merge_sentinel(d: Domain) -> DataFrame:
    return links.merge_links(d.links_full, d.links_small, sentinel=True)


@query
def keyword_rows(d: Domain) -> DataFrame:
    return d.keyword_rows


@query
def keyword_rows_literal(d: Domain) -> DataFrame:
    return keywords.keyword_rows(d.keywords_raw, strip_brackets=False)


@query
def keyword_lists(d: Domain) -> DataFrame:
    return keywords.keyword_lists(d.keywords_raw)


# --- Movie features -------------------------------------------------------------------------------


@query
def genre_rows(d: Domain) -> DataFrame:
    return movies.genre_rows(d.movie_parts)


@query
def company_rows(d: Domain) -> DataFrame:
    return movies.company_rows(d.movie_parts)


@query
def country_rows(d: Domain) -> DataFrame:
    return movies.country_rows(d.movie_parts)


@query
def language_rows(d: Domain) -> DataFrame:
    return movies.language_rows(d.movies_described)


@query
def genre_multihot(d: Domain) -> DataFrame:
    return movies.genre_columns(d.movie_parts)


@query
def log_features(d: Domain) -> DataFrame:
    return movies.log_features(movies.clean_movies(d.movies_raw)).select(
        "id", r6("log_budget").alias("log_budget"), r6("log_revenue").alias("log_revenue"))


@query
def popularity_bins(d: Domain) -> DataFrame:
    numbers = d.movie_parts.select("id", scrub.decimal_number("popularity").alias("popularity"))
    return movies.popularity_tiers(numbers)


@query
def text_lengths(d: Domain) -> DataFrame:
    return movies.text_lengths(movies.clean_movies(d.movies_raw)).select("id", "overview_length", "tagline_length")


@query
def release_features(d: Domain) -> DataFrame:
    return movies.release_features(d.movies_rated).select("id", "release_year", "release_decade")


@query
def weighted_rating(d: Domain) -> DataFrame:
    votes = materialize(d.movies_rated.select("id", "vote_count", "vote_average"))  # averaged and weighed
    return movies.weighted_ratings(votes).select("id", r6("weighted_rating").alias("weighted_rating"))


@query
def cast_rows(d: Domain) -> DataFrame:
    return d.cast.select("movie_id", "cast_name", "character", "cast_gender", "cast_order")


@query
def crew_rows(d: Domain) -> DataFrame:
    return d.crew.select("movie_id", "crew_name", "job", "department", "crew_gender")


@query
def cast_features(d: Domain) -> DataFrame:
    return credits.cast_features(d.cast)


@query
def crew_features(d: Domain) -> DataFrame:
    return credits.crew_features(d.crew)


@query
def top5_cast(d: Domain) -> DataFrame:
    return credits.leading_cast(d.cast, 5).select("movie_id", F.concat_ws("|", "cast_names").alias("cast_names"))


@query
def director_per_movie(d: Domain) -> DataFrame:
    return credits.director_features(d.cast, d.crew_credits).select("movie_id", "lead_actor", "director")


@query
def movies_enriched(d: Domain) -> DataFrame:
    base = movies.first_genre(d.movie_parts).select("id", "title", "genre_name")
    return movies.with_credits(base, credits.cast_features(d.cast), credits.crew_features(d.crew),
                               keywords.keyword_lists(d.keywords_raw))


@query
def combined_text(d: Domain) -> DataFrame:
    return d.movie_text


# --- Rating profiles ------------------------------------------------------------------------------


@query
def user_profile(d: Domain) -> DataFrame:
    return ratings.profile(d.ratings, "userId", "user").withColumn("user_avg_rating", r6("user_avg_rating"))


@query
def event_profiles_stream(d: Domain) -> DataFrame:
    """Events and mean value per user and day, kept by a stream over the events until it has taken in all of them.

    The order of the files of a table says nothing about their times, so the delay is longer than any table's span.
    """
    stream = profiles.parquet_stream(d.spark, f"{d.base}/events.parquet*", EVENTS)
    states = profiles.window_states(stream, "user_id", "value", "ts", "1 day", "36500 days")
    path = shared_path(d.spark, "profiles")
    profiles.maintain(states, path, shared_path(d.spark, "stream")).awaitTermination()
    return profiles.current(d.spark, path, ["user_id"]).select(
        F.to_date("window_start").alias("day"), "user_id", "n_events", "n_values", r6("mean").alias("mean_value"))


@query
def movie_profile(d: Domain) -> DataFrame:
    return ratings.profile(d.ratings, "movieId", "movie").withColumn("movie_avg_rating", r6("movie_avg_rating"))


@query
def ratings_enriched(d: Domain) -> DataFrame:
    return ratings.with_profiles(d.stored_ratings).select(
        "userId", "movieId", "rating", F.to_date("ts").alias("rating_date"),
        r6("user_avg_rating").alias("user_avg_rating"), "user_rating_count",
        r6("movie_avg_rating").alias("movie_avg_rating"), "movie_rating_count")


@query
def mean_centered(d: Domain) -> DataFrame:
    return ratings.mean_centered(d.stored_ratings).select(
        "userId", "movieId", r6("user_avg_rating").alias("user_avg_rating"), r6("rating_norm").alias("rating_norm"))


@query
def user_item_mean(d: Domain) -> DataFrame:
    return ratings.pair_means(d.ratings_raw).withColumn("rating", r6("rating"))


@query
def time_decay(d: Domain) -> DataFrame:
    return ratings.time_decayed(d.ratings, AS_OF).select(
        "userId", "movieId", F.round("weighted_rating", 9).alias("weighted_rating"))


@query
def decayed_popularity(d: Domain) -> DataFrame:
    return ratings.decayed_popularity(d.ratings, AS_OF).select(
        "movieId", r6("decayed_score").alias("decayed_score"))


@query
def decayed_popularity_merged(d: Domain) -> DataFrame:
    """The same scores from stored sums: those of two parts of the ratings merged, old epochs folded."""
    rows = d.stored_ratings
    tasks = decay.tasks_for(rows)
    states = [decay.decay_state(rows.filter(F.pmod(F.xxhash64("userId"), F.lit(2)) == half), tasks=tasks) for half in (0, 1)]
    state = materialize(decay.folded(decay.merged(*states, tasks=tasks), AS_OF // decay.EPOCH - 4))
    return decay.popularity_at(state, AS_OF).select("movieId", r6("decayed_score").alias("decayed_score"))


@query
def missing_movie_ids(d: Domain) -> DataFrame:
    described = d.documents.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("bigint").alias("movieId"))
    return joins.unknown_ids(d.ratings, described, "movieId")


@query
def enriched_ratings(d: Domain) -> DataFrame:
    return recommend.attach_metadata(d.als_ratings, d.labelled_movies, "left").select(
        "userId", "movieId", "rating", *recommend.MISSING)


@query
def key_split(d: Domain) -> DataFrame:
    return ratings.key_split(d.ratings.select("userId", "movieId", "rating"))


@query
def holdout_last_n(d: Domain) -> DataFrame:
    return d.split.select("userId", "movieId", "rating", "split")


# --- Text -----------------------------------------------------------------------------------------


@query
def token_counts(d: Domain) -> DataFrame:
    return text.token_counts(d.documents, "doc_id", "text")


@query
def tfidf_weights(d: Domain) -> DataFrame:
    return d.document_weights.select("doc_id", "term", r6("tfidf").alias("tfidf"))


@query
def keyword_multihot(d: Domain) -> DataFrame:
    return keywords.multi_hot(d.keyword_rows)


@query
def keyword_tfidf(d: Domain) -> DataFrame:
    return keywords.keyword_tfidf(d.keyword_rows).select("movie_id", "keyword_name", r6("tfidf").alias("tfidf"))


@query
def string_index(d: Domain) -> DataFrame:
    return text.label_index(d.movie_genres, "genre_name", "genre_index")


@query
def hashed_tfidf(d: Domain) -> DataFrame:
    hashed = text.hashed_tfidf(d.documents, "text")
    return text.sparse_entries(hashed, "doc_id", "features").select(
        "doc_id", F.inline(F.arrays_zip("terms", "weights"))).select(
        "doc_id", F.col("terms").alias("bucket"), r6("weights").alias("weight"))


@query
def keyword_vectors(d: Domain) -> DataFrame:
    return keywords.keyword_vectors(keywords.keyword_list_rows(d.keywords_raw)).select(
        "movie_id", F.size("terms").alias("n_keywords"),
        r6(F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)).alias("total_weight"))


# --- Similarity -----------------------------------------------------------------------------------


@query
def cosine_to_target(d: Domain) -> DataFrame:
    target = similarity.target_by_title(d.movie_parts.withColumnRenamed("id", "movieId"), TARGET_TITLE)
    return similarity.similar_to_text(d.movie_text, target, "movieId", "combined_features", K, listed=d.movie_parts)


@query
def knn_topk(d: Domain) -> DataFrame:
    return d.nearest_documents().select(
        F.col("query_id").alias("doc_id"), "rank", F.col("item_id").alias("neighbor_id"), "similarity")


@query
def knn_dense_topk(d: Domain) -> DataFrame:
    vectors = d.embeddings
    return similarity.nearest_vectors(vectors, "vec_id", "embedding", K, vectors.count()).select(
        F.col("query_id").alias("vec_id"), "rank", F.col("item_id").alias("neighbor_id"), "similarity")


def searched(column: str) -> Column:
    """The rows that the approximate searches ask about, against all rows."""
    return F.col(column) % 20 == 0


@query
def knn_lsh(d: Domain) -> DataFrame:
    vectors = materialize(similarity.term_vectors(d.document_weights, "doc_id"))
    return lsh.near_matches(vectors.filter(searched("id")), vectors, K, terms=True, skip_same_id=True).select(
        F.col("query_id").alias("doc_id"), "rank", F.col("item_id").alias("neighbor_id"), "similarity")


@query
def knn_lsh_dense(d: Domain) -> DataFrame:
    vectors = similarity.whole_vectors(d.embeddings, "vec_id", "embedding")
    return lsh.near_matches(vectors.filter(searched("id")), vectors, K, skip_same_id=True).select(
        F.col("query_id").alias("vec_id"), "rank", F.col("item_id").alias("neighbor_id"), "similarity")


@query
def similar_documents(d: Domain) -> DataFrame:
    """Pairs of different documents with a cosine of 0.8 or more; equal ones are represented by the smallest id."""
    return pairs.similar_pairs(blocks.from_texts(d.documents, "doc_id", "text"), SIMILAR).select(F.col("id").alias("doc_id"), F.col("other_id").alias("similar_id"), "similarity")


@query
def document_copies(d: Domain) -> DataFrame:
    """Every document with the smallest id of those that have the same terms as often."""
    vectors = similarity.term_vectors(d.document_weights, "doc_id")
    return pairs.members(vectors).select(F.col("id").alias("doc_id"), F.col("vector_id").alias("first_id"))


@query
def knn_assembled(d: Domain) -> DataFrame:
    movies_text = materialize(d.movie_text.join(d.movies.select("movieId", "genre_name"), "movieId").fillna(
        {"genre_name": "Unknown"}))
    model = text.content_pipeline("combined_features", "genre_name").fit(movies_text)
    vectors = text.sparse_entries(model.transform(movies_text), "movieId", "features").withColumnRenamed(
        "movieId", "id")
    n = d.table("part").count()
    return similarity.best_matches(vectors, vectors, K, n_queries=n, n_items=n, terms="terms", skip_same_id=True).select(
        F.col("query_id").alias("movieId"), "rank", F.col("item_id").alias("neighbor_id"), "similarity")


@query
def hybrid_scores(d: Domain) -> DataFrame:
    """For every user, the neighbours of the best and then latest rated movie that has an overview."""
    described = d.documents.select(F.col("doc_id").cast("bigint").alias("movieId"))
    seeds = materialize(d.stored_ratings.join(described, "movieId", "left_semi").groupBy("userId").agg(
        F.max_by("movieId", F.struct("rating", *ORDER)).alias("seed_id")))
    neighbours = d.nearest_documents(seeds.select(F.col("seed_id").alias("doc_id"))).select(
        F.col("query_id").alias("seed_id"), F.col("item_id").alias("movieId"), "similarity")
    return recommend.content_and_ratings(seeds, neighbours, ratings.mean_centered(d.stored_ratings), K)


@query
def similar_to_title(d: Domain) -> DataFrame:
    weights = materialize(text.tfidf(d.stored_movie_text, "movieId", "combined_features"))
    return requests.similar_movies(d.stored_movie_text, weights, TARGET_TITLE, K)


@query
def hybrid_for_user(d: Domain) -> DataFrame:
    weights = materialize(text.tfidf(d.stored_movie_text.repartition("movieId"), "movieId", "combined_features"))
    return requests.hybrid_movies(d.stored_movie_text, weights, d.ratings, USER, TARGET_TITLE, K)


@query
def same_genre(d: Domain) -> DataFrame:
    return recommend.same_genre(d.movies, K)


# --- Recommendation lists -------------------------------------------------------------------------


@query
def popular_unseen_topk(d: Domain) -> DataFrame:
    return d.recs


@query
def flatten_recs(d: Domain) -> DataFrame:
    packed = d.recs.groupBy("userId").agg(
        F.collect_list(F.struct("movieId", F.col("score").cast("double").alias("rating"))).alias("recommendations"))
    return recommend.flatten(packed)


@query
def recs_with_metadata(d: Domain) -> DataFrame:
    return recommend.attach_metadata(d.recs, d.labelled_movies, "left").select(
        "userId", "rank", "movieId", F.col("score").alias("predicted_rating"), *recommend.MISSING)


@query
def filter_by_genre(d: Domain) -> DataFrame:
    return recommend.in_genre(recommend.attach_metadata(d.recs, d.movies), GENRE).select(
        "userId", "rank", "movieId", "genre_name")


@query
def filter_by_popularity(d: Domain) -> DataFrame:
    return recommend.at_least_votes(recommend.attach_metadata(d.recs, d.movies), MIN_VOTES).select(
        "userId", "rank", "movieId", "vote_count")


@query
def advanced_recs(d: Domain) -> DataFrame:
    decayed = ratings.decayed_popularity(d.stored_ratings, AS_OF)
    return recommend.advanced(d.recs, d.movies, decayed, genre=GENRE, min_votes=MIN_VOTES).select(
        "userId", "rank", "movieId", "title", "genre_name", "vote_count", r6("decayed_score").alias("decayed_score"))


@query
def explain_recs(d: Domain) -> DataFrame:
    return recommend.explained(recommend.same_genre(d.movies, K)).select("movieId", "rank", "rec_id", "explanation")


@query
def hybrid_union(d: Domain) -> DataFrame:
    return recommend.side_by_side(d.recs, recommend.same_genre(d.movies, K))


# --- Evaluation -----------------------------------------------------------------------------------


@query
def rmse_baseline(d: Domain) -> DataFrame:
    labelled = ratings.key_split(d.als_ratings)
    means = labelled.filter(F.col("split") == "train").groupBy("movieId").agg(F.avg("rating").alias("prediction"))
    test = joins.salted_join(labelled.filter(F.col("split") == "test"), means, ["movieId"], "inner", spread_by=["userId"])
    return evaluate.rmse(test).select(r6("rmse").alias("rmse"))


@query
def rec_hits(d: Domain) -> DataFrame:
    return evaluate.hits(d.trained_recs, d.truth).select("userId", "rank", "movieId")


@query
def precision_at_k(d: Domain) -> DataFrame:
    return evaluate.precision_at_k(d.trained_recs, d.truth, K).select(r6("precision_at_k").alias("precision_at_k"))


@query
def recall_at_k(d: Domain) -> DataFrame:
    return evaluate.recall_at_k(d.trained_recs, d.truth, K).select(r6("recall_at_k").alias("recall_at_k"))


@query
def precision_at_k_hit_users(d: Domain) -> DataFrame:
    return evaluate.precision_at_k(d.trained_recs, d.truth, K, hit_users_only=True).select(
        r6("precision_at_k").alias("precision_at_k"))


@query
def recall_at_k_hit_users(d: Domain) -> DataFrame:
    return evaluate.recall_at_k(d.trained_recs, d.truth, K, hit_users_only=True).select(
        r6("recall_at_k").alias("recall_at_k"))


@query
def map_at_k(d: Domain) -> DataFrame:
    return evaluate.mean_average_precision(d.trained_recs, d.truth, K).select(r6("map_at_k").alias("map_at_k"))


@query
def metric_curve(d: Domain) -> DataFrame:
    return evaluate.metric_curve(d.trained_recs, d.truth, KS).select(
        "k", *[r6(c).alias(c) for c in ("precision_at_k", "recall_at_k", "map_at_k", "f1_at_k")])


# --- Reports --------------------------------------------------------------------------------------


@query
def rating_distribution(d: Domain) -> DataFrame:
    return analytics.rating_distribution(d.ratings)


@query
def top_recommended(d: Domain) -> DataFrame:
    return analytics.top_recommended(d.recs, d.movies).select("movieId", "title", "n_recs")


@query
def genre_popularity(d: Domain) -> DataFrame:
    return analytics.genre_popularity(d.recs, d.movie_genres)


@query
def genre_diversity(d: Domain) -> DataFrame:
    return analytics.genre_diversity(d.recs, d.movie_genres)


@query
def genre_diversity_sketch(d: Domain) -> DataFrame:
    """The same counts from sketches of two parts of the lists, united; exact for as few genres as there are."""
    listed = joins.salted_join(d.recs.select("userId", "movieId"), d.movie_genres.select("movieId", "genre_name"), ["movieId"], "left",
                               spread_by=["userId"]).fillna({"genre_name": "Unknown"})
    listed = materialize(listed)
    states = [sketches.distinct_state(listed.filter(F.pmod("movieId", F.lit(2)) == half), ["userId"], "genre_name") for half in (0, 1)]
    state = materialize(sketches.distinct_merged(*states, keys=["userId"]))
    return sketches.distinct_counts(state, ["userId"], "genre_diversity")


@query
def rating_quantiles_sketch(d: Domain) -> DataFrame:
    """Quartiles of the ratings of every user from stored sketches."""
    return sketches.quantiles_of(materialize(sketches.quantile_state(d.ratings, ["userId"], "rating")), ["userId"], (0.25, 0.5, 0.75))


@query
def genre_diversity_histogram(d: Domain) -> DataFrame:
    return analytics.histogram(analytics.genre_diversity(d.recs, d.movie_genres), "genre_diversity", 10)


@query
def recommended_avg_rating(d: Domain) -> DataFrame:
    return analytics.recommended_avg_rating(d.recs, d.stored_ratings).select("movieId", r6("avg_rating").alias("avg_rating"))


@query
def recommended_avg_rating_histogram(d: Domain) -> DataFrame:
    return analytics.histogram(analytics.recommended_avg_rating(d.recs, d.stored_ratings), "avg_rating", 20)


@query
def user_item_pivot(d: Domain) -> DataFrame:
    return analytics.matrix_tiles(ratings.pair_means(d.ratings_raw))


@query
def item_correlation(d: Domain) -> DataFrame:
    return analytics.item_correlation(d.stored_ratings, analytics.most_rated(d.stored_ratings, HEAT_MAP)).withColumn(
        "correlation", r6("correlation"))


@query
def popular_vs_unpopular(d: Domain) -> DataFrame:
    return analytics.popular_vs_unpopular(d.recs, d.movies, MIN_VOTES)


# --- Factorisation --------------------------------------------------------------------------------


@query
def als_recs(d: Domain) -> DataFrame:
    return factorize.recommend_all(factorize.fit_als(d.als_ratings, rank=5), K)


@query
def als_recs_unseen(d: Domain) -> DataFrame:
    return factorize.recommend_all(factorize.fit_als(d.als_ratings, rank=5), K, seen=d.als_ratings)


@query
def als_nonneg(d: Domain) -> DataFrame:
    model = factorize.fit_als(d.als_ratings, nonnegative=True)
    return evaluate.rmse(model.transform(d.als_ratings))


@query
def als_user_subset(d: Domain) -> DataFrame:
    """Lists for the users who rated in the last year of the data."""
    recent = d.stored_ratings.filter(F.year("ts") == 2001).select("userId")
    return factorize.recommend_for(factorize.fit_als(d.als_ratings), recent, K)


@query
def als_predictions(d: Domain) -> DataFrame:
    labelled = ratings.key_split(d.als_ratings)
    model = factorize.fit_als(labelled.filter(F.col("split") == "train"), rank=5)
    return model.transform(labelled.filter(F.col("split") == "test")).select(
        "userId", "movieId", "rating", F.col("prediction").cast("double").alias("prediction"))


@query
def svd_factors(d: Domain) -> DataFrame:
    return factorize.singular_values(factorize.truncated_svd(d.als_ratings))


@query
def svd_recs(d: Domain) -> DataFrame:
    return factorize.svd_predictions(factorize.truncated_svd(d.als_ratings), K, d.als_ratings)
