"""Movie-domain tables derived from the star-schema parquet files.

Orders by a customer of a part become ratings by a user of a movie. The views carry the dirt the
cleaning operators exist for: repeated pairs, text numbers, nullable flags, Python-literal lists.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.operators.ratings import latest_per_key
from tastegrid.session import materialize, shared_path
from tastegrid.sources.files import write_csv


def _quoted(text):
    """Write ``~`` for a single quote in the literal lists below."""
    return F.replace(text, F.lit("~"), F.lit("'"))


class MovieTables:
    """Lazy DataFrames over one data folder; nothing is read before an action."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{name}.parquet")

    @cached_property
    def rating_events(self) -> DataFrame:
        """Every order line as a rating, with its order priority, discount and tax."""
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate", "l_discount", "l_tax")
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").cast("bigint").alias("userId"),
            F.col("l_partkey").cast("bigint").alias("movieId"),
            (F.ceil(F.col("l_quantity") / 5.0).cast("double") / 2).alias("rating"),
            F.col("l_shipdate").cast("timestamp").alias("ts"),
            F.col("l_orderkey").alias("ok"),
            F.col("l_linenumber").alias("ln"),
            "o_orderpriority", "l_discount", "l_tax",
        )

    @cached_property
    def ratings_raw(self) -> DataFrame:
        return self.rating_events.select("userId", "movieId", "rating", "ts", "ok", "ln")

    @cached_property
    def ratings_dirty(self) -> DataFrame:
        """Ratings with nulls and values off the scale, as a raw file would hold them."""
        rating = F.col("rating")
        return self.rating_events.select(
            "userId", "movieId",
            F.when(F.col("l_discount") >= 0.1, F.lit(None).cast("double"))
            .when(F.col("l_tax") >= 0.08, rating + 5).otherwise(rating).alias("rating"),
            F.unix_timestamp("ts").alias("timestamp"), "ok", "ln",
        )

    @cached_property
    def ratings_file(self) -> str:
        """Path of a ratings CSV, written on first use, in which some ratings and timestamps are no numbers."""
        path = shared_path(self.spark, "csv")
        write_csv(self.rating_events.select(
            "userId", "movieId",
            F.when(F.col("l_discount") >= 0.1, "n/a").otherwise(F.col("rating").cast("string")).alias("rating"),
            F.when(F.col("l_tax") >= 0.08, "unknown").otherwise(F.unix_timestamp("ts").cast("string")).alias("timestamp"),
            "ok", "ln"), path)
        return path

    @cached_property
    def ratings_full(self) -> DataFrame:
        return self.rating_events.select("userId", "movieId", "rating", F.unix_timestamp("ts").alias("timestamp"))

    @cached_property
    def ratings_small(self) -> DataFrame:
        """The second, smaller ratings file: lines of urgent orders."""
        return self.rating_events.filter(F.col("o_orderpriority") == "1-URGENT").select(
            "userId", "movieId", "rating", F.unix_timestamp("ts").alias("timestamp"))

    @cached_property
    def ratings(self) -> DataFrame:
        """One rating per (user, movie): the latest."""
        return latest_per_key(self.ratings_raw, ["userId", "movieId"], ["ts", "ok", "ln"], ["rating"])

    @cached_property
    def stored_ratings(self) -> DataFrame:
        """``ratings`` written once, for queries that read them more than once."""
        return materialize(self.ratings)

    @property
    def known_ratings(self) -> DataFrame:
        """The stored ratings if this folder's queries have stored them already."""
        return self.__dict__.get("stored_ratings", self.ratings)

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents").select("doc_id", "text")

    @cached_property
    def movie_parts(self) -> DataFrame:
        """What the part table alone tells about a movie: titles, flags, text numbers, nested lists."""
        key, size = F.col("p_partkey"), F.col("p_size")
        size_text = size.cast("string")
        return self.table("part").select(
            key.cast("bigint").alias("id"),
            F.format_string("tt%07d", key * 7 + 1).alias("imdb_id"),
            F.col("p_name").alias("title"),
            F.when(size % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("tagline"),
            F.when(size > 40, F.lit(None).cast("string")).otherwise("Released").alias("status"),
            F.when(key % 5 == 0, "True").when(key % 5 == 1, F.lit(None).cast("string"))
            .otherwise("False").alias("adult"),
            F.when(F.col("p_type") == "PROMO", "True").when(F.col("p_type") == "SMALL", F.lit(None).cast("string"))
            .otherwise("False").alias("video"),
            F.concat(F.lit("$"), F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string")).alias("budget"),
            F.when(size < 5, F.lit(None).cast("double")).otherwise((size * 3).cast("double")).alias("runtime"),
            F.when(key % 13 == 0, "").otherwise(F.concat(F.lit("pop "), size_text, F.lit(".5"))).alias("popularity"),
            F.when(key % 7 == 0, "[]").otherwise(_quoted(F.concat(
                F.lit("[{~id~: "), size_text, F.lit(", ~name~: ~"), F.col("p_type"),
                F.lit("~}, {~id~: 100, ~name~: ~"), F.col("p_brand"), F.lit("~}]")))).alias("genres"),
            _quoted(F.concat(
                F.lit("[{~name~: ~"), F.col("p_brand"), F.lit("~, ~id~: "), size_text, F.lit("}]")))
            .alias("production_companies"),
            _quoted(F.concat(
                F.lit("[{~iso_3166_1~: ~"), F.substring("p_type", 1, 2), F.lit("~, ~name~: None}]")))
            .alias("production_countries"),
        )

    @cached_property
    def movie_lists_cut(self) -> DataFrame:
        """The parts' nested lists with some of them cut off, as in a file that was not written to its end."""
        cut = F.col("id") % 17 == 0
        return self.movie_parts.select("id", *[
            F.when(cut, F.expr(f"left({c}, length({c}) - 2)")).otherwise(F.col(c)).alias(c)
            for c in ("genres", "production_companies", "production_countries")])

    def _with_votes(self, movies: DataFrame) -> DataFrame:
        votes = self.known_ratings.groupBy(F.col("movieId").alias("id")).agg(
            F.min("ts").cast("date").alias("release_date"),
            F.count(F.lit(1)).alias("vote_count"),
            F.round(F.avg("rating") * 2, 4).alias("vote_average"),
            F.round(F.sum("rating"), 2).alias("revenue"),
        )
        return movies.join(votes, "id", "left").fillna({"vote_count": 0, "vote_average": 0.0})

    def _with_text(self, movies: DataFrame) -> DataFrame:
        docs = self.table("documents").select(
            F.col("doc_id").alias("id"), F.col("text").alias("overview"), F.col("lang").alias("original_language"))
        language = F.col("original_language")
        return movies.join(docs, "id", "left").withColumn(
            "spoken_languages",
            F.when(language.isNull(), "[]").otherwise(_quoted(F.concat(
                F.lit("[{~iso_639_1~: ~"), language, F.lit("~, ~name~: ~"), F.upper(language), F.lit("~}]")))))

    @cached_property
    def movies_rated(self) -> DataFrame:
        """The parts with votes, revenue and release date out of the ratings."""
        return self._with_votes(self.movie_parts)

    @cached_property
    def movies_described(self) -> DataFrame:
        """The parts with overview and languages out of the documents."""
        return self._with_text(self.movie_parts)

    @cached_property
    def movies_raw(self) -> DataFrame:
        """The whole metadata table."""
        return self._with_text(self.movies_rated)

    @cached_property
    def cast_credits(self) -> DataFrame:
        """(id, cast): literal-list text, one member per row; a movie may span many rows."""
        members = (
            self.table("lineitem").groupBy("l_partkey", "l_suppkey").agg(F.min("l_orderkey").alias("first_order"))
            .join(self.table("supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        )
        return members.select(
            F.col("l_partkey").cast("bigint").alias("id"),
            _quoted(F.concat(
                F.lit("[{~cast_id~: "), F.col("l_suppkey").cast("string"), F.lit(", ~character~: None, ~gender~: "),
                (F.col("l_suppkey") % 3).cast("string"), F.lit(", ~name~: ~"), F.lower("s_name"),
                F.lit("~, ~order~: "), F.col("first_order").cast("string"), F.lit("}]"))).alias("cast"),
        )

    @cached_property
    def crew_credits(self) -> DataFrame:
        """(id, crew): literal-list text, one member per row."""
        lines = self.table("lineitem").select("l_orderkey", "l_partkey")
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        people = self.table("customer").select("c_custkey", "c_name", "c_mktsegment")
        return (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(people, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("l_partkey").cast("bigint").alias("id"),
                _quoted(F.concat(
                    F.lit("[{~department~: ~"), F.col("c_mktsegment"), F.lit("~, ~gender~: "),
                    (F.col("c_custkey") % 3).cast("string"), F.lit(", ~job~: ~"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", "Director").otherwise("Crew"),
                    F.lit("~, ~name~: ~"), F.lower("c_name"), F.lit("~}]"))).alias("crew"),
            )
        )

    @cached_property
    def keywords_raw(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("bigint").alias("id"),
            _quoted(F.concat(
                F.lit("[~"), F.replace(F.col("p_name"), F.lit(" "), F.lit("~, ~")), F.lit("~, ~"),
                F.col("p_brand"), F.lit("~]"))).alias("keywords"),
        )

    @cached_property
    def links_full(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.cast("bigint").alias("movieId"),
            F.when(key % 50 == 0, 0).otherwise(key * 7 + 1).cast("bigint").alias("imdbId"),
            F.when(key % 11 == 0, F.lit(None).cast("double")).otherwise((key + 100000).cast("double")).alias("tmdbId"),
        )

    @cached_property
    def links_small(self) -> DataFrame:
        """The second, smaller links file: large parts, with other ids so that precedence shows."""
        key = F.col("p_partkey")
        return self.table("part").filter(F.col("p_size") > 25).select(
            key.cast("bigint").alias("movieId"),
            F.when(key % 50 == 0, 0).otherwise(key * 7 + 1).cast("bigint").alias("imdbId"),
            F.when(key % 4 == 0, F.lit(None).cast("double")).otherwise((key + 200000).cast("double")).alias("tmdbId"),
        )

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.table("embeddings").select("vec_id", "embedding")
