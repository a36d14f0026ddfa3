"""Cast and crew lists: rows, per-movie features, leading names, directors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.functions import scrub
from tastegrid.operators.joins import salted_join
from tastegrid.operators.ratings import first_per_key

FEMALE, MALE = 1, 2  # fixed values of the gender code


def _known(gender: str):
    return F.col(gender).isNull() | (F.col(gender) >= 0)


def cast_rows(credits: DataFrame) -> DataFrame:
    """One row per (movie, name, character), names capitalised first so that case variants merge."""
    member = F.explode(scrub.parse_list("cast", scrub.CAST_TYPE)).alias("m")
    rows = credits.select(F.col("id").alias("movie_id"), member).select(
        "movie_id", F.initcap("m.name").alias("cast_name"), F.col("m.character").alias("character"),
        F.col("m.gender").alias("cast_gender"), F.col("m.order").alias("cast_order"))
    valid = rows.filter(F.col("movie_id").isNotNull() & F.col("cast_name").isNotNull() & _known("cast_gender"))
    return first_per_key(valid, ["movie_id", "cast_name", "character"], ["cast_order", "cast_gender"])


def crew_rows(credits: DataFrame) -> DataFrame:
    """One row per (movie, name, job)."""
    member = F.explode(scrub.parse_list("crew", scrub.CREW_TYPE)).alias("m")
    rows = credits.select(F.col("id").alias("movie_id"), member).select(
        "movie_id", F.initcap("m.name").alias("crew_name"), F.col("m.department").alias("department"),
        F.col("m.job").alias("job"), F.col("m.gender").alias("crew_gender"))
    valid = rows.filter(F.col("movie_id").isNotNull() & F.col("crew_name").isNotNull() & _known("crew_gender"))
    return first_per_key(valid, ["movie_id", "crew_name", "job"], ["department", "crew_gender"])


def cast_features(cast: DataFrame) -> DataFrame:
    """Cast size, lead actor (lowest order, then name) and gender counts in one aggregate."""
    return cast.groupBy("movie_id").agg(
        F.count("cast_name").alias("cast_count"),
        F.min_by("cast_name", F.struct(F.coalesce("cast_order", F.lit(2**63 - 1)), "cast_name")).alias("lead_actor"),
        F.count_if(F.col("cast_gender") == FEMALE).alias("female_cast_count"),
        F.count_if(F.col("cast_gender") == MALE).alias("male_cast_count"),
    )


def crew_features(crew: DataFrame) -> DataFrame:
    """Crew size, most frequent department (ties: first by name) and gender counts.

    Two levels of aggregation: the second one sees one row per department, not per person.
    """
    by_department = crew.groupBy("movie_id", "department").agg(
        F.count("crew_name").alias("n"),
        F.count_if(F.col("crew_gender") == FEMALE).alias("women"),
        F.count_if(F.col("crew_gender") == MALE).alias("men"),
    )
    return by_department.groupBy("movie_id").agg(
        F.sum("n").alias("crew_count"),
        F.min_by("department", F.struct(-F.when(F.col("department").isNull(), 0).otherwise(F.col("n")), "department"))
        .alias("most_common_department"),
        F.sum("women").alias("female_crew_count"),
        F.sum("men").alias("male_crew_count"),
    )


def leading_cast(cast: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` names per movie in credit order; only those reach the list."""
    order = Window.partitionBy("movie_id").orderBy("cast_order", "cast_name")
    top = cast.select("movie_id", "cast_name", "cast_order").withColumn(
        "position", F.row_number().over(order)).filter(F.col("position") <= n)
    listed = F.sort_array(F.collect_list(F.struct("position", "cast_name")))
    return top.groupBy("movie_id").agg(F.transform(listed, lambda m: m["cast_name"]).alias("cast_names"))


def directors(credits: DataFrame) -> DataFrame:
    """(movie_id, director), the list filtered before it is unnested."""
    people = F.filter(scrub.parse_list("crew", scrub.CREW_TYPE), lambda m: m["job"] == "Director")
    return credits.select(F.col("id").alias("movie_id"), F.explode(people).alias("m")).select(
        "movie_id", F.initcap("m.name").alias("director")).distinct()


def director_features(cast: DataFrame, credits: DataFrame) -> DataFrame:
    """(movie_id, lead_actor, director): one row per director with the first cast name."""
    leads = cast_features(cast).select("movie_id", "lead_actor")
    return salted_join(directors(credits), leads, ["movie_id"], "left", spread_by=["director"])
