"""Keyword lists held as bracketed, quoted text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.functions import scores, scrub
from tastegrid.operators.joins import salted_join
from tastegrid.operators.text import inverse_document_frequency, label_index, weigh_terms
from tastegrid.session import materialize

JSON_KEYWORDS = "array<struct<id:int,name:string>>"


def keyword_rows(df: DataFrame, strip_brackets: bool = True) -> DataFrame:
    """Distinct (movie_id, keyword_name), capitalised, empty ones dropped.

    With ``strip_brackets`` the list is unwrapped and each part trimmed before its quotes go.
    Without it the text is taken as a plain list: split at commas, one quote removed at each end
    as the part stands, then trimmed.
    """
    if strip_brackets:
        parts = F.split(scrub.without_brackets("keywords"), ",")
        name = F.trim(scrub.without_outer_quotes(F.trim("part")))
    else:
        parts = F.split("keywords", ",")
        name = F.trim(scrub.without_outer_quotes("part"))
    rows = df.filter(F.col("keywords").isNotNull()).select(
        F.col("id").alias("movie_id"), F.explode(parts).alias("part"))
    return rows.select("movie_id", F.initcap(name).alias("keyword_name")).filter(
        F.col("keyword_name") != "").distinct()


def keyword_names(df: DataFrame) -> DataFrame:
    """Distinct (movie_id, keyword_name) out of a list of ``{'id': .., 'name': ..}`` records."""
    record = F.explode(scrub.parse_list("keywords", JSON_KEYWORDS)).alias("k")
    return df.select(F.col("id").alias("movie_id"), record).select(
        "movie_id", F.initcap(F.trim("k.name")).alias("keyword_name")).filter(
        F.col("keyword_name") != "").distinct()


def keyword_list_rows(df: DataFrame) -> DataFrame:
    """(movie_id, keyword_name) with all brackets at the ends and all quotes removed, empty parts dropped."""
    bare = F.regexp_replace(scrub.without_brackets("keywords"), "['\"]", "")
    return df.select(F.col("id").alias("movie_id"), F.explode(F.split(bare, ", ")).alias("keyword_name")).filter(
        F.col("keyword_name") != "")


def keyword_lists(df: DataFrame) -> DataFrame:
    """(movie_id, keyword_names): the movie's distinct keywords in order, comma separated.

    Repeated keywords, also those of repeated rows, are dropped before lists are collected.
    """
    return keyword_list_rows(df).distinct().groupBy("movie_id").agg(
        F.concat_ws(",", F.sort_array(F.collect_list("keyword_name"))).alias("keyword_names"))


def multi_hot(rows: DataFrame) -> DataFrame:
    """Sparse 0/1 encoding in long form: one row per movie and distinct keyword."""
    return rows.select("movie_id", "keyword_name").distinct().withColumn("value", F.lit(1.0))


def keyword_tfidf(rows: DataFrame) -> DataFrame:
    """(movie_id, keyword_name, tfidf) with a 0/1 term frequency."""
    terms = multi_hot(rows).withColumnRenamed("value", "tf")
    n_movies = rows.agg(F.count_distinct("movie_id").alias("n_documents"))
    idf = inverse_document_frequency(terms, n_movies, term="keyword_name")
    return weigh_terms(terms, idf, "movie_id", "keyword_name")


def keyword_vectors(rows: DataFrame) -> DataFrame:
    """(movie_id, terms, weights): sparse TF-IDF vectors with a 0/1 term frequency.

    Keywords are numbered from 0 by falling frequency, as a table of its own, so the vocabulary may be of any size.
    """
    known = materialize(rows.select("movie_id", "keyword_name").distinct())
    n_movies = known.agg(F.count_distinct("movie_id")).scalar()
    numbered = label_index(known, "keyword_name", "term").select(
        "keyword_name", "term", scores.smoothed_idf(n_movies, F.col("label_count")).alias("weight"))
    entries = salted_join(known, numbered, ["keyword_name"], "inner", spread_by=["movie_id"], salts=1)
    packed = entries.groupBy("movie_id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("_e"))
    return packed.select("movie_id", F.col("_e.term").alias("terms"), F.col("_e.weight").alias("weights"))
