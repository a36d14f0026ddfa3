"""Cosine similarity of texts and vectors: one target, or every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators import blocks
from tastegrid.operators.grid import ROW_BYTES, best_matches, best_of_blocks
from tastegrid.operators.text import inverse_document_frequency, token_counts, weigh_terms
from tastegrid.session import materialize


def term_vectors(weights: DataFrame, key: str, term: str = "term", value: str = "tfidf") -> DataFrame:
    """(id, terms, weights): the terms of a document in one row, as long as its own text at most."""
    packed = F.collect_list(F.struct(F.col(term).alias("t"), F.col(value).alias("w"))).alias("_e")
    return weights.groupBy(F.col(key).alias("id")).agg(packed).select(
        "id", F.transform("_e", lambda e: e["t"]).alias("terms"), F.transform("_e", lambda e: e["w"]).alias("weights"))


def nearest_texts(
    weights: DataFrame, key: str, k: int, n_documents: int, term: str = "term", row_bytes: int = ROW_BYTES,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """(query_id, rank, item_id, similarity): the ``k`` nearest other documents of every document.

    ``row_bytes`` is the usual size of a document's terms and weights. ``wanted`` (key) limits the documents that
    are asked about, not those that are found.
    """
    vectors = term_vectors(weights, key, term)
    queries, n_queries = vectors, n_documents
    if wanted is not None:
        asked = wanted.select(F.col(key).alias("id")).distinct()
        queries, n_queries = vectors.join(asked, "id", "left_semi"), asked.count()
    return best_matches(queries, vectors, k, n_queries=n_queries, n_items=n_documents, terms="terms",
                        skip_same_id=True, row_bytes=row_bytes)


def nearest_documents(df: DataFrame, key: str, text: str, k: int, wanted: DataFrame | None = None) -> DataFrame:
    """``nearest_texts`` from the texts themselves, packed in blocks: no row per document and term is sent or stored."""
    items = blocks.from_texts(df, key, text)
    queries = items if wanted is None else blocks.some_rows(items, wanted.select(F.col(key).alias("id")), max(1, items.count()))
    return best_of_blocks(queries, items, k, skip_same_id=True)


def whole_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, weights) of the vectors that are not null and have no null or NaN in them."""
    return df.select(F.col(key).alias("id"), F.col(vector).alias("weights")).filter(
        F.col("weights").isNotNull() & ~F.exists("weights", lambda x: x.isNull() | F.isnan(x)))


def nearest_vectors(
    df: DataFrame, key: str, vector: str, k: int, n_rows: int, digits: int = 6, row_bytes: int = ROW_BYTES
) -> DataFrame:
    """(query_id, rank, item_id, similarity) over dense vectors of one length.

    A null vector, or one with a null or NaN in it, is absent; vectors of two lengths are an error.
    """
    rows = whole_vectors(df, key, vector)
    return best_matches(rows, rows, k, n_queries=n_rows, n_items=n_rows, digits=digits, skip_same_id=True,
                        row_bytes=row_bytes)


def target_by_title(movies: DataFrame, title: str, key: str = "movieId") -> DataFrame:
    """One row with the smallest id that has this title; no row if none has."""
    return movies.filter(F.col("title") == title).select(key).orderBy(key).limit(1)


def similar_to_target(
    weights: DataFrame, target: DataFrame, key: str, n: int, include_self: bool = True, digits: int = 6
) -> DataFrame:
    """(key, similarity): the ``n`` documents most similar to the one document in ``target``.

    One pass over the weights: every document's dot product with the target comes from the
    target's own terms, broadcast because they are at most one document's. Documents sharing no
    term have similarity 0; without a target there are no rows.
    """
    wanted = F.broadcast(target.select(F.col(key).alias("_target")))
    target_terms = weights.join(wanted, F.col(key) == F.col("_target"), "left_semi").select(
        "term", F.col("tfidf").alias("_w"))
    return _ranked(weights, target_terms, wanted, key, n, include_self, digits)


def similar_to_text(
    df: DataFrame, target: DataFrame, key: str, text: str, n: int, include_self: bool = True, digits: int = 6,
    listed: DataFrame | None = None,
) -> DataFrame:
    """``similar_to_target`` from the texts themselves, for one request: no table of weights is stored.

    Term counts are stored once. The target's few terms get their frequencies by a look-up; all others are weighed on the
    way, as a document's length needs every one of its weights. ``listed`` has as many rows as ``df`` where that is costly to make.
    """
    terms = materialize(token_counts(df, key, text))
    n_documents = (df if listed is None else listed).agg(F.count(F.lit(1)).alias("n_documents"))
    wanted = F.broadcast(target.select(F.col(key).alias("_target")))
    own = materialize(terms.join(wanted, F.col(key) == F.col("_target"), "left_semi").select("term", "tf"))
    known = inverse_document_frequency(terms.join(F.broadcast(own.select("term")), "term", "left_semi"), n_documents)
    target_terms = materialize(known.join(F.broadcast(own), "term").select("term", (F.col("tf") * F.col("idf")).alias("_w")))
    weights = weigh_terms(terms, inverse_document_frequency(terms, n_documents), key)
    return _ranked(weights, target_terms, wanted, key, n, include_self, digits)


def _ranked(weights: DataFrame, target_terms: DataFrame, wanted: DataFrame, key: str, n: int, include_self: bool, digits: int) -> DataFrame:
    target_norm = target_terms.agg(F.sqrt(F.sum(F.col("_w") ** 2))).scalar()
    scored = weights.join(F.broadcast(target_terms), "term", "left").groupBy(key).agg(
        F.sqrt(F.sum(F.col("tfidf") ** 2)).alias("_norm"),
        F.sum(F.col("tfidf") * F.col("_w")).alias("_dot"))
    scale = F.nullif(F.col("_norm") * F.col("_target_norm"), F.lit(0.0))
    similarity = F.round(F.coalesce(F.col("_dot") / scale, F.lit(0.0)), digits)
    result = scored.withColumn("_target_norm", target_norm).filter(F.col("_target_norm").isNotNull()).select(
        key, similarity.alias("similarity"))
    if not include_self:
        result = result.join(wanted, F.col(key) == F.col("_target"), "left_anti")
    return result.orderBy(F.desc("similarity"), key).limit(n)
