"""Token counts, TF-IDF weights and label indexes in long form, and the vector pipelines."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF, HashingTF, StringIndexer, Tokenizer, VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.functions import scores, scrub
from tastegrid.operators.joins import salted_join
from tastegrid.operators.ranking import global_positions
from tastegrid.session import materialize


def token_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf) over lower-cased white-space tokens of the whole text."""
    return df.select(key, F.explode(scrub.words(text)).alias("term")).groupBy(key, "term").agg(
        F.count(F.lit(1)).alias("tf"))


def inverse_document_frequency(terms: DataFrame, n_documents: DataFrame, term: str = "term") -> DataFrame:
    """(term, idf) from distinct (document, term) rows and a one-row document count."""
    df = terms.groupBy(term).agg(F.count(F.lit(1)).alias("df"))
    return df.select(term, scores.smoothed_idf(n_documents.scalar(), F.col("df")).alias("idf"))


def weigh_terms(terms: DataFrame, idf: DataFrame, key: str, term: str = "term") -> DataFrame:
    """(key, term, tfidf). The vocabulary is too large a table to repeat, so it is salted once."""
    return salted_join(terms, idf, [term], "inner", spread_by=[key], salts=1).select(
        key, term, (F.col("tf") * F.col("idf")).alias("tfidf"))


def tfidf(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tfidf) over the exact vocabulary."""
    terms = materialize(token_counts(df, key, text))  # weighed and counted: tokenised once
    n_documents = df.agg(F.count(F.lit(1)).alias("n_documents"))
    return weigh_terms(terms, inverse_document_frequency(terms, n_documents), key)


def label_index(df: DataFrame, label: str, index: str = "label_index") -> DataFrame:
    """(label, label_count, index): 0 for the most frequent label, ties in label order.

    Labels are counted before they are numbered, and numbered by sorted ranges, so neither a hot
    label nor a large set of labels meets in one task.
    """
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("label_count"))
    numbered = global_positions(counts, [F.desc("label_count"), F.asc(label)], index)
    return numbered.withColumn(index, F.col(index) - 1)


def hashed_tfidf_stages(text: str, features: str, buckets: int = 1000) -> list:
    """Tokens, hashed term counts and IDF weights as pipeline stages."""
    tokens, counts = f"{features}_tokens", f"{features}_tf"
    return [
        Tokenizer(inputCol=text, outputCol=tokens),
        HashingTF(inputCol=tokens, outputCol=counts, numFeatures=buckets),
        IDF(inputCol=counts, outputCol=features),
    ]


def hashed_tfidf(df: DataFrame, text: str, features: str = "features", buckets: int = 1000) -> DataFrame:
    """``df`` with a hashed TF-IDF vector of its text; null text counts as empty."""
    filled = df.fillna({text: ""})
    model = Pipeline(stages=hashed_tfidf_stages(text, features, buckets)).fit(filled)
    return model.transform(filled).drop(f"{features}_tokens", f"{features}_tf")


def content_pipeline(text: str, category: str, features: str = "features", buckets: int = 1000) -> Pipeline:
    """Hashed TF-IDF of a text and the frequency index of a category, assembled into one vector."""
    return Pipeline(stages=[
        *hashed_tfidf_stages(text, "text_tfidf", buckets),
        StringIndexer(inputCol=category, outputCol="category_index", handleInvalid="keep"),
        VectorAssembler(inputCols=["text_tfidf", "category_index"], outputCol=features),
    ])


def store_pipeline(model: PipelineModel, path: str) -> None:
    """Write a fitted pipeline (vocabulary, document frequencies, labels) to a folder, replacing what is there."""
    model.write().overwrite().save(path)


def stored_pipeline(path: str) -> PipelineModel:
    """A fitted pipeline as it was stored: new rows get the features they would have got then."""
    return PipelineModel.load(path)


def sparse_entries(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, indices, weights) arrays of an ML vector column, read without leaving the JVM."""
    raw = F.unwrap_udt(vector)
    dense = F.sequence(F.lit(0), F.size(raw["values"]) - 1)
    return df.select(key, F.coalesce(raw["indices"], dense).alias("terms"), raw["values"].alias("weights"))
