"""Column expressions for derived numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_MONTH = 60 * 60 * 24 * 30


def shrunk_rating(votes: Column, average: Column, strength: Column, prior: float = 7.0) -> Column:
    """Mean vote drawn towards ``prior`` as if ``strength`` votes had been cast for it."""
    weight = votes + strength
    return votes / F.nullif(weight, F.lit(0)) * average + strength / F.nullif(weight, F.lit(0)) * prior


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def tier(value: Column, low: Column, high: Column) -> Column:
    """``low``/``medium``/``high`` by two cut points; a missing value is ``high``."""
    return F.when(value <= low, "low").when(value <= high, "medium").otherwise("high")


def decayed(rating: Column, at_seconds: Column, as_of: int, factor: float = 0.5) -> Column:
    """Rating that loses weight exponentially per 30 days of age at ``as_of`` (epoch seconds)."""
    return rating * F.exp(-F.lit(factor) * (F.lit(as_of) - at_seconds) / F.lit(float(SECONDS_PER_MONTH)))


def smoothed_idf(n_documents: Column, document_frequency: Column) -> Column:
    return F.log((n_documents + 1.0) / (document_frequency + 1.0))
