"""Joins of a large table with a per-key table where one key may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 4


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """``facts.join(lookup, on, how)`` that stays balanced when one key holds most of the facts.

    The rows of a key are spread over ``salts`` partitions by a hash of ``spread_by`` (columns that
    vary within a key), and ``lookup``, which holds few rows per key, is repeated once per salt.
    Just as important, the salt makes both sides meet in a fresh exchange: a lookup that is itself
    an aggregate by the key would otherwise be joined where it lies, and adaptive execution
    splits a skewed partition only between two plain exchanges. So ``salts=1`` is enough where the
    lookup is large. A lookup that is small by its size is broadcast and nothing is moved.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"a salted {how} join would repeat lookup rows")
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    spread = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("_salt", salt).join(spread, [*on, "_salt"], how).drop("_salt")


def unknown_ids(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Ids that occur in ``facts`` but not in ``dimension``; distinct before the join."""
    return facts.select(key).distinct().join(dimension.select(key), key, "left_anti")


def prefer_first(left: DataFrame, right: DataFrame, on: Sequence[str], value: str, sentinel=None) -> DataFrame:
    """Full outer join in which the right table's value wins over the left one's.

    Rows that have a value on neither side are dropped. With ``sentinel`` set, missing values are
    replaced by it before the choice, so that a row known to the right table without a value
    hides the left one's value and is dropped.
    """
    if sentinel is not None:
        left, right = left.fillna({value: sentinel}), right.fillna({value: sentinel})
    joined = left.join(right.withColumnRenamed(value, "_preferred"), list(on), "full")
    chosen = F.coalesce("_preferred", value)
    keep = chosen.isNotNull() if sentinel is None else chosen != sentinel
    return joined.select(*on, chosen.cast("bigint").alias(value)).filter(keep)
