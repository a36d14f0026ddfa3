"""Every query with a SQL twin gives the same rows in Spark and DuckDB."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
ORACLE = contract.oracle_sql()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return str(value)


def as_counter(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(t[i]) for i in order) for t in tuples)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, sf_dir, name):
    result = contract.queries()[name](spark, sf_dir)
    relation = duck.sql(ORACLE[name])
    assert {c: TYPES[t] for c, t in result.dtypes} == dict(zip(relation.columns, map(str, relation.types)))
    ours = as_counter(result.columns, [tuple(r) for r in result.collect()])
    theirs = as_counter(relation.columns, relation.fetchall())
    assert ours == theirs
    assert ours or name == "missing_movie_ids"  # the smallest tables describe every movie


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["id", "title", "genre_name", "vote_count", "weighted_rating"]
    assert result.count() == 10
