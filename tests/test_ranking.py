import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from table_rows import rows
from tastegrid.operators import ranking, text


def brute_force_unseen(pairs, k):
    counts = Counter(m for _, m in pairs)
    order = sorted(counts, key=lambda m: (-counts[m], m))
    seen = defaultdict(set)
    for u, m in pairs:
        seen[u].add(m)
    return sorted((u, r + 1, m, counts[m]) for u in seen
                  for r, m in enumerate([m for m in order if m not in seen[u]][:k]))


@pytest.mark.parametrize("block", [3, 65536])
def test_most_popular_unseen_matches_brute_force(spark, block):
    rng = random.Random(1)
    pairs = {(u, m) for u in range(30) for m in rng.sample(range(60), rng.randint(1, 25))}
    pairs |= {(99, m) for m in range(58)}      # has seen nearly everything
    pairs |= {(98, m) for m in range(60)}      # has seen everything: no list
    df = spark.createDataFrame(sorted(pairs), "userId int, movieId int")
    got = sorted(tuple(r) for r in ranking.most_popular_unseen(df, 7, block=block).collect())
    assert got == brute_force_unseen(pairs, 7)


def test_global_positions(spark):
    values = [(i * 7919 % 1000, f"k{i}") for i in range(500)]
    df = spark.createDataFrame(values, "a int, b string")
    got = ranking.global_positions(df, [F.desc("a"), F.asc("b")]).orderBy("position").collect()
    assert [(r.a, r.b) for r in got] == sorted(values, key=lambda v: (-v[0], v[1]))
    assert [r.position for r in got] == list(range(1, 501))


def test_positions_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(u, m) for u in range(9) for m in range(u, 12)], "userId int, movieId int")
    expected = rows(ranking.most_popular_unseen(df, 3))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert rows(ranking.most_popular_unseen(df, 3)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_label_index_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(c,) for c in "ccbaddde"] + [(None,)], "label string")
    got = {r.label: r.label_index for r in text.label_index(df, "label").collect()}
    model = StringIndexer(inputCol="label", outputCol="i", handleInvalid="skip").fit(df)
    assert got == {label: i for i, label in enumerate(model.labels)}


def test_top_n(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 0), (1, 9, 2), (2, 1, 7)], "g int, s int, id int")
    got = rows(ranking.top_n(df, 2, ["g"], [F.desc("s"), F.asc("id")]), "g", "id", "rank")
    assert got == [(1, 0, 2), (1, 2, 1), (2, 7, 1)]
