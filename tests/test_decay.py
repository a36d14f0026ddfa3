"""Stored decay sums against the scores from all ratings."""

import random

import pytest
from pyspark.sql import functions as F

from tastegrid.operators import decay, ratings

RNG = random.Random(3)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(RNG.randrange(20), RNG.choice([1.0, 2.5, 5.0, None]), RNG.choice([None] + [RNG.randrange(0, 2_000_000_000) for _ in range(9)]))
            for _ in range(600)] + [(99, 3.0, 5), (None, 4.0, 10**9)]
    frame = spark.createDataFrame(rows, "movieId bigint, rating double, s bigint")
    return frame.select("movieId", "rating", F.timestamp_seconds("s").alias("ts"))


def scores(df):
    return {r.movieId: r.decayed_score for r in df.collect() if r.decayed_score is not None}


@pytest.mark.parametrize("as_of", [1_500_000_000, 2_000_000_000, 2_300_000_000])
def test_equal_to_all_ratings_for_split_inputs(table, as_of):
    parts = [table.filter(F.pmod(F.xxhash64("movieId", "rating", "ts"), F.lit(3)) == k) for k in range(3)]
    state = decay.merged(*(decay.decay_state(p) for p in parts))
    want = scores(ratings.decayed_popularity(table, as_of))
    for kept in (state, decay.folded(state, 2_000_000_000 // decay.EPOCH), decay.folded(decay.folded(state, 50), 2_400_000_000 // decay.EPOCH)):
        got = scores(decay.popularity_at(kept, as_of))
        assert got.keys() == want.keys() and all(got[m] == pytest.approx(want[m], rel=1e-9, abs=1e-280) for m in want)


def test_folding_leaves_one_row_an_item(table):
    state = decay.folded(decay.decay_state(table), 2_400_000_000 // decay.EPOCH)
    assert state.groupBy("movieId").count().filter("count > 1").count() == 0
    assert decay.decay_state(table.limit(0)).collect() == []


def test_sums_are_made_in_tasks_of_bounded_size(spark, monkeypatch):
    """Thirty ratings a task at most on average, however few shuffle partitions the session has."""
    monkeypatch.setattr(decay, "SUMS", 30)
    many = spark.range(900).select((F.col("id") * 7).alias("movieId"), (F.col("id") % 5 + 0.5).alias("rating"),
                                   F.timestamp_seconds(F.col("id") % 3 * 40_000_000).alias("ts"))
    tasks = decay.tasks_for(many)
    assert tasks == 30
    halves = [decay.decay_state(many.filter(F.col("movieId") % 2 == half), tasks=tasks) for half in (0, 1)]
    for state in (*halves, folded := decay.folded(decay.merged(*halves, tasks=tasks), 20)):
        sizes = [r[1] for r in state.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 20 and max(sizes) < 90 and sum(sizes) == state.count()
    got, want = scores(decay.popularity_at(folded, 10**9)), scores(ratings.decayed_popularity(many, 10**9))
    assert got.keys() == want.keys() and all(got[m] == pytest.approx(want[m], rel=1e-9) for m in want)
