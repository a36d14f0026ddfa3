import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from table_rows import rows
from tastegrid.operators import analytics, recommend


@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(2)
    pairs = {(u, m): float(rng.integers(1, 11)) / 2 for u in range(30) for m in range(60) if rng.random() < 0.3}
    pairs.update({(u, 59): 2.0 for u in range(30)})  # rated alike by everybody
    return spark.createDataFrame([(u, m, r) for (u, m), r in pairs.items()], "userId int, movieId int, rating double")


def test_correlation_matches_pandas(ratings):
    chosen = analytics.most_rated(ratings, 12)
    ids = sorted(r.movieId for r in chosen.collect())
    got = analytics.item_correlation(ratings, chosen).collect()
    wide = ratings.toPandas().pivot(index="userId", columns="movieId", values="rating").fillna(0)
    expected = wide[ids].corr()
    assert 59 in ids and len(got) == 12 * 11 // 2
    for r in got:
        theirs = expected.loc[r.movie_a, r.movie_b]
        if 59 in (r.movie_a, r.movie_b):
            assert r.correlation is None
        else:
            assert r.correlation == pytest.approx(theirs, abs=1e-9)
            assert r.n_common == int(((wide[r.movie_a] > 0) & (wide[r.movie_b] > 0)).sum())


def test_correlation_over_several_tiles(ratings, monkeypatch):
    items = ratings.select("movieId").distinct()
    plain = {(r.movie_a, r.movie_b): (r.n_common, r.correlation) for r in analytics.item_correlation(ratings, items).collect()}
    monkeypatch.setattr(analytics, "TILE", 13)
    monkeypatch.setattr(analytics, "USERS", 7)
    tiled = {(r.movie_a, r.movie_b): (r.n_common, r.correlation) for r in analytics.item_correlation(ratings, items).collect()}
    assert len(plain) == 60 * 59 // 2 and set(plain) == set(tiled)
    for pair, (n, value) in plain.items():
        assert tiled[pair][0] == n
        assert tiled[pair][1] == (None if value is None else pytest.approx(value, abs=1e-9))


def test_histogram_counts_before_it_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 1, 2, 3, 5, 5, 5)] + [(None,)], "v double")
    assert rows(analytics.histogram(df, "v", 4)) == [(1, 2), (2, 1), (3, 1), (4, 3)]


def test_tiles_are_the_pivot(ratings):
    wide = ratings.toPandas().pivot(index="userId", columns="movieId", values="rating").fillna(0)
    cells = {}
    for r in analytics.matrix_tiles(ratings, width=7).collect():
        for c in range(7):
            if r[f"c{c}"]:
                cells[r.userId, r.tile * 7 + c] = r[f"c{c}"]
    assert cells == {(u, m): v for u, row in wide.iterrows() for m, v in row.items() if v}


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "x int, y string")
    assert rows(analytics.column_profile(df)) == [("x", 3, 0, 2), ("y", 3, 1, 1)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.5, 1.0, 9.99, 10.0, None]], "v double")
    assert rows(analytics.histogram(df, "v", 10)) == [(1, 2), (10, 2), (2, 1)]
    same = spark.createDataFrame([(3,), (3,)], "v int")
    assert rows(analytics.histogram(same, "v", 5)) == [(1, 2)]


def test_reports_count_items_without_genre_and_never_recommended(spark):
    recs = spark.createDataFrame([(1, 10), (2, 10), (2, 11), (2, 12)], "userId int, movieId int")
    genres = spark.createDataFrame([(10, "A"), (10, "B"), (11, "A"), (13, "C")], "movieId int, genre_name string")
    assert rows(analytics.genre_popularity(recs, genres)) == [("A", 3), ("B", 2), ("C", 0), ("Unknown", 1)]
    assert rows(analytics.genre_diversity(recs, genres)) == [(1, 2), (2, 3)]
    movies = spark.createDataFrame([(10, 150), (11, 100), (12, None)], "movieId int, vote_count int")
    assert rows(analytics.popular_vs_unpopular(recs, movies)) == [(2, 1)]
    titles = spark.createDataFrame([(10, "x"), (11, None)], "movieId int, title string")
    assert rows(analytics.top_recommended(recs, titles), "movieId", "n_recs") == [(10, 2)]


def test_same_genre_lists(spark):
    movies = spark.createDataFrame(
        [(i, f"t{i}", "A" if i < 6 else "B", float(i % 4)) for i in range(8)] + [(8, "t8", None, 9.0)],
        "movieId int, title string, genre_name string, vote_average double")
    pdf = movies.toPandas()
    got = rows(recommend.same_genre(movies, 3), "movieId", "rank", "rec_id")
    expected = []
    for m, g in zip(pdf.movieId, pdf.genre_name):
        others = pdf[(pdf.genre_name == g) & (pdf.movieId != m)].sort_values(
            ["vote_average", "movieId"], ascending=[False, True])[:3]
        expected += [(m, r, o) for r, o in enumerate(others.movieId, 1)]
    assert got == sorted(expected, key=repr)
    assert [r.movieId for r in recommend.same_genre_as(movies, 3, 3).collect()] == [
        o for m, _, o in sorted(expected) if m == 3]


def test_blend_and_lists(spark):
    seeds = spark.createDataFrame([(1, 100), (2, 100), (3, 101)], "userId int, seed_id int")
    near = spark.createDataFrame([(100, 5, 0.8), (100, 6, 0.6)], "seed_id int, movieId int, similarity double")
    centred = spark.createDataFrame([(1, 6, 1.0), (1, 5, -1.0)], "userId int, movieId int, rating_norm double")
    got = rows(recommend.content_and_ratings(seeds, near, centred), "userId", "rank", "movieId", "score")
    assert got == [(1, 1, 6, 0.8), (1, 2, 5, -0.1), (2, 1, 5, 0.4), (2, 2, 6, 0.3)]
    packed = spark.createDataFrame([(1, [(5, 4.5), (6, 4.0)])],
                                   "userId int, recommendations array<struct<movieId:int,rating:double>>")
    assert rows(recommend.flatten(packed)) == [(1, 5, 4.5), (1, 6, 4.0)]


def test_matrix_tiles_are_made_in_tasks_of_bounded_size(spark, monkeypatch):
    """Thirty values a task at most on average, however few shuffle partitions the session has."""
    monkeypatch.setattr(analytics, "CELLS", 30)
    means = spark.range(900).select((F.col("id") % 30).alias("userId"), (F.col("id") * 7).alias("movieId"), (F.col("id") + 0.5).alias("rating"))
    tiles = analytics.matrix_tiles(means)
    sizes = tiles.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in sizes) == means.select("userId", F.floor(F.col("movieId") / 50)).distinct().count()
    assert len(sizes) > 20 and max(r[1] for r in sizes) < 90
    cells = {(r["userId"], r["tile"] * 50 + c): r[f"c{c}"] for r in tiles.collect() for c in range(50) if r[f"c{c}"]}
    assert cells == {(r.userId, r.movieId): r.rating for r in means.collect()}
