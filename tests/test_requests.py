import pytest

from tastegrid.operators import factorize
from tastegrid.operators.text import tfidf
from tastegrid.plans import requests


@pytest.fixture(scope="module")
def movies(spark):
    return spark.createDataFrame(
        [(1, "one", "space ship war", "A", 1, 1999, 7.0, 200), (2, "two", "space ship", "A", 1, 2000, 6.0, 20),
         (3, "three", "love story", "B", 2, 2001, 5.0, 300), (4, "one", "love war", None, None, None, 4.0, None)],
        "movieId int, title string, text string, genre_name string, genre_id int, release_year int, "
        "vote_average double, vote_count int")


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(
        [(u, m, float((u * m) % 5 + 1), m * 1000) for u in range(1, 9) for m in range(1, 5) if (u + m) % 4],
        "userId int, movieId int, rating double, at bigint").selectExpr(
        "userId", "movieId", "rating", "timestamp_seconds(at) ts")


@pytest.fixture(scope="module")
def model(ratings):
    return factorize.fit_als(ratings, rank=2, iterations=3)


def test_similar_titles(movies):
    weights = tfidf(movies, "movieId", "text")
    got = sorted(requests.similar_movies(movies, weights, "one", 2).collect(), key=lambda r: -r.similarity)
    assert [r.movieId for r in got] == [2, 4]
    assert requests.similar_movies(movies, weights, "no such title").count() == 0


def test_hybrid_title(movies, ratings):
    weights = tfidf(movies, "movieId", "text")
    near = {r.movieId: r.similarity for r in requests.similar_movies(movies, weights, "one", 3).collect()}
    own = {r.movieId: r.rating for r in ratings.filter("userId = 2").collect()}
    mean = sum(own.values()) / len(own)
    got = {r.movieId: r.score for r in requests.hybrid_movies(movies, weights, ratings, 2, "one", 3).collect()}
    assert got == pytest.approx({m: 0.5 * s + 0.5 * (own[m] - mean if m in own else 0) for m, s in near.items()})
    assert requests.hybrid_movies(movies, weights, ratings, 4711, "one").count() == 0


def test_lists_of_one_user(movies, ratings, model):
    listed = requests.als_movies(model, movies, 3, 4).collect()
    assert len(listed) == 4 and {r.genre_name for r in listed if r.movieId == 4} == {"Unknown"}
    unseen = requests.als_movies(model, movies, 3, 4, seen=ratings).collect()
    rated = {r.movieId for r in ratings.filter("userId = 3").collect()}
    assert {r.movieId for r in unseen} == {1, 2, 3, 4} - rated
    collaborative, content = requests.hybrid_lists(model, movies, 3, 1, 2)
    assert collaborative.count() == 2 and [r.movieId for r in content.collect()] == [2]
    popular = requests.advanced_movies(model, movies, ratings, 3, as_of=10_000, genre="A", min_votes=100, n=4).collect()
    assert [r.movieId for r in popular] == [1] and popular[0].decayed_score > 0


def test_completed_matrix_of_one_user(ratings):
    svd = factorize.truncated_svd(ratings, k=2)
    every = {(r.userId, r["rank"]): r.movieId for r in factorize.svd_predictions(svd, 3, ratings).collect()}
    one = {(r.userId, r["rank"]): r.movieId for r in requests.svd_movies(svd, ratings, 5, 3).collect()}
    assert one and one == {k: v for k, v in every.items() if k[0] == 5}


def test_hybrid_title_makes_the_ratings_once(spark, movies, ratings):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    weights = tfidf(movies, "movieId", "text")
    got = requests.hybrid_movies(movies, weights, ratings.coalesce(1).mapInArrow(seen, ratings.schema), 2, "one", 3).collect()
    assert len(got) == 3 and made.value == ratings.count()
