import math

from pyspark.sql import functions as F

from table_rows import rows
from tastegrid.functions import scores, scrub
from tastegrid.operators import credits, joins, keywords, links, movies, ranking, ratings


def test_number_scrubbing(spark):
    df = spark.createDataFrame([("$1,200",), ("",), (None,), ("pop 3.5",), ("1.2.3",)], "t string")
    got = df.select(scrub.whole_number("t"), scrub.decimal_number("t")).collect()
    assert [tuple(r) for r in got] == [(1200.0, 1200.0), (None, None), (None, None), (35.0, 3.5), (123.0, None)]


def test_literal_lists(spark):
    texts = [
        """[{'id': 1, 'name': "O'Neil"}, {'id': None, 'name': 'None, True'}]""",
        "[]", "no list", None, """[{"id": 2, "name": "json"}]""", """[{'id': 3, 'name': 'caf\\xe9'}]""",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "genres string").withColumn("id", F.monotonically_increasing_id())
    got = [r[0] for r in df.select(scrub.parse_list("genres", scrub.GENRE_TYPE)).collect()]
    assert [tuple(g) for g in got[0]] == [(1, "O'Neil"), (None, "None, True")]
    assert got[1] == [] and got[2] is None and got[3] is None
    assert [tuple(g) for g in got[4]] == [(2, "json")]
    assert got[5][0]["id"] == 3
    assert rows(movies.unparsed_lists(df, "genres", scrub.GENRE_TYPE), "genres") == [("no list",)]


def test_flags_are_never_null(spark):
    df = spark.createDataFrame([("True",), ("False",), (None,), ("x",)], "t string")
    assert [r[0] for r in df.select(scrub.is_true("t")).collect()] == [True, False, False, False]


def test_multi_hot_keeps_all_genres_and_movies_without(spark):
    df = spark.createDataFrame([
        (1, "[{'id': 1, 'name': 'Drama'}, {'id': 2, 'name': 'War'}]"), (2, "[{'id': 2, 'name': 'War'}]"), (3, "[]"),
        (4, None)], "id int, genres string")
    got = movies.genre_columns(df)
    assert got.columns == ["id", "Drama", "War"]
    assert rows(got) == [(1, 1, 1), (2, 0, 1), (3, 0, 0), (4, 0, 0)]
    assert rows(movies.first_genre(df), "id", "genre_name") == [(1, "Drama"), (2, "War"), (3, None), (4, None)]


def test_credits(spark):
    cast = credits.cast_rows(spark.createDataFrame([
        (1, "[{'name': 'zoe b', 'order': 1, 'gender': 1, 'character': None}, "
            "{'name': 'ADAM a', 'order': 0, 'gender': 2, 'character': 'x'}]"),
        (1, "[{'name': 'Adam A', 'order': 5, 'gender': 2, 'character': 'x'}, {'name': 'Bad', 'gender': -1}]"),
        (2, "[]"), (3, None)], "id int, cast string"))
    assert rows(cast, "cast_name", "cast_order") == [("Adam A", 0), ("Zoe B", 1)]
    assert rows(credits.cast_features(cast)) == [(1, 2, "Adam A", 1, 1)]
    assert rows(credits.leading_cast(cast, 1)) == [(1, ["Adam A"])]
    crew = spark.createDataFrame([
        (1, "[{'name': 'a', 'job': 'Director', 'department': 'Sound', 'gender': 1}, "
            "{'name': 'b', 'job': 'Editor', 'department': 'Art', 'gender': 2}]")], "id int, crew string")
    assert rows(credits.crew_features(credits.crew_rows(crew))) == [(1, 2, "Art", 1, 1)]
    assert rows(credits.directors(crew)) == [(1, "A")]


def test_keywords(spark):
    df = spark.createDataFrame(
        [(1, "['a', 'a ', 'Deep sea']"), (2, "[]"), (3, ""), (4, None), (5, "small, ring")], "id int, keywords string")
    assert rows(keywords.keyword_rows(df)) == [(1, "A"), (1, "Deep Sea"), (5, "Ring"), (5, "Small")]
    assert rows(keywords.keyword_rows(df.filter("id = 5"), strip_brackets=False)) == [(5, "Ring"), (5, "Small")]
    assert rows(keywords.keyword_lists(df.filter("id in (2, 5)"))) == [(5, "ring,small")]
    named = spark.createDataFrame([(1, "[{'id': 7, 'name': 'new york'}]")], "id int, keywords string")
    assert rows(keywords.keyword_names(named)) == [(1, "New York")]


def test_links(spark):
    schema = "movieId int, imdbId int, tmdbId double"
    small = spark.createDataFrame([(1, 10, 5.0), (2, 20, None), (5, 0, 3.0)], schema)
    full = spark.createDataFrame([(1, 10, 6.0), (2, 20, 7.0), (3, 30, 8.0), (4, 40, None)], schema)
    assert rows(links.clean_links(small, full), "movieId", "imdbId", "tmdbId", "combined_id") == [
        (1, "0000010", 5, "0000010_5"), (3, "0000030", 8, "0000030_8")]
    assert rows(links.merge_links(full, small)) == [(1, 10, 5), (2, 20, 7), (3, 30, 8), (5, 0, 3)]
    assert rows(links.merge_links(full, small, sentinel=True)) == [(1, 10, 5), (3, 30, 8), (5, 0, 3)]


def test_ratings_cleaning_and_latest(spark):
    df = spark.createDataFrame([
        (1, 1, 3.0, 86400), (1, 2, 5.5, 0), (1, 3, None, 0), (2, 1, 0.0, 0)],
        "userId int, movieId int, rating double, timestamp bigint")
    assert rows(ratings.clean_ratings(df).withColumn("rating_date", F.col("rating_date").cast("string"))) == [
        (1, 1, 3.0, "1970-01-02"), (2, 1, 0.0, "1970-01-01")]
    again = spark.createDataFrame([(1, 1, 2.0, 1), (1, 1, 4.0, 9), (1, 1, 1.0, 5)], df.schema)
    assert rows(ratings.latest_per_key(again, ["userId", "movieId"], ["timestamp"], ["rating"])) == [(1, 1, 4.0, 9)]
    assert ratings.merge_sources(again, again, again.columns).count() == 3


def test_holdout_and_splits(spark):
    df = spark.createDataFrame([(1, m, 3.0, m) for m in range(8)] + [(2, 1, 3.0, 1)],
                               "userId int, movieId int, rating double, ts bigint")
    held = ratings.holdout_last(df, 3, ["ts"])
    assert rows(held.filter("split = 'test'"), "userId", "movieId") == [(1, 5), (1, 6), (1, 7), (2, 1)]
    assert held.count() == df.count()
    train, test = ratings.random_split(df)
    assert train.count() + test.count() == df.count()


def test_derived_scores(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (30, 8.0, 10.0)], "v int, r double, m double")
    got = [r[0] for r in df.select(scores.shrunk_rating(F.col("v"), F.col("r"), F.col("m"))).collect()]
    assert got == [None, 30 / 40 * 8 + 10 / 40 * 7]
    years = spark.createDataFrame([(1999,), (2000,), (None,)], "y int")
    assert [r[0] for r in years.select(scores.decade(F.col("y"))).collect()] == [1990, 2000, None]


def test_unknown_ids(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    assert rows(joins.unknown_ids(facts, spark.createDataFrame([(2,)], "k int"), "k")) == [(1,), (3,)]


def test_literal_words_inside_names_stay(spark):
    df = spark.createDataFrame([
        (1, "[{'id': 1, 'name': 'Best of: None, Some'}, {'id': None, 'name': None}]"),
        (2, '[{\'id\': 2, \'name\': "It\'s: True"}]'),
        (3, "[{'id': 3, 'name': 'a \\' False'}]"),
        (4, "[{'id': 4, 'name': 'open"),
        (5, "[" + ", ".join(["{'id': None, 'name': 'True'}"] * 20000) + "]")], "id int, genres string")
    got = movies.genre_rows(df)
    assert {(r.id, r.genre_id, r.genre_name) for r in got.filter("id < 5").collect()} == {
        (1, 1, "Best of: None, Some"), (1, None, None), (2, 2, "It's: True"), (3, 3, "a ' False")}
    assert got.filter("id = 5 and genre_id is null and genre_name = 'True'").count() == 20000
    assert [r.id for r in movies.unparsed_lists(df, "genres", scrub.GENRE_TYPE).collect()] == [4]


def test_credit_order_beyond_int(spark):
    df = spark.createDataFrame([
        (1, "[{'cast_id': 5000000000, 'name': 'a', 'order': 4000000000}, {'name': 'b', 'order': 3000000000}]")],
        "id bigint, cast string")
    assert credits.cast_features(credits.cast_rows(df)).first().lead_actor == "B"


def test_many_genres(spark):
    names = [f"g{i:04d}" for i in range(1200)]
    df = spark.createDataFrame([(1, str([{"id": i, "name": n} for i, n in enumerate(names)])), (2, "[]")], "id int, genres string")
    wide = movies.genre_columns(df)
    assert wide.columns == ["id", *names]
    assert {r.id: sum(r[1:]) for r in wide.collect()} == {1: 1200, 2: 0}


def test_quantiles_are_exact(spark):
    values = [None] * 5 + [i * i % 977 for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    known = sorted(v for v in values if v is not None)
    got = ranking.quantiles(df, "v", [0.33, 0.66, 1.0]).first()[0]
    assert got == [known[math.ceil(3000 * p) - 1] for p in (0.33, 0.66, 1.0)]
    assert ranking.quantiles(df.filter("v < 0"), "v", [0.5]).first()[0] == [None]


def test_words_are_rewritten_outside_quotes_without_cutting_the_text(spark):
    """As a plain scan does it, with escapes, quotes that nothing closes, long texts; the plan builds no list of pieces."""
    import random
    import re

    piece = re.compile(r"""(?s)'[^'\\]*(?:\\.[^'\\]*)*'|"[^"\\]*(?:\\.[^"\\]*)*"|[^'"]+|['"]""")

    def plain(text):
        out = []
        for p in piece.findall(text):
            if p[0] not in "'\"":
                for word, value in (("None", "null"), ("True", "true"), ("False", "false")):
                    p = re.sub(rf"\b{word}\b", value, p)
            out.append(p)
        return "".join(out)

    parts = ["None", "True", "False", "'", '"', "\\", " ", ":", ",", "x", "N", "F1", "$1", "_", "\n", "['a': None]", "'it\\'s None'"]
    pick = random.Random(5)
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 14))) for _ in range(3000)]
    texts += ["[" + "{'name': 'None', 'character': None, \"a\": True}, " * 3000 + "]", "N" * 20000 + " None", "'" + "x N " * 9000 + "None"]
    found = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", scrub.literal_to_json("t").alias("j"))
    assert dict(map(tuple, found.collect())) == {i: plain(t) for i, t in enumerate(texts)}
    assert "regexp_extract_all" not in found._jdf.queryExecution().toString()
    assert spark.createDataFrame([(None,)], "t string").select(scrub.literal_to_json("t")).first()[0] is None
