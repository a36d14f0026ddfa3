"""Partitioned and bucketed sinks."""

from table_rows import rows
from tastegrid.operators import ratings
from tastegrid.sources import files


def table(spark, days):
    return spark.createDataFrame([(d, u, float(u % 5)) for d in days for u in range(20)], "day int, userId bigint, rating double")


def test_a_rerun_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "ratings")
    files.replace_partitions(table(spark, [1, 2, 3]), path, ["day"])
    again = table(spark, [2]).withColumnRenamed("rating", "r").selectExpr("day", "userId", "r + 10 as rating")
    files.replace_partitions(again, path, ["day"])
    found = spark.read.parquet(path)
    assert rows(found, "day", "userId", "rating") == rows(table(spark, [1, 3]).unionByName(again), "day", "userId", "rating")


def test_bucketed_ratings_need_no_exchange(spark):
    name = "bucketed_ratings_test"
    try:
        data = table(spark, [1, 2, 3]).selectExpr("userId", "day as movieId", "rating")
        stored = files.store_bucketed(data, name, ["userId"], 4)
        profile = stored.groupBy("userId").avg("rating").withColumnRenamed("avg(rating)", "user_avg_rating")
        joined = stored.hint("merge").join(profile, "userId")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(joined, "userId", "movieId", "rating", "user_avg_rating") == rows(
            data.join(data.groupBy("userId").agg({"rating": "avg"}), "userId"), "userId", "movieId", "rating", "avg(rating)")
        # The library's own profile join broadcasts a small profile and moves no rating either.
        assert "hashpartitioning" not in ratings.mean_centered(stored)._jdf.queryExecution().executedPlan().toString()
        files.store_bucketed(data.limit(5), name, ["userId"], 4)
        assert spark.table(name).count() == 5
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
