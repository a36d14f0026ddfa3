"""Shapes of the physical plans: skew handling, pushdown, no row-at-a-time Python, no pairing of tables."""

import pytest
from pyspark.sql import functions as F

from tastegrid.operators import joins, ratings
from tastegrid.plans import catalog
from tastegrid.session import materialize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("salts", [1, 4])
def test_adaptive_execution_splits_a_hot_key(spark, salts):
    """A key with most of the rows, joined with an aggregate over that key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 60000, 1, 12).select(
            F.when(F.col("id") % 10 < 9, F.lit(7)).otherwise(F.col("id")).cast("int").alias("userId"),
            F.col("id").cast("int").alias("movieId"), (F.col("id") % 10 / 2).alias("rating"))
        stats = ratings.profile(facts, "userId", "user")
        joined = joins.salted_join(facts, stats, ["userId"], "left", spread_by=["movieId"], salts=salts)
        # At the size of this test the salts alone can balance the partitions.
        assert joined.count() == 60000
        joined.select("movieId", "user_rating_count").write.format("noop").mode("overwrite").save()
        collected = joined.select("userId", "user_rating_count").filter("userId = 7").distinct()
        assert [tuple(r) for r in collected.collect()] == [(7, 54000)]
        if salts == 1:
            result = joined.select("movieId", "user_rating_count")
            result.collect()
            assert "skew=true" in plan(result)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_the_join(spark, how):
    facts = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 5), (None, 6)], "k int, v int")
    lookup = spark.createDataFrame([(1, "a"), (3, "c")], "k int, n string")
    plain = sorted(map(repr, facts.join(lookup, "k", how).select("k", "v", "n").collect()))
    salted = joins.salted_join(facts, lookup, ["k"], how, spread_by=["v"])
    assert sorted(map(repr, salted.select("k", "v", "n").collect())) == plain


def test_a_table_larger_in_memory_than_in_its_files_is_not_broadcast(spark):
    """100,000 sorted ids take less than the limit as a file, and some 3 MB as rows that a salted join repeats."""
    lookup = materialize(spark.range(100000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("n")))
    facts = materialize(spark.range(200000).select((F.col("id") % 100000).alias("k"), F.col("id").alias("v")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1500000")
        spark.conf.set(adaptive, "1500000")
        joined = joins.salted_join(facts, lookup, ["k"], "inner", spread_by=["v"])
        joined.collect()
        assert "BroadcastHashJoin" not in plan(joined)
        assert joined.count() == 200000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset(adaptive)


SQL_QUERIES = ["ratings_enriched", "mean_centered", "tfidf_weights", "popular_unseen_topk", "metric_curve", "same_genre",
               "hybrid_union", "advanced_recs", "genre_diversity", "cast_features", "crew_features", "links_clean"]


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_no_python_rows_and_no_cartesian_product(spark, sf_dir, name):
    text = plan(catalog.registered()[name](spark, sf_dir))
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
        assert unwanted not in text


def test_scans_are_pruned_and_filtered(spark, sf_dir):
    domain = catalog.Domain(spark, sf_dir)
    text = domain.ratings_small._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)" in text
    scans = [line for line in text.splitlines() if "ReadSchema" in line and "l_orderkey" in line]
    assert scans and all("l_extendedprice" not in s and "l_returnflag" not in s for s in scans)


def test_ranking_is_limited_before_the_shuffle(spark, sf_dir):
    text = plan(ratings.holdout_last(catalog.Domain(spark, sf_dir).ratings, 5, ["ts", "ok", "ln"]))
    assert "WindowGroupLimit" in text


def test_deduplication_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 2.0, 3)], "userId int, movieId int, rating double, ts bigint")
    text = plan(ratings.latest_per_key(df, ["userId", "movieId"], ["ts"], ["rating"]))
    assert "partial_max" in text and "Window" not in text


@pytest.mark.parametrize("name", ["genre_rows", "company_rows", "country_rows", "language_rows"])
def test_nested_lists_do_not_read_ratings(spark, sf_dir, name):
    text = plan(catalog.registered()[name](spark, sf_dir))
    assert "part.parquet" in text and "lineitem.parquet" not in text and "orders.parquet" not in text
