"""One movie with a third of all ratings."""

from __future__ import annotations

from frames import physical_plan
from pyspark.sql import functions as F

from marquee.operators import join_ratings_movies
from marquee.plans.reports import movie_report, user_profile, wide_rollup


def hot_tables(spark, n=120_000):
    ratings = spark.range(0, n, 1, 8).selectExpr(
        "id % 997 AS userid",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 500 END AS movieid",
        "CAST(id % 10 + 1 AS DOUBLE) / 2 AS rating",
    )
    movies = spark.range(500).selectExpr(
        "id AS movieid",
        "concat('m', id % 40) AS title",
        "CAST(1990 + id % 25 AS STRING) AS release_year",
        "CAST(id % 9 AS DOUBLE) AS vote_average",
        "CAST(id AS DOUBLE) AS popularity",
        "'g' AS genres",
        "'en' AS language",
        "'c' AS production_companies",
    )
    return ratings, movies


def test_adaptive_execution_splits_the_hot_movie(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    ratings, movies = hot_tables(spark)
    merged = join_ratings_movies(ratings, movies, broadcast_limit=0)
    total = merged.groupBy("movieid").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.movieid: r.n for r in total.collect()}
    assert counts[1] > 40_000 and sum(counts.values()) == ratings.count()
    grouped = merged.groupBy("userid").agg(F.sum("rating").alias("s"))
    grouped.collect()
    assert "SortMergeJoin(skew=true)" in physical_plan(grouped)


def test_reports_are_whole_under_skew(spark):
    ratings, movies = hot_tables(spark)
    small = join_ratings_movies(ratings, movies)
    large = join_ratings_movies(ratings, movies, broadcast_limit=0)
    for frame in (small, large):
        found = movie_report("count_by_language", wide_rollup(frame)).collect()
        assert [tuple(r) for r in found] == [("en", 120_000)]
    assert sorted(map(tuple, user_profile(small).collect())) == sorted(map(tuple, user_profile(large).collect()))
