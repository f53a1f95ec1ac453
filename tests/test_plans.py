"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from frames import physical_plan
from pyspark.sql import functions as F

from marquee.operators import join_ratings_movies, top_k, top_k_per_group
from marquee.plans.recommend import shelf_rows
from marquee.plans.reports import MOVIE_REPORTS, movie_report, movie_rollup, star_user_profile, user_profile
from marquee.registry import all_queries, domain

LAZY = [
    name
    for name in all_queries()
    if not re.match("als_|recommend_|genre_shelves|sink_|scan_|reports_from", name)
]


@pytest.mark.parametrize("name", sorted(LAZY))
def test_no_cross_join_and_no_python_rows(name, spark, sf_dir):
    plan = physical_plan(all_queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert ("ArrowEvalPython" in plan) == (name == "parse_title_year_udf")


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = physical_plan(all_queries()["count_by_language"](spark, sf_dir))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan
    assert not re.search("p_type|p_retailprice|p_size|l_extendedprice", plan)


def test_key_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "repo")
    spark.createDataFrame([("a", 1.0)], "production_companies string, rating double").write.parquet(path)
    from marquee.operators import drop_null_keys

    plan = physical_plan(drop_null_keys(spark.read.parquet(path), "production_companies"))
    assert "PushedFilters: [IsNotNull(production_companies)]" in plan


def test_movie_reports_never_shuffle_rating_rows(spark, sf_dir, conf):
    """Even with no broadcast at all, ratings are added up per movie before they move."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    ratings = spark.range(100).selectExpr("id AS userid", "id % 7 AS movieid", "1.0D AS rating")
    rollup = movie_rollup(ratings, domain.attributes(spark, sf_dir))
    for name in MOVIE_REPORTS:
        plan = physical_plan(movie_report(name, rollup))
        below = plan[plan.index("Range (0, 100") - 600 : plan.index("Range (0, 100")]
        assert below.rindex("partial_count(1)") > below.rindex("Exchange hashpartitioning(movieid")


def test_user_profile_hashes_and_does_not_sort_ratings(spark, sf_dir):
    ratings, attributes = domain.ratings(spark, sf_dir), domain.attributes(spark, sf_dir)
    for profile in (star_user_profile(ratings, attributes), user_profile(join_ratings_movies(ratings, attributes))):
        plan = physical_plan(profile)
        fact = plan[plan.index("HashAggregate(keys=[userid") :]
        assert "Sort" not in fact and "BroadcastHashJoin" in fact
    # A dimension over the limit: the ratings are sorted and merged instead.
    merged = star_user_profile(ratings, attributes, broadcast_limit=0)
    assert re.search(r"SortMergeJoin \[movieid", physical_plan(merged))


def test_top_k_cuts_before_the_shuffle(spark, sf_dir):
    movies = domain.movies(spark, sf_dir).withColumn("score", F.col("movieid") * 1.0)
    assert "TakeOrderedAndProject(limit=5" in physical_plan(top_k(movies, 5, "score"))
    plan = physical_plan(top_k_per_group(shelf_rows(movies), 5, "shelf", "score"))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
