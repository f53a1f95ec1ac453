from __future__ import annotations

import math

from frames import physical_plan, rows
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from marquee.operators import (
    any_rows,
    append_rows,
    drop_null_aggregates,
    key_split,
    next_user_id,
    one_rating_per_pair,
    random_split,
    ranked_top_k,
    rmse,
    search_titles,
    top_k,
    top_k_per_group,
    with_listed_ids,
    without_listed_ids,
)
from marquee.operators.ranking import rounds_of_parts
from marquee.operators.sizing import broadcast_if_small, stored_bytes
from marquee.registry import domain


def movies(spark):
    return spark.createDataFrame(
        [(1, "Toy Story (1995)", "Children's"), (2, "toy soldiers", "Drama"), (3, None, "War"), (4, "Heat", None)],
        "movieid bigint, title string, genres string",
    )


def test_search_and_membership(spark):
    found = search_titles(movies(spark), "TOY")
    assert rows(found) == [(1, "Toy Story (1995)"), (2, "toy soldiers")]
    assert [r[0] for r in rows(with_listed_ids(movies(spark), found))] == [1, 2]
    assert [r[0] for r in rows(without_listed_ids(movies(spark), found))] == [3, 4]
    nothing = search_titles(movies(spark), "none like it")
    assert without_listed_ids(movies(spark), nothing).count() == 4
    assert rows(any_rows(found)) == [(True,)] and rows(any_rows(nothing)) == [(False,)]


def test_new_user_id(spark):
    assert rows(next_user_id(spark.createDataFrame([(3,), (None,), (7,)], "userid bigint"))) == [(8,)]


def test_ties_go_to_the_smaller_movie_id(spark):
    frame = spark.createDataFrame(
        [("a", 5, 1.0), ("a", 2, 1.0), ("a", 9, 3.0), ("b", 1, 0.5)], "g string, movieid bigint, score double"
    )
    assert [r.movieid for r in top_k(frame, 2, "score").collect()] == [9, 2]
    assert rows(ranked_top_k(frame, 3, "score").select("rank", "movieid")) == [(1, 9), (2, 2), (3, 5)]
    assert rows(top_k_per_group(frame, 2, "g", "score").select("g", "rank", "movieid")) == [
        ("a", 1, 9),
        ("a", 2, 2),
        ("b", 1, 1),
    ]


def test_rmse(spark):
    frame = spark.createDataFrame([(1.0, 2.0, 3), (4.0, 4.5, 1), (2.0, None, 5)], "rating double, prediction double, n int")
    whole = frame.dropna()
    assert math.isclose(rmse(whole).first().rmse, math.sqrt((1 + 0.25) / 2))
    assert math.isclose(rmse(whole, weight="n").first().rmse, math.sqrt((3 + 0.25) / 4))
    evaluator = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    assert math.isclose(rmse(whole).first().rmse, evaluator.evaluate(whole))
    assert rmse(frame.limit(0)).first().rmse is None


def test_append_matches_columns_by_name(spark):
    left = spark.createDataFrame([(1, 2, 3.0)], "userid bigint, movieid bigint, rating double")
    right = spark.createDataFrame([(5.0, 8, 9)], "rating double, movieid bigint, userid bigint")
    both = append_rows(left, right)
    assert both.columns == left.columns and rows(both) == [(1, 2, 3.0), (9, 8, 5.0)]


def test_repeated_pairs_average(spark):
    frame = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0), (2, 1, 5.0)], "userid bigint, movieid bigint, rating double")
    assert rows(one_rating_per_pair(frame)) == [(1, 1, 3.0), (2, 1, 5.0)]


def whole(parts):
    together = parts[0]
    for part in parts[1:]:
        together = together.union(part)
    return together


def test_splits_are_disjoint_complete_and_repeatable(spark, sf_dir):
    ratings = domain.ratings(spark, sf_dir)
    total = ratings.count()
    for parts in (random_split(ratings), key_split(ratings)):
        assert rows(whole(parts)) == rows(ratings)
        assert sum(p.select("userid", "movieid").distinct().count() for p in parts) == (
            ratings.select("userid", "movieid").distinct().count()
        )
    # The draw does not depend on how the rows are laid out.
    again = random_split(ratings.repartition(5, F.rand()))
    assert [rows(p) for p in random_split(ratings)] == [rows(p) for p in again]
    assert rows(random_split(ratings, seed=1)[0]) != rows(random_split(ratings, seed=2)[0])
    shares = [p.count() / total for p in random_split(ratings, weights=(6, 2, 2))]
    assert all(abs(a - b) < 0.03 for a, b in zip(shares, (0.6, 0.2, 0.2)))
    assert len(random_split(ratings, weights=(1.0,))) == 1


def test_broadcast_only_below_the_measured_size(spark):
    frame = spark.createDataFrame([(1, "abc"), (2, None)], "k bigint, t string")
    size = stored_bytes(frame)
    assert size == 2 * (32 + 16) + 3
    hinted = "ResolvedHint (strategy=broadcast)"
    assert hinted in broadcast_if_small(frame, size)._jdf.queryExecution().analyzed().toString()
    assert hinted not in broadcast_if_small(frame, size - 1)._jdf.queryExecution().analyzed().toString()
    assert stored_bytes(frame.limit(0)) == 0


def test_nan_groups_are_values(spark):
    frame = spark.createDataFrame([("a", float("nan")), ("b", 1.0), ("c", None)], "g string, m double")
    assert {r.g for r in drop_null_aggregates(frame, ["m"]).collect()} == {"a", "b"}


def test_null_keys_are_in_no_list(spark):
    frame = spark.createDataFrame([(1, "x"), (None, "y"), (2, "z")], "movieid long, t string")
    ids = spark.createDataFrame([(1,), (None,)], "movieid long")
    assert [r.t for r in without_listed_ids(frame, ids).collect()] == ["z"]


def test_rmse_leaves_missing_labels_out(spark):
    frame = spark.createDataFrame([(1.0, 2.0, 1), (None, 2.0, 3), (3.0, None, 2)], "rating double, prediction double, w int")
    assert rmse(frame).first().rmse == 1.0 and rmse(frame, weight="w").first().rmse == 1.0


def test_many_per_group(spark):
    frame = spark.range(5000).select(F.lit("g").alias("g"), F.col("id").alias("movieid"), (F.col("id") % 7).alias("s"))
    found = top_k_per_group(frame, 1001, "g", "s").orderBy("rank").collect()
    want = sorted(((i % 7, i) for i in range(5000)), key=lambda p: (-p[0], p[1]))[:1001]
    assert [(r.s, r.movieid) for r in found] == want and [r["rank"] for r in found] == list(range(1, 1002))


def test_measured_bytes_see_every_type(spark):
    frame = spark.range(10).select(
        F.sequence(F.lit(1), F.lit(20000)).alias("a"), F.create_map(F.lit("k"), F.repeat(F.lit("v"), 9000)).alias("m"),
        F.struct(F.repeat(F.lit("x"), 7000).alias("f")).alias("s"), F.repeat(F.lit("b"), 5000).cast("binary").alias("b"),
    )
    assert stored_bytes(frame) > 10 * (20000 * 4 + 9000 + 7000 + 5000)


def test_one_group_far_beyond_a_task(spark):
    # 20,000 rows where a task ranks 50: over 64 times as many, and two rounds are needed.
    frame = spark.range(20_000).select(
        F.when(F.col("id") < 5, F.lit("small")).otherwise(F.lit("hot")).alias("g"),
        F.col("id").alias("movieid"),
        (F.col("id") * 7919 % 997).alias("s"),
    )
    assert rounds_of_parts(19_995, 3, 50) == [400, 24, 2]
    found = top_k_per_group(frame, 3, "g", "s", task_rows=50)
    assert "hash" in physical_plan(found)
    for g, ids in (("small", range(5)), ("hot", range(5, 20_000))):
        want = sorted((-(i * 7919 % 997), i) for i in ids)[:3]
        assert [(-r.s, r.movieid) for r in found.filter(F.col("g") == g).orderBy("rank").collect()] == want


def test_rounds_of_parts():
    assert rounds_of_parts(0, 10, 100) == rounds_of_parts(100, 10, 100) == []
    assert rounds_of_parts(1000, 100, 100) == []  # nothing would be cut away
    assert rounds_of_parts(10**9, 10, 10**6) == [1000]
    assert rounds_of_parts(10**12, 10, 10**6) == [10**6, 10]
