from __future__ import annotations

import pytest
from frames import rows
from pyspark.sql import functions as F

from marquee.operators import next_user_id, search_titles
from marquee.plans import recommend
from marquee.plans.recommend import SHELVES, AlsSettings
from marquee.registry import domain

SMALL = AlsSettings(rank=6, max_iter=3)
KEYWORD = "blue"


@pytest.fixture(scope="module")
def ratings(spark, sf_dir):
    return domain.ratings(spark, sf_dir)


@pytest.fixture(scope="module")
def movies(spark, sf_dir):
    return domain.movies(spark, sf_dir)


@pytest.fixture(scope="module")
def scored(spark, ratings, movies):
    return recommend.infer(ratings, movies, KEYWORD, 10, SMALL)


@pytest.fixture(scope="module")
def model(ratings):
    return recommend.fit(ratings, SMALL)


def test_ratings_are_averaged_once_for_fit_and_predictions(spark, sf_dir):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    given = domain.ratings(spark, sf_dir)
    watched = given.mapInArrow(counted, given.schema)
    _, found = recommend.fit_and_predict(watched, AlsSettings(rank=2, max_iter=2))
    assert read.value == given.count()
    assert found.count() == given.select("userid", "movieid").distinct().count()


def test_synthetic_user_and_candidates(spark, ratings, movies):
    seeds = search_titles(movies, KEYWORD)
    new_id = next_user_id(ratings).first()[0]
    liked = rows(recommend.synthetic_ratings(ratings, seeds))
    assert {r[0] for r in liked} == {new_id} and {r[2] for r in liked} == {5.0}
    unseen = rows(recommend.candidate_pairs(movies, seeds, F.lit(new_id)))
    assert len(liked) + len(unseen) == movies.count()
    assert not {r[1] for r in liked} & {r[1] for r in unseen}


def test_no_seed_leaves_every_movie_a_candidate(spark, movies):
    nothing = movies.limit(0)
    assert recommend.candidate_pairs(movies, nothing, F.lit(7)).count() == movies.count()


def test_scores_equal_the_models_own(spark, ratings, movies, model):
    userid = ratings.agg(F.max("userid")).first()[0]
    mine = {r.movieid: r.prediction for r in recommend.score_movies(model, userid, movies).collect()}
    pairs = movies.select(F.lit(userid).alias("userid"), "movieid")
    theirs = {r.movieid: r.prediction for r in recommend.predict(model, pairs).collect()}
    assert mine.keys() == theirs.keys()
    assert all(mine[k] == pytest.approx(theirs[k], rel=1e-5) for k in mine)


def test_unknown_user_scores_nothing(movies, model):
    assert recommend.score_movies(model, 10**9, movies).count() == 0


def test_cold_start_pairs_drop(spark, model):
    pairs = spark.createDataFrame([(1_000_000, 1), (1, 1_000_000)], "userid int, movieid int")
    assert recommend.predict(model, pairs).count() == 0


def test_inference_contract(ratings, movies, scored):
    found = scored.orderBy(F.desc("prediction"), "movieid").collect()
    seeds = {r.movieid for r in search_titles(movies, KEYWORD).collect()}
    assert len(found) == 100 and len({r.movieid for r in found}) == 100
    assert not {r.movieid for r in found} & seeds
    given = [r for r in ratings.agg(F.max("userid"), F.count(F.lit(1))).collect()]
    recommend.infer(ratings, movies, KEYWORD, 2, SMALL)
    assert ratings.agg(F.max("userid"), F.count(F.lit(1))).collect() == given  # they gain no user
    worst = min(r.prediction for r in found)
    rest = recommend.infer(ratings, movies, KEYWORD, 1000, SMALL).filter(F.col("prediction") > worst)
    assert rest.count() == sum(r.prediction > worst for r in found)


def test_same_seed_same_result(ratings, movies, scored):
    again = recommend.infer(ratings, movies, KEYWORD, 10, SMALL)
    assert {r.movieid for r in again.collect()} == {r.movieid for r in scored.collect()}


@pytest.mark.parametrize("keyword", ["", "no title like this"])
def test_nothing_to_recommend_from(ratings, movies, keyword):
    found = recommend.infer(ratings, movies, keyword, 10, SMALL)
    assert found.dtypes == [("movieid", "bigint"), ("prediction", "float")] and found.isEmpty()
    assert recommend.recommended_titles(found, movies).isEmpty()
    assert recommend.genre_shelves(found, movies).isEmpty()


def test_titles_carry_their_own_scores(movies, scored):
    best = [tuple(r) for r in recommend.recommended_titles(scored, movies, 10).orderBy("rank").collect()]
    title = {r.movieid: r.title for r in movies.collect()}
    want = sorted(scored.collect(), key=lambda r: (-r.prediction, r.movieid))[:10]
    assert best == [(i, r.movieid, title[r.movieid], r.prediction) for i, r in enumerate(want, 1)]


def test_shelves_against_loops(movies, scored):
    info = {r.movieid: r for r in movies.collect()}
    order = sorted(scored.collect(), key=lambda r: (-r.prediction, r.movieid))
    want = [
        (shelf, rank, r.movieid, info[r.movieid].title, r.prediction)
        for shelf, genre in SHELVES.items()
        for rank, r in enumerate([r for r in order if genre in info[r.movieid].genres][:4], 1)
    ]
    got = [tuple(r) for r in recommend.genre_shelves(scored, movies, 4).collect()]
    assert sorted(got) == sorted(want)


def test_shelf_ties_and_genre_variants(spark):
    movies = spark.createDataFrame(
        [(1, "a", "Children's|Comedy"), (2, "b", "Children"), (3, "c", "Sci-Fi"), (4, "d", "(no genres listed)")],
        "movieid bigint, title string, genres string",
    )
    scored = movies.select("movieid", F.lit(1.0).cast("float").alias("prediction"))
    assert rows(recommend.genre_shelves(scored, movies).select("shelf", "rank", "movieid")) == [
        ("Children", 1, 1),
        ("Children", 2, 2),
        ("Comedy", 1, 1),
        ("Science Fiction", 1, 3),
    ]


def test_fit_leaves_out_incomplete_rows(spark):
    good = spark.createDataFrame(
        [(u, m, 3.0) for u in (1, 2) for m in (1, 2)], "userid bigint, movieid bigint, rating double"
    )
    bad = spark.createDataFrame([(None, 1, 1.0), (7, None, 1.0), (8, 1, None)], good.schema)
    model = recommend.fit(good.union(bad), AlsSettings(rank=2, max_iter=1, blocks=1))
    assert {r.id for r in model.userFactors.collect()} == {1, 2}


def test_fit_treats_repeats_as_their_average(spark):
    once = spark.createDataFrame(
        [(u, m, float((u * m) % 5 + 1)) for u in range(1, 9) for m in range(1, 7)],
        "userid bigint, movieid bigint, rating double",
    )
    settings = AlsSettings(rank=3, max_iter=2, blocks=2)
    factors = [
        {r.id: list(r.features) for r in recommend.fit(data, settings).itemFactors.collect()}
        for data in (once, once.union(once))
    ]
    assert factors[0].keys() == factors[1].keys()
    for key in factors[0]:
        assert factors[0][key] == pytest.approx(factors[1][key], rel=1e-3, abs=1e-4)


def test_blocks_are_a_setting_not_the_cluster(monkeypatch):
    """Start factors are drawn by block, so the number must be the same on any cluster."""
    assert recommend.estimator(AlsSettings()).getNumUserBlocks() == AlsSettings.blocks
    assert recommend.estimator(AlsSettings(blocks=3)).getNumItemBlocks() == 3


def test_same_factors_for_any_parallelism(spark, ratings, conf):
    first = recommend.fit(ratings, SMALL).itemFactors.orderBy("id").collect()
    conf(spark__sql__shuffle__partitions="3")
    again = recommend.fit(ratings.repartition(5), SMALL).itemFactors.orderBy("id").collect()
    for a, b in zip(first, again, strict=True):
        assert a.id == b.id and all(abs(x - y) < 1e-3 for x, y in zip(a.features, b.features))


def test_pairs_without_ids_get_no_prediction(spark, model):
    pairs = spark.createDataFrame([(None, 1), (1, None), (None, None)], "userid long, movieid long")
    assert recommend.predict(model, pairs).count() == 0
