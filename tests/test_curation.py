from __future__ import annotations

from frames import rows

from marquee.operators import join_links, join_movie_data, join_ratings_movies
from marquee.plans.curation import movie_repo, movie_tags, sorted_movie_tags, tag_bundle
from marquee.schemas import MOVIE_REPO_COLUMNS


def tables(spark):
    ratings = spark.createDataFrame(
        [(1, 10, 4.0), (2, 10, 3.5), (1, 11, 5.0), (1, 12, 1.0), (3, 99, 2.0), (None, 10, 0.5)],
        "userid bigint, movieid bigint, rating double",
    )
    movies = spark.createDataFrame(
        [(10, "Heat (1995)", "Crime"), (11, "No Year", "Drama"), (12, "Gone (2001)", "War")],
        "movieid bigint, title string, genres string",
    )
    links = spark.createDataFrame(
        [(10, 1, 100), (11, 2, 101), (12, 3, None)], "movieid bigint, imdbid bigint, tmdbid bigint"
    )
    data = spark.createDataFrame(
        [(100, "en", "p", 1.5, "/a", "Co", "k", 7.0), (101, None, None, None, None, None, None, None)],
        "id bigint, language string, plot string, popularity double, poster string, "
        "production_companies string, keywords string, vote_average double",
    )
    return ratings, movies, links, data


def test_movie_repo(spark):
    repo = movie_repo(*tables(spark))
    assert repo.columns == MOVIE_REPO_COLUMNS
    assert rows(repo.select("userid", "movieid", "rating", "title", "release_year", "tmdbid", "language")) == [
        (1, 10, 4.0, "Heat ", "1995", 100, "en"),
        (1, 11, 5.0, None, None, 101, None),
        (2, 10, 3.5, "Heat ", "1995", 100, "en"),
        (None, 10, 0.5, "Heat ", "1995", 100, "en"),
    ]


def test_dimensions_first_equals_ratings_first(spark):
    ratings, movies, links, data = tables(spark)
    # Repeated dimension rows must multiply the ratings either way.
    movies = movies.union(movies.filter("movieid = 10"))
    first = join_ratings_movies(ratings, join_movie_data(join_links(movies, links), data))
    last = join_movie_data(join_links(join_ratings_movies(ratings, movies), links), data).select(first.columns)
    assert rows(first) == rows(last) and first.count() == 7


def test_tag_arrays_stay_aligned(spark):
    scores = spark.createDataFrame(
        [(1, 2, 0.5), (1, 1, None), (1, 2, 0.5), (2, 3, 0.1), (1, 2, 0.25), (3, 9, 1.0)],
        "movieid bigint, tagid bigint, relevance double",
    )
    tags = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (2, "b")], "tagid bigint, tag string")
    assert movie_tags(scores, tags).count() == 4
    assert [tuple(r) for r in sorted_movie_tags(scores, tags).collect()] == [
        (1, 1, None, "a"),
        (1, 2, 0.25, "b"),
        (1, 2, 0.5, "b"),
        (2, 3, 0.1, "c"),
    ]
    bundle = tag_bundle(scores, tags)
    assert bundle.columns == ["movieid", "relevance", "tag", "tagid"]
    assert rows(bundle) == [
        (1, [None, 0.25, 0.5], ["a", "b", "b"], [1, 2, 2]),
        (2, [0.1], ["c"], [3]),
    ]
