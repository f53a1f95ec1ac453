from __future__ import annotations

import math

import pytest
from frames import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.operators import drop_null_aggregates, drop_null_keys
from marquee.plans.reports import (
    FEEDS,
    MOVIE_REPORTS,
    PUBLISHED_HEADERS,
    REPORTS,
    all_reports,
    chart_feeds,
    movie_report,
    movie_rollup,
    star_user_profile,
    user_profile,
    wide_rollup,
    with_published_headers,
)
from marquee.registry import domain
from marquee.schemas import MOVIE_REPO

COLUMNS = (
    "userid bigint, movieid bigint, genres string, language string, popularity double, "
    "production_companies string, rating double, release_year string, title string, vote_average double"
)


def brute_force(name, data):
    """Any report by plain Python loops over rating rows."""
    report = REPORTS[name]
    groups = {}
    for row in data:
        if row[report.key] is not None:
            groups.setdefault(row[report.key], []).append(row)

    def mean(group, column):
        found = [r[column] for r in group if r[column] is not None]
        return math.fsum(found) / len(found) if found else None

    def largest(group, column):
        return max((r[column] for r in group if r[column] is not None), default=None)

    out = {}
    for key, group in groups.items():
        if name.startswith("count_"):
            column = {"title_count": "title", "language_count": "language", "production_count": "production_companies"}
            counted = column[next(iter(report.aggregates))]
            out[key] = (sum(r[counted] is not None for r in group),)
            continue
        values = [mean(group, c) for c in ("rating", "vote_average", "popularity")] + [largest(group, "release_year")]
        if name == "profile_production":
            values.append(largest(group, "userid"))
        if None not in values:
            out[key] = tuple(values)
    return out


def close(got, want):
    assert got.keys() == want.keys()
    for key in got:
        for a, b in zip(got[key], want[key], strict=True):
            assert math.isclose(a, b, rel_tol=1e-12) if isinstance(a, float) else a == b


def by_key(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


maybe = lambda strategy: st.one_of(st.none(), strategy)
# A movie may carry different attributes on different ratings: the table is read as it is.
row = st.fixed_dictionaries(
    {
        "userid": maybe(st.integers(1, 4)),
        "movieid": maybe(st.integers(1, 3)),
        "genres": maybe(st.sampled_from(["Drama", "Comedy|Drama"])),
        "language": maybe(st.sampled_from(["en", "fr"])),
        "popularity": maybe(st.sampled_from([0.5, 7.25])),
        "production_companies": maybe(st.sampled_from(["A", "B"])),
        "rating": maybe(st.sampled_from([0.5, 3.0, 5.0])),
        "release_year": maybe(st.sampled_from(["1995", "0999", "2012", "7.3", "oe, U", "199", "20121", ""])),
        "title": maybe(st.sampled_from(["x", "y "])),
        "vote_average": maybe(st.sampled_from([0.0, 6.4])),
    }
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=25))
def test_reports_against_loops(spark, data):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    repo = spark.createDataFrame([tuple(r[c] for c in names) for r in data], COLUMNS)
    rollup = wide_rollup(repo)
    for name in ("profile_production", "profile_movies", "count_by_vote", "count_production_by_year"):
        close(by_key(movie_report(name, rollup)), brute_force(name, data))
    close(by_key(user_profile(repo)), brute_force("profile_users", data))


def test_all_reports_over_the_tables(spark, sf_dir):
    repo = domain.repo(spark, sf_dir)
    data = [r.asDict() for r in repo.collect()]
    found = all_reports(repo)
    assert list(found) == list(REPORTS)
    star = movie_rollup(domain.ratings(spark, sf_dir), domain.attributes(spark, sf_dir))
    close(
        by_key(star_user_profile(domain.ratings(spark, sf_dir), domain.attributes(spark, sf_dir))),
        brute_force("profile_users", data),
    )
    for name, frame in found.items():
        want = brute_force(name, data)
        close(by_key(frame), want)
        if name in MOVIE_REPORTS:
            close(by_key(movie_report(name, star)), want)


def test_counts_are_conserved(spark, sf_dir):
    """Keys that are set wherever a title is give the same total of titles."""
    rollup = movie_rollup(domain.ratings(spark, sf_dir), domain.attributes(spark, sf_dir))
    totals = {
        name: movie_report(name, rollup).agg(F.sum("title_count")).first()[0]
        for name in ("count_by_genre", "count_by_vote", "count_titles_by_year")
    }
    assert set(totals.values()) == {domain.repo(spark, sf_dir).filter("title IS NOT NULL").count()}


def test_groups_without_titles_stay_in_counts(spark, sf_dir):
    rollup = movie_rollup(domain.ratings(spark, sf_dir), domain.attributes(spark, sf_dir))
    assert by_key(movie_report("count_by_genre", rollup))["(no genres listed)"] == (0,)


def test_null_groups(spark):
    frame = spark.createDataFrame(
        [("a", 1.0, "x"), (None, 2.0, "y"), ("a", 3.0, None), ("b", None, None)], "k string, v double, t string"
    )
    grouped = drop_null_keys(frame, "k").groupBy("k").agg(F.count("t").alias("n"), F.avg("v").alias("m"))
    assert rows(grouped) == [("a", 1, 2.0), ("b", 0, None)]
    assert rows(drop_null_aggregates(grouped, ["m"])) == [("a", 1, 2.0)]


def test_user_profile_is_not_a_movie_report(spark):
    with pytest.raises(ValueError):
        movie_report("profile_users", spark.createDataFrame([], MOVIE_REPO))


def test_feeds_and_headers(spark, sf_dir):
    found = all_reports(domain.repo(spark, sf_dir))
    feeds = chart_feeds(found)
    assert list(feeds) == list(FEEDS) and len(feeds) == 7
    for name, frame in feeds.items():
        assert frame.columns == [FEEDS[name].x, FEEDS[name].y]
        assert frame.count() == found[FEEDS[name].report].count()
    assert with_published_headers(found["profile_production"]).columns == [
        "production_companies",
        "average rating",
        "average vote",
        "average popularity",
        "release year",
        "userid",
    ]
    assert with_published_headers(found["count_production_by_year"]).columns == ["release_year", "production_companies"]
    produced = {c for frame in found.values() for c in frame.columns[1:]}
    assert produced == set(PUBLISHED_HEADERS)
