"""The ten reports and the seven chart feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans import reports
from marquee.registry import domain
from marquee.registry.domain import single, single_sql, with_tables


def build(name: str, spark: SparkSession, sf: str) -> DataFrame:
    """One report straight from the ratings and the movie dimension."""
    ratings, attributes = domain.ratings(spark, sf), domain.attributes(spark, sf)
    if name == reports.USER_REPORT:
        return reports.star_user_profile(ratings, attributes)
    return reports.movie_report(name, reports.movie_rollup(ratings, attributes))


def comparable(frame: DataFrame) -> DataFrame:
    return frame.select(*[single(c, c) if c.startswith("average_") else F.col(c) for c in frame.columns])


def _report(name: str):
    return lambda spark, sf: comparable(build(name, spark, sf))


def _feed(name: str):
    report = reports.FEEDS[name].report
    return lambda spark, sf: comparable(reports.chart_feeds({report: build(report, spark, sf)}, [name])[name])


QUERIES = {
    **{name: _report(name) for name in reports.REPORTS},
    **{name: _feed(name) for name in reports.FEEDS},
}


def _profile_sql(key: str, more: str = "", more_not_null: str = "") -> str:
    return with_tables(
        "movie_repo",
        f"""
        SELECT {key}, {single_sql("avg(rating)")} AS average_rating,
               {single_sql("avg(vote_average)")} AS average_vote,
               {single_sql("avg(popularity)")} AS average_popularity,
               max(release_year) AS latest_release_year{more}
        FROM movie_repo WHERE {key} IS NOT NULL GROUP BY {key}
        HAVING avg(rating) IS NOT NULL AND avg(vote_average) IS NOT NULL AND avg(popularity) IS NOT NULL
           AND max(release_year) IS NOT NULL{more_not_null}""",
    )


def _count_sql(key: str, counted: str, alias: str) -> str:
    return with_tables(
        "movie_repo",
        f"SELECT {key}, count({counted}) AS {alias} FROM movie_repo WHERE {key} IS NOT NULL GROUP BY {key}",
    )


_REPORT_SQL = {
    "profile_production": _profile_sql(
        "production_companies", ", max(userid) AS largest_userid", " AND max(userid) IS NOT NULL"
    ),
    "profile_movies": _profile_sql("title"),
    "profile_users": _profile_sql("userid"),
    "count_by_genre": _count_sql("genres", "title", "title_count"),
    "count_by_language": _count_sql("language", "title", "title_count"),
    "count_by_vote": _count_sql("vote_average", "title", "title_count"),
    "count_titles_by_production": _count_sql("production_companies", "title", "title_count"),
    "count_language_by_production": _count_sql("production_companies", "language", "language_count"),
    "count_titles_by_year": _count_sql("release_year", "title", "title_count"),
    "count_production_by_year": _count_sql("release_year", "production_companies", "production_count"),
}

SQL = {
    **_REPORT_SQL,
    **{
        name: f"SELECT {feed.x}, {feed.y} FROM ({_REPORT_SQL[feed.report]})"
        for name, feed in reports.FEEDS.items()
    },
}
