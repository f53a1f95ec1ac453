"""The ten grouped reports and the chart feeds.

All report attributes but the user id belong to the movie, so the ratings are first
rolled up to one row per movie: counts, rating sum and largest user id. The rollup
combines map-side, so it moves one row per movie and task, whatever share of the
ratings one movie holds. Nine reports are then groupings of that small table, with
averages weighted by the counts. Only the user profile needs the ratings themselves.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.filters import drop_null_aggregates, drop_null_keys
from marquee.operators.joins import join_ratings_movies
from marquee.operators.sizing import BROADCAST_LIMIT
from marquee.session import enable_checkpoints

# Movie attributes that some report groups by, averages, counts or takes the maximum of.
REPORT_ATTRIBUTES = [
    "title",
    "genres",
    "language",
    "production_companies",
    "release_year",
    "vote_average",
    "popularity",
]

# Aggregates are SQL expressions by output column.
_ROLLUP = {
    "ratings": "count(*)",
    "rated": "count(rating)",
    "rating_sum": "sum(rating)",
    "last_userid": "max(userid)",
}


def _measures(aggregates: dict[str, str]) -> list[Column]:
    return [F.expr(text).alias(name) for name, text in aggregates.items()]


def movie_rollup(ratings: DataFrame, attributes: DataFrame) -> DataFrame:
    """Movie-grain counts and sums from the ratings and the movie attributes."""
    per_movie = ratings.groupBy("movieid").agg(*_measures(_ROLLUP))
    return per_movie.join(attributes.select("movieid", *REPORT_ATTRIBUTES), "movieid")


def wide_rollup(repo: DataFrame) -> DataFrame:
    """The same from a curated rating-grain table.

    Grouping by all attributes as well stays exact where a movie's attributes
    differ between its ratings.
    """
    return repo.groupBy("movieid", *REPORT_ATTRIBUTES).agg(*_measures(_ROLLUP))


def _average(column: str) -> str:
    """Mean of a movie attribute over rating rows, from movie-grain counts."""
    return f"try_divide(sum({column} * ratings), sum(if({column} IS NULL, 0, ratings)))"


def _count(column: str) -> str:
    """Rating rows with a value in the column."""
    return f"sum(if({column} IS NULL, 0, ratings))"


_PROFILE = {
    "average_rating": "try_divide(sum(rating_sum), sum(rated))",
    "average_vote": _average("vote_average"),
    "average_popularity": _average("popularity"),
    "latest_release_year": "max(release_year)",
}

# The same four per user, by way of sums and counts.
_USER_SUMS = {
    "rated": "count(rating)",
    "rating_sum": "sum(rating)",
    "voted": "count(vote_average)",
    "vote_sum": "sum(vote_average)",
    "measured": "count(popularity)",
    "popularity_sum": "sum(popularity)",
    "plain_year": "max(plain_year)",
}
_USER_PROFILE = {
    "average_rating": "try_divide(sum(rating_sum), sum(rated))",
    "average_vote": "try_divide(sum(vote_sum), sum(voted))",
    "average_popularity": "try_divide(sum(popularity_sum), sum(measured))",
    "latest_release_year": "greatest(lpad(CAST(max(plain_year) AS STRING), 4, '0'), max(odd_year))",
}

# Headers of the exported files, fixed because the chart pages look columns up by them.
PUBLISHED_HEADERS = {
    "average_rating": "average rating",
    "average_vote": "average vote",
    "average_popularity": "average popularity",
    "latest_release_year": "release year",
    "largest_userid": "userid",
    "title_count": "title",
    "language_count": "language",
    "production_count": "production_companies",
}


@dataclass(frozen=True)
class Report:
    """A grouping key, its aggregates and what the export writes: one file, or a folder of parts.

    Reports by an attribute are one file; those by title or user grow with the data.
    """

    key: str
    aggregates: dict[str, str]
    folder: str
    file: str
    complete_groups_only: bool = False
    single_file: bool = True


# Folder and file names of the exports are fixed values.
REPORTS = {
    "profile_production": Report(
        "production_companies",
        {**_PROFILE, "largest_userid": "max(last_userid)"},
        "production",
        "production",
        complete_groups_only=True,
    ),
    "profile_movies": Report("title", _PROFILE, "movies", "movies_final", complete_groups_only=True, single_file=False),
    "profile_users": Report("userid", _USER_PROFILE, "users", "users", complete_groups_only=True, single_file=False),
    "count_by_genre": Report("genres", {"title_count": _count("title")}, "genre", "genre-movie"),
    "count_by_language": Report("language", {"title_count": _count("title")}, "lang", "lang-movie"),
    "count_by_vote": Report("vote_average", {"title_count": _count("title")}, "vote", "vote-movie"),
    "count_titles_by_production": Report(
        "production_companies", {"title_count": _count("title")}, "production-mov", "production-movie"
    ),
    "count_language_by_production": Report(
        "production_companies", {"language_count": _count("language")}, "lang-pro", "lang-pro"
    ),
    "count_titles_by_year": Report("release_year", {"title_count": _count("title")}, "year", "year-movie"),
    "count_production_by_year": Report(
        "release_year", {"production_count": _count("production_companies")}, "year-pro", "year-prod"
    ),
}
USER_REPORT = "profile_users"
MOVIE_REPORTS = [name for name in REPORTS if name != USER_REPORT]


def _build(report: Report, source: DataFrame) -> DataFrame:
    grouped = (
        drop_null_keys(source, report.key)
        .groupBy(report.key)
        .agg(*_measures(report.aggregates))
    )
    return drop_null_aggregates(grouped, list(report.aggregates)) if report.complete_groups_only else grouped


def movie_report(name: str, rollup: DataFrame) -> DataFrame:
    """Any report but the user profile, from a movie-grain rollup."""
    if name == USER_REPORT:
        raise ValueError("the user profile is built from rating rows: call user_profile or star_user_profile")
    return _build(REPORTS[name], rollup)


def _year_parts(frame: DataFrame) -> DataFrame:
    """Release years as numbers where they are four digits, as text where they are not."""
    plain = F.col("release_year").rlike(r"^[0-9]{4}\z")
    return frame.select(
        *[c for c in frame.columns if c != "release_year"],
        F.when(plain, F.col("release_year").try_cast("int")).alias("plain_year"),
        F.when(~plain, F.col("release_year")).alias("odd_year"),
    )


def _profile_of_users(rows: DataFrame) -> DataFrame:
    """The user profile from rating rows with their year in two parts.

    A maximum over text would make Spark sort all ratings by user before it adds them
    up. Plain years are numbers and the rare other text is part of the first grouping
    key, so the ratings meet a hash aggregate, and the text maximum is left to a second
    grouping of about one row per user.
    """
    per_year_text = drop_null_keys(rows, "userid").groupBy("userid", "odd_year").agg(*_measures(_USER_SUMS))
    return _build(REPORTS[USER_REPORT], per_year_text)


_USER_ATTRIBUTES = ["vote_average", "popularity", "release_year"]


def user_profile(repo: DataFrame) -> DataFrame:
    """Per user the mean rating, vote and popularity and the latest release year."""
    return _profile_of_users(_year_parts(repo.select("userid", "rating", *_USER_ATTRIBUTES)))


def star_user_profile(
    ratings: DataFrame, attributes: DataFrame, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """The same from ratings and movie attributes; years are taken apart once per movie."""
    narrow = _year_parts(attributes.select("movieid", *_USER_ATTRIBUTES))
    return _profile_of_users(join_ratings_movies(ratings, narrow, broadcast_limit))


def all_reports(repo: DataFrame) -> dict[str, DataFrame]:
    """All ten reports over a curated table.

    The nine movie reports share one rollup, kept as a checkpoint in the shared
    folder: the wide table is scanned once for them and a lost executor does not
    bring that scan back.
    """
    enable_checkpoints(repo.sparkSession)
    rollup = wide_rollup(repo).checkpoint()
    return {
        name: user_profile(repo) if name == USER_REPORT else movie_report(name, rollup) for name in REPORTS
    }


def with_published_headers(frame: DataFrame) -> DataFrame:
    return frame.withColumnsRenamed(PUBLISHED_HEADERS)


@dataclass(frozen=True)
class Feed:
    """The two columns of a report that one chart draws."""

    report: str
    x: str
    y: str


FEEDS = {
    "feed_movie_rating": Feed("profile_movies", "title", "average_rating"),
    "feed_movie_popularity": Feed("profile_movies", "title", "average_popularity"),
    "feed_movie_vote": Feed("profile_movies", "title", "average_vote"),
    "feed_production_vote": Feed("profile_production", "production_companies", "average_vote"),
    "feed_production_rating": Feed("profile_production", "production_companies", "average_rating"),
    "feed_production_popularity": Feed("profile_production", "production_companies", "average_popularity"),
    "feed_user_rating": Feed("profile_users", "userid", "average_rating"),
}


def chart_feeds(reports: dict[str, DataFrame], names: Iterable[str] = tuple(FEEDS)) -> dict[str, DataFrame]:
    """x/y projections of finished reports."""
    return {name: reports[FEEDS[name].report].select(FEEDS[name].x, FEEDS[name].y) for name in names}
