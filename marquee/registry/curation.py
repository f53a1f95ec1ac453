"""Joins, title parsing, the movie repo and the tag bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import (
    release_year,
    release_year_pandas,
    title_without_year,
    title_without_year_pandas,
)
from marquee.operators import (
    distinct_rows,
    join_genome_tags,
    join_links,
    join_movie_data,
    join_ratings_movies,
)
from marquee.plans import curation
from marquee.registry import domain
from marquee.registry.domain import with_tables

_RATED = ["userid", "movieid", "rating", "title", "genres"]


def joined_movies(spark: SparkSession, sf: str) -> DataFrame:
    return join_ratings_movies(domain.ratings(spark, sf), domain.movies(spark, sf)).select(_RATED)


def joined_links(spark: SparkSession, sf: str) -> DataFrame:
    linked = join_links(domain.movies(spark, sf), domain.links(spark, sf))
    return join_ratings_movies(domain.ratings(spark, sf), linked).select(*_RATED, "tmdbid")


def joined_movie_data(spark: SparkSession, sf: str) -> DataFrame:
    linked = join_links(domain.movies(spark, sf), domain.links(spark, sf))
    known = join_movie_data(linked, domain.movie_data(spark, sf))
    return join_ratings_movies(domain.ratings(spark, sf), known).select(
        *_RATED, "tmdbid", "language", "plot", "popularity", "poster",
        "production_companies", "keywords", "vote_average",
    )


def parsed_titles(spark: SparkSession, sf: str) -> DataFrame:
    return domain.movies(spark, sf).select(
        "movieid", release_year("title").alias("release_year"), title_without_year("title").alias("title")
    )


def parsed_titles_pandas(spark: SparkSession, sf: str) -> DataFrame:
    return domain.movies(spark, sf).select(
        "movieid",
        release_year_pandas("title").alias("release_year"),
        title_without_year_pandas("title").alias("title"),
    )


def _tags(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return domain.genome_scores(spark, sf), domain.genome_tags(spark, sf)


def bundled_tags(spark: SparkSession, sf: str) -> DataFrame:
    """The arrays spelled out as text, so that their order and alignment are compared too."""
    hundredths = F.transform("relevance", lambda r: F.round(r * 100).cast("bigint").cast("string"))
    return curation.tag_bundle(*_tags(spark, sf)).select(
        "movieid",
        F.size("tagid").cast("bigint").alias("tags"),
        F.array_join(F.col("tagid").cast("array<string>"), ",").alias("tagids"),
        F.array_join(hundredths, ",").alias("relevances"),
        F.array_join("tag", ",").alias("tag_names"),
    )


QUERIES = {
    "join_ratings_movies": joined_movies,
    "join_links": joined_links,
    "join_movie_data": joined_movie_data,
    "movie_repo": domain.repo,
    "parse_title_year": parsed_titles,
    "parse_title_year_udf": parsed_titles_pandas,
    "join_genome_tags": lambda spark, sf: join_genome_tags(*_tags(spark, sf)),
    "distinct_movie_tags": lambda spark, sf: curation.movie_tags(*_tags(spark, sf)),
    "sort_movie_tags": lambda spark, sf: curation.sorted_movie_tags(*_tags(spark, sf)),
    "tag_bundle": bundled_tags,
    "distinct_titles": lambda spark, sf: distinct_rows(domain.movies(spark, sf).select("title", "genres")),
}

_TITLES_SQL = with_tables(
    "movies",
    """
    SELECT movieid,
           CASE WHEN right(title, 1) = ')' THEN substring(title, length(title) - 4, 4) END AS release_year,
           CASE WHEN right(title, 1) = ')' THEN substring(title, 1, length(title) - 6) END AS title
    FROM movies""",
)
_JOINED_TAGS = "SELECT s.movieid, s.tagid, s.relevance, t.tag FROM genome_scores s JOIN genome_tags t ON s.tagid = t.tagid"
_DISTINCT_TAGS_SQL = with_tables(
    "genome_scores genome_tags",
    f"SELECT movieid, tagid, relevance, tag FROM ({_JOINED_TAGS}) GROUP BY movieid, tagid, relevance, tag",
)

SQL = {
    "join_ratings_movies": with_tables(
        "ratings movies",
        """
        SELECT r.userid, r.movieid, r.rating, m.title, m.genres
        FROM ratings r JOIN movies m ON r.movieid = m.movieid""",
    ),
    "join_links": with_tables(
        "ratings movies links",
        """
        SELECT r.userid, r.movieid, r.rating, m.title, m.genres, k.tmdbid
        FROM ratings r JOIN movies m ON r.movieid = m.movieid JOIN links k ON r.movieid = k.movieid""",
    ),
    "join_movie_data": with_tables(
        "ratings movies links moviedata",
        """
        SELECT r.userid, r.movieid, r.rating, m.title, m.genres, k.tmdbid, d.language, d.plot, d.popularity,
               d.poster, d.production_companies, d.keywords, d.vote_average
        FROM ratings r JOIN movies m ON r.movieid = m.movieid JOIN links k ON r.movieid = k.movieid
                       JOIN moviedata d ON k.tmdbid = d.id""",
    ),
    "movie_repo": with_tables("movie_repo", "SELECT * FROM movie_repo"),
    "parse_title_year": _TITLES_SQL,
    "parse_title_year_udf": _TITLES_SQL,
    "join_genome_tags": with_tables("genome_scores genome_tags", _JOINED_TAGS),
    "distinct_movie_tags": _DISTINCT_TAGS_SQL,
    "sort_movie_tags": _DISTINCT_TAGS_SQL + " ORDER BY movieid, tagid, relevance, tag",
    "tag_bundle": with_tables(
        "genome_scores genome_tags",
        f"""
        SELECT movieid, count(*) AS tags,
               string_agg(CAST(tagid AS VARCHAR), ',' ORDER BY tagid, relevance, tag) AS tagids,
               string_agg(CAST(CAST(round(relevance * 100) AS BIGINT) AS VARCHAR), ','
                          ORDER BY tagid, relevance, tag) AS relevances,
               string_agg(tag, ',' ORDER BY tagid, relevance, tag) AS tag_names
        FROM (SELECT DISTINCT * FROM ({_JOINED_TAGS})) GROUP BY movieid""",
    ),
    "distinct_titles": with_tables("movies", "SELECT DISTINCT title, genres FROM movies"),
}
