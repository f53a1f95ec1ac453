"""Curation: the rating-grain movie repo and the per-movie tag bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.titles import release_year, title_without_year
from marquee.operators.joins import join_genome_tags, join_links, join_movie_data, join_ratings_movies
from marquee.operators.sizing import BROADCAST_LIMIT
from marquee.schemas import MOVIE_REPO_COLUMNS


def movie_attributes(movies: DataFrame, links: DataFrame, movie_data: DataFrame) -> DataFrame:
    """Everything the movie repo says about a movie, one row per movie."""
    joined = join_movie_data(join_links(movies, links), movie_data)
    return joined.withColumns(
        {"release_year": release_year("title"), "title": title_without_year("title")}
    )


def movie_repo(
    ratings: DataFrame,
    movies: DataFrame,
    links: DataFrame,
    movie_data: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """One row per rating with the movie's attributes repeated on it.

    The three dimension tables meet at movie grain and titles are parsed there, so
    the ratings are shuffled once at most, and not at all if the joined dimension
    fits the broadcast limit.
    """
    attributes = movie_attributes(movies, links, movie_data)
    return join_ratings_movies(ratings, attributes, broadcast_limit).select(MOVIE_REPO_COLUMNS)


def movie_tags(scores: DataFrame, tags: DataFrame) -> DataFrame:
    """Distinct (movieid, tagid, relevance, tag).

    Both sides are made distinct before they meet, which gives the same rows as a
    distinct after the join and sends each repeated score through the shuffle once
    per task at most.
    """
    return join_genome_tags(scores.distinct(), tags.distinct())


def sorted_movie_tags(scores: DataFrame, tags: DataFrame) -> DataFrame:
    return movie_tags(scores, tags).orderBy("movieid", "tagid", "relevance", "tag")


def tag_bundle(scores: DataFrame, tags: DataFrame) -> DataFrame:
    """Per movie three arrays of equal length and equal order: relevance, tag, tagid.

    One array of structs keeps the three aligned when a relevance is null. Only
    distinct rows are gathered, so a movie's array grows with the tags and relevances
    it has and not with how many copies of them there are.
    """
    bundled = movie_tags(scores, tags).groupBy("movieid").agg(
        F.sort_array(F.collect_list(F.struct("tagid", "relevance", "tag"))).alias("entries")
    )
    return bundled.select(
        "movieid",
        F.col("entries.relevance").alias("relevance"),
        F.col("entries.tag").alias("tag"),
        F.col("entries.tagid").alias("tagid"),
    )
