"""The inner joins of the curation.

Ratings meet a movie dimension by broadcast only if the dimension has been measured
and found small. Otherwise, and in all other joins, the choice is Spark's: a side
under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, and larger ones are
sorted and merged, where adaptive execution splits the partitions of a hot movie.

The dimension joins take any frame with the join column, so they can run at movie
grain before the ratings are touched; being inner, the result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.sizing import BROADCAST_LIMIT, broadcast_if_small

_MOVIE_FACTS = [
    "language",
    "plot",
    "popularity",
    "poster",
    "production_companies",
    "keywords",
    "vote_average",
]


def join_ratings_movies(
    ratings: DataFrame, movies: DataFrame, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Ratings with the columns of their movie."""
    return ratings.join(broadcast_if_small(movies, broadcast_limit), "movieid")


def join_links(movies: DataFrame, links: DataFrame) -> DataFrame:
    """Add the id under which the metadata knows the movie."""
    return movies.join(links.select("movieid", "tmdbid"), "movieid")


def join_movie_data(linked: DataFrame, movie_data: DataFrame) -> DataFrame:
    """Add the metadata; a movie without a metadata id drops out."""
    facts = movie_data.select(F.col("id").alias("tmdbid"), *_MOVIE_FACTS)
    return linked.join(facts, "tmdbid")


def join_genome_tags(scores: DataFrame, tags: DataFrame) -> DataFrame:
    return scores.join(tags, "tagid").select("movieid", "tagid", "relevance", "tag")
