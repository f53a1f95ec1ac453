"""Collaborative-filtering recommendations for a title keyword.

Search the titles, let a new user rate every hit 5.0, fit the factor model with
that user in it, score the movies the user has not seen, and rank them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.matching import genre_matches
from marquee.operators.aggregates import next_user_id, one_rating_per_pair
from marquee.operators.filters import search_titles, without_listed_ids
from marquee.operators.ranking import ranked_top_k, top_k, top_k_per_group
from marquee.operators.splits import append_rows
from marquee.session import enable_checkpoints, release_unused

LIKED = 5.0

# Where ratings, blocks and factors are kept between the steps of a fit.
HELD = "DISK_ONLY"

# Shelf label -> genre text it looks for, in display order. Fixed values.
SHELVES = {
    "Romance": "Romance",
    "Action": "Action",
    "Children": "Children",
    "Thriller": "Thriller",
    "Horror": "Horror",
    "Science Fiction": "Sci-Fi",
    "Comedy": "Comedy",
    "Drama": "Drama",
}


@dataclass(frozen=True)
class AlsSettings:
    """Model parameters; rank, iterations and regularisation default to the tuned values.

    ``blocks`` is the number of parts of either side's factors. The start factors are drawn
    by block, so it belongs to the model like the seed: it never follows the cluster. Take
    about one block for every 20 million ratings, and at least as many as cores.
    """

    rank: int = 50
    max_iter: int = 10
    reg_param: float = 0.01
    seed: int = 42
    blocks: int = 16


def estimator(settings: AlsSettings) -> ALS:
    """Explicit-feedback ALS that leaves out users and movies it has not seen.

    Each half of an iteration sends every factor to up to ``blocks`` blocks, and those shuffle files
    are deleted only when the movie factors are checkpointed. So that happens in every iteration: the
    disk holds one iteration and not several, for solving the movie factors a second time.

    A task holds all factors that its block rates with as objects that Spark's memory manager cannot
    count, so blocks and factors kept between the steps are on disk: memory is for the tasks alone.
    """
    return ALS(
        userCol="userid",
        itemCol="movieid",
        ratingCol="rating",
        coldStartStrategy="drop",
        rank=settings.rank,
        maxIter=settings.max_iter,
        regParam=settings.reg_param,
        seed=settings.seed,
        numUserBlocks=settings.blocks,
        numItemBlocks=settings.blocks,
        checkpointInterval=1,
        intermediateStorageLevel=HELD,
        finalStorageLevel=HELD,
    )


def fit(ratings: DataFrame, settings: AlsSettings = AlsSettings(), unique_pairs: bool = False) -> ALSModel:
    """Fit on one rating per user and movie; ids must fit 32 bits, as ALS checks.

    Rows without a user, movie or rating, as damaged text files give them, are left
    out: ALS would stop at the first one. ``unique_pairs`` states that the ratings already have that grain and saves the
    shuffle that restores it. What earlier fits left on disk and nobody uses any more is deleted first.
    """
    enable_checkpoints(ratings.sparkSession)
    release_unused(ratings.sparkSession)
    complete = ratings.dropna("any", subset=["userid", "movieid", "rating"])
    return estimator(settings).fit(complete if unique_pairs else one_rating_per_pair(complete))


@contextmanager
def held_pairs(ratings: DataFrame) -> Iterator[DataFrame]:
    """One rating per user and movie, computed once for all that happens inside the block.

    A fit reads its ratings several times and a prediction again; without this every reading
    would average and shuffle all ratings anew. Lost parts are recomputed.
    """
    complete = ratings.dropna("any", subset=["userid", "movieid", "rating"])
    pairs = one_rating_per_pair(complete).persist(StorageLevel.DISK_ONLY)
    try:
        yield pairs
    finally:
        pairs.unpersist()


def fit_and_predict(ratings: DataFrame, settings: AlsSettings = AlsSettings()) -> tuple[ALSModel, DataFrame]:
    """The model, and its predictions (userid, movieid, rating, prediction) of the pairs it was fitted on.

    Ratings are shuffled once for both. The predictions are checkpointed in the shared folder.
    """
    enable_checkpoints(ratings.sparkSession)
    with held_pairs(ratings) as pairs:
        model = fit(pairs, settings, unique_pairs=True)
        return model, predict(model, pairs).checkpoint()


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predictions for (userid, movieid) pairs; pairs with an unknown or missing side drop out."""
    # The model narrows ids to 32 bits on its way.
    ids = {c: F.col(c).cast("bigint") for c in ("userid", "movieid")}
    return model.transform(pairs.dropna("any", subset=["userid", "movieid"])).withColumns(ids)


def synthetic_ratings(ratings: DataFrame, seeds: DataFrame) -> DataFrame:
    """Ratings of a new user (largest id + 1) who likes every seed movie."""
    return seeds.select(
        next_user_id(ratings).scalar().alias("userid"),
        "movieid",
        F.lit(LIKED).alias("rating"),
    )


def candidate_pairs(movies: DataFrame, seeds: DataFrame, userid: Column) -> DataFrame:
    """(userid, movieid) for every movie that is not a seed."""
    return without_listed_ids(movies, seeds).select(userid.alias("userid"), "movieid")


def score_movies(model: ALSModel, userid: int, movies: DataFrame) -> DataFrame:
    """(movieid, prediction) for one user over the given movies.

    One user's factor vector is ``rank`` numbers, so it is fetched and becomes a
    constant: scoring is then a projection of the movie factors and never moves the
    user factors. An unknown user scores nothing.
    """
    known = model.userFactors.filter(F.col("id") == F.lit(userid)).select("features").first()
    taste = F.lit([float(x) for x in known.features] if known else []).cast("array<float>")
    products = F.zip_with("features", taste, lambda of_movie, of_user: of_movie * of_user)
    prediction = F.aggregate(products, F.lit(0).cast("float"), lambda total, x: (total + x).cast("float"))
    scores = model.itemFactors.select(F.col("id").cast("bigint").alias("movieid"), prediction.alias("prediction"))
    if known is None:
        scores = scores.limit(0)
    return movies.select("movieid").join(scores, "movieid")


def score_unseen(
    ratings: DataFrame,
    movies: DataFrame,
    keyword: str,
    settings: AlsSettings = AlsSettings(),
    literal: bool = False,
) -> DataFrame:
    """(movieid, prediction) of every movie that the keyword does not find, by a user who likes all it finds.

    The ratings passed in stay as they are. Without a hit there is nothing to learn
    a taste from: the result is empty and no model is fitted.
    """
    nothing = ratings.sparkSession.createDataFrame([], "movieid bigint, prediction float")
    if not keyword:
        return nothing
    seeds = search_titles(movies, keyword, literal).select("movieid")
    if seeds.isEmpty():
        return nothing
    userid = next_user_id(ratings).first().userid
    liked = seeds.select(F.lit(userid).alias("userid"), "movieid", F.lit(LIKED).alias("rating"))
    model = fit(append_rows(ratings, liked), settings)
    return score_movies(model, userid, without_listed_ids(movies, seeds))


def infer(
    ratings: DataFrame,
    movies: DataFrame,
    keyword: str,
    n: int = 10,
    settings: AlsSettings = AlsSettings(),
    literal: bool = False,
) -> DataFrame:
    """The n*n best unseen movies for a keyword as (movieid, prediction).

    The short list of n*n is part of the feature: shelves are filled from it, so a shelf
    may hold fewer than n movies.

    It is checkpointed in the shared folder, so the results built on it
    share one scoring, and losing an executor afterwards does not bring the fit back. The
    model is let go then, its shuffle files too.
    """
    enable_checkpoints(ratings.sparkSession)
    best = top_k(score_unseen(ratings, movies, keyword, settings, literal), n * n, "prediction").checkpoint()
    release_unused(ratings.sparkSession)
    return best


def recommended_titles(scored: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best scored movies with their titles: rank, movieid, title, prediction."""
    titled = scored.join(movies.select("movieid", "title"), "movieid")
    return ranked_top_k(titled, n, "prediction").select("rank", "movieid", "title", "prediction")


def shelf_rows(movies: DataFrame) -> DataFrame:
    """Each movie once per shelf whose genre it names, in a ``shelf`` column."""
    labels = [F.when(genre_matches(genre), F.lit(label)) for label, genre in SHELVES.items()]
    return movies.withColumn("shelf", F.explode(F.array_compact(F.array(*labels))))


def genre_shelves(scored: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """Up to ``n`` scored movies for each of the eight shelves, best first."""
    titled = scored.join(movies.select("movieid", "title", "genres"), "movieid")
    best = top_k_per_group(shelf_rows(titled), n, "shelf", "prediction")
    return best.select("shelf", "rank", "movieid", "title", "prediction")
