"""Recommend movies for a title keyword: a top list and eight genre shelves.

    spark-submit marquee/jobs/recommend.py <movies> <ratings> <keyword> [--literal] [--output folder]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from marquee import schemas
from marquee.operators import search_titles
from marquee.plans.recommend import AlsSettings, genre_shelves, infer, recommended_titles
from marquee.session import job_session
from marquee.sinks import write_csv
from marquee.sources import read_table


def run(
    spark: SparkSession,
    movies_path: str,
    ratings_path: str,
    keyword: str,
    n: int = 10,
    settings: AlsSettings = AlsSettings(),
    output: str | None = None,
    fmt: str = "csv",
    literal: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(top titles, genre shelves, titles the keyword found) from a single fit.

    All are also written as CSV if ``output`` is given. ``literal`` takes % and _ in the
    keyword as they are.
    """
    movies = read_table(spark, movies_path, schemas.MOVIES, fmt)
    ratings = read_table(spark, ratings_path, schemas.RATINGS, fmt)
    matched = search_titles(movies, keyword, literal) if keyword else movies.select("movieid", "title").limit(0)
    scored = infer(ratings, movies, keyword, n, settings, literal)
    top, shelves = recommended_titles(scored, movies, n), genre_shelves(scored, movies, n)
    if output:
        write_csv(top, f"{output}/titles", mode="overwrite")
        write_csv(shelves, f"{output}/shelves", mode="overwrite")
        write_csv(matched, f"{output}/matched", mode="overwrite")
    return top, shelves, matched


def main() -> None:
    options = argparse.ArgumentParser(description="Recommend movies for a title keyword.")
    options.add_argument("movies")
    options.add_argument("ratings")
    options.add_argument("keyword")
    options.add_argument("--output")
    options.add_argument("--format", default="csv")
    options.add_argument("--top", type=int, default=10)
    options.add_argument("--rank", type=int, default=AlsSettings.rank)
    options.add_argument("--max-iter", type=int, default=AlsSettings.max_iter)
    options.add_argument("--reg-param", type=float, default=AlsSettings.reg_param)
    options.add_argument("--blocks", type=int, default=AlsSettings.blocks)
    options.add_argument("--literal", action="store_true")
    chosen = options.parse_args()
    spark = job_session("recommend")
    settings = AlsSettings(chosen.rank, chosen.max_iter, chosen.reg_param, blocks=chosen.blocks)
    top, shelves, matched = run(
        spark, chosen.movies, chosen.ratings, chosen.keyword, chosen.top, settings, chosen.output, chosen.format,
        chosen.literal,
    )
    matched.orderBy("title", "movieid").show(truncate=False)
    shelves.orderBy("shelf", "rank").show(8 * chosen.top, truncate=False)
    top.orderBy("rank").show(chosen.top, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
