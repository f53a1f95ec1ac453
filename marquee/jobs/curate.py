"""Build the movie repo and the tag bundle from the six raw files.

    spark-submit marquee/jobs/curate.py <input folder> [<output folder>] [--format csv|parquet|...] [--option k=v]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from marquee import schemas
from marquee.plans.curation import movie_repo, tag_bundle
from marquee.session import job_session
from marquee.sinks import ROWS_PER_FILE, write_csv, write_table
from marquee.sources import read_table, scan_csv

# Names of the raw files. Fixed values.
FILES = {
    "ratings.csv": schemas.RATINGS,
    "movies.csv": schemas.MOVIES,
    "links.csv": schemas.LINKS,
    "moviedata.csv": schemas.MOVIE_DATA,
    "genome-scores.csv": schemas.GENOME_SCORES,
    "genome-tags.csv": schemas.GENOME_TAGS,
}


def read_raw(spark: SparkSession, source: str, fmt: str = "csv", multi_line: bool = True) -> dict[str, DataFrame]:
    """The six raw tables by file name.

    As CSV each name may be a file or a folder of files. Plots may contain line breaks:
    ``multi_line`` reads the movie metadata with them, one task for each file, so large
    metadata should come as a folder. Other formats are read from folders without the
    ending, and their columns by name.
    """
    if fmt == "csv":
        return {
            name: scan_csv(spark, f"{source}/{name}", schema, multi_line=multi_line and name == "moviedata.csv")
            for name, schema in FILES.items()
        }
    return {
        name: read_table(spark, f"{source}/{name.removesuffix('.csv')}", schema, fmt) for name, schema in FILES.items()
    }


def run(
    spark: SparkSession,
    source: str,
    target: str | None,
    fmt: str = "parquet",
    tags: bool = True,
    *,
    input_fmt: str = "csv",
    multi_line: bool = True,
    mode: str = "errorifexists",
    options: dict[str, str] | None = None,
    tag_options: dict[str, str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Write ``<target>/movie_repo`` and, unless switched off, ``<target>/movie_tags``.

    A connector that names its tables by options needs no target. CSV has no arrays, so
    the tag bundle is left out of a CSV run; its files hold ``rows_per_file`` rows at most.
    """
    raw = read_raw(spark, source, input_fmt, multi_line)
    repo = movie_repo(raw["ratings.csv"], raw["movies.csv"], raw["links.csv"], raw["moviedata.csv"])

    def place(name: str) -> str | None:
        return f"{target}/{name}" if target else None

    if fmt == "csv":
        write_csv(repo, place("movie_repo"), mode=mode, rows_per_file=rows_per_file)
        return
    write_table(repo, place("movie_repo"), fmt=fmt, mode=mode, options=options)
    if tags:
        bundle = tag_bundle(raw["genome-scores.csv"], raw["genome-tags.csv"])
        write_table(bundle, place("movie_tags"), fmt=fmt, mode=mode, options=tag_options or options)


def _pairs(given: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in given)


def main() -> None:
    options = argparse.ArgumentParser(description="Build the movie repo and the tag bundle.")
    options.add_argument("source")
    options.add_argument("target", nargs="?")
    options.add_argument("--format", default="parquet")
    options.add_argument("--input-format", default="csv")
    options.add_argument("--no-line-breaks", action="store_true", help="plots hold none: read metadata in parallel")
    options.add_argument("--mode", default="errorifexists")
    options.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="for the movie repo")
    options.add_argument("--tag-option", action="append", default=[], metavar="KEY=VALUE", help="for the tags")
    options.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE, help="of a CSV file of the movie repo")
    chosen = options.parse_args()
    spark = job_session("curate")
    run(
        spark,
        chosen.source,
        chosen.target,
        chosen.format,
        input_fmt=chosen.input_format,
        multi_line=not chosen.no_line_breaks,
        mode=chosen.mode,
        options=_pairs(chosen.option),
        tag_options=_pairs(chosen.tag_option),
        rows_per_file=chosen.rows_per_file,
    )
    spark.stop()


if __name__ == "__main__":
    main()
