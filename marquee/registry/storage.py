"""Sources and sinks as round trips: write whole tables, read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.plans import curation, reports
from marquee.registry import domain, recommendation
from marquee.registry import reports as report_queries
from marquee.registry.domain import single, single_sql, with_tables
from marquee.session import scratch_path
from marquee.sinks import ROWS_PER_FILE, export_csv, write_csv, write_table
from marquee.sources import read_csv_by_name, read_table, scan_csv, split_text_ratings


def _ratings_csv(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "ratings-csv")
    write_csv(domain.ratings(spark, sf), path)
    return path


def inferred_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Types come from the data; ids are widened so that the layout does not depend on their size."""
    found = scan_csv(spark, _ratings_csv(spark, sf))
    return found.select(F.col("userid").cast("bigint"), F.col("movieid").cast("bigint"), "rating")


def declared_csv(spark: SparkSession, sf: str) -> DataFrame:
    return scan_csv(spark, _ratings_csv(spark, sf), schemas.RATINGS)


def repo_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table out of a headed CSV, as the reports read it; CSV cells lose outer blanks."""
    path = scratch_path(spark, "repo-csv")
    write_csv(domain.repo(spark, sf), path)
    return read_csv_by_name(spark, path, schemas.REPORT_INPUT)


def damaged_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings whose lines are whole, too long, broken or too short, by user id."""
    user, movie, rating = (F.col(c).cast("string") for c in ("userid", "movieid", "rating"))
    kind = F.col("userid") % 4
    line = (
        F.when(kind == 0, F.concat_ws(",", user, movie, rating))
        .when(kind == 1, F.concat_ws(",", user, movie, rating, F.lit("964982703")))
        .when(kind == 2, F.concat_ws(",", F.lit("bad"), movie, rating))
        .otherwise(F.concat_ws(",", user, movie))
    )
    path = scratch_path(spark, "damaged-csv")
    domain.ratings(spark, sf).select(line.alias("value")).write.text(path)
    return scan_csv(spark, path, schemas.RATINGS, header=False)


def split_lines(spark: SparkSession, sf: str) -> DataFrame:
    return split_text_ratings(spark, _ratings_csv(spark, sf), "userid,movieid,rating")


def csv_folder(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "movies-csv")
    write_csv(domain.movies(spark, sf), path)
    return scan_csv(spark, path, schemas.MOVIES)


def single_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A report under its published file name and header."""
    name = "count_by_genre"
    report = reports.REPORTS[name]
    frame = reports.with_published_headers(report_queries.build(name, spark, sf))
    folder = f"{scratch_path(spark, 'export')}/{report.folder}"
    written = export_csv(frame, folder, report.file)
    return scan_csv(spark, written, "genres string, title bigint")


def parts_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A report that grows with the users, as a folder of part files under its published name."""
    name = "profile_users"
    report = reports.REPORTS[name]
    frame = report_queries.build(name, spark, sf).select("userid", "latest_release_year")
    folder = f"{scratch_path(spark, 'export')}/{report.folder}"
    written = export_csv(frame, folder, report.file, single_file=report.single_file)
    return scan_csv(spark, written, "userid bigint, latest_release_year string")


_BROKEN_PLOT = 'line one\nsaid "two", three'


def csv_line_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Report counts over a wide CSV whose plots hold line breaks, quotes and commas."""
    path = scratch_path(spark, "broken-plots")
    write_csv(domain.repo(spark, sf).withColumn("plot", F.lit(_BROKEN_PLOT)), path, rows_per_file=ROWS_PER_FILE)
    wide = read_table(spark, path, schemas.REPORT_INPUT, multi_line=True)
    return wide.groupBy("genres").agg(
        F.count("title").alias("titles"), F.count(F.lit(1)).alias("ratings"), F.max("userid").alias("last_userid")
    )


def table_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "movie-repo")
    write_table(domain.repo(spark, sf), path)
    return spark.read.parquet(path)


def tag_table_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The tag bundle as a table of arrays, read back and laid out row by row."""
    path = scratch_path(spark, "movie-tags")
    write_table(curation.tag_bundle(domain.genome_scores(spark, sf), domain.genome_tags(spark, sf)), path)
    entries = F.inline(F.arrays_zip("tagid", "relevance", "tag"))
    return spark.read.parquet(path).select("movieid", entries)


def saved_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    """Saved shelves that differ from those computed, either way; and whether there are any."""
    path = scratch_path(spark, "shelves-csv")
    shelves = recommendation.shelves(spark, sf).checkpoint()
    write_csv(shelves, path, keep_blanks=True)
    saved = scan_csv(spark, path, shelves.schema)
    problems = {
        "lost": shelves.exceptAll(saved).count(),
        "strange": saved.exceptAll(shelves).count(),
        "none": int(saved.isEmpty()),
    }
    return spark.createDataFrame(list(problems.items()), "problem string, cases bigint")


def reports_from_wide_table(spark: SparkSession, sf: str) -> DataFrame:
    """All ten reports over the stored wide table, each summed up in one row."""
    path = scratch_path(spark, "wide-repo")
    write_table(domain.repo(spark, sf), path)
    found = reports.all_reports(spark.read.parquet(path))
    rows = [
        frame.agg(
            F.lit(name).alias("report"),
            F.count(F.lit(1)).alias("groups"),
            F.sum(frame.columns[1]).alias("total"),
        )
        for name, frame in found.items()
    ]
    together = rows[0]
    for row in rows[1:]:
        together = together.unionByName(row)
    return together.select("report", "groups", single("total", "total"))


QUERIES = {
    "scan_csv_inferred": inferred_csv,
    "scan_csv_schema": declared_csv,
    "scan_csv_by_name": repo_by_name,
    "scan_csv_permissive": damaged_csv,
    "scan_text_split": split_lines,
    "sink_csv_dir": csv_folder,
    "sink_csv_single": single_csv,
    "sink_csv_parts": parts_csv,
    "scan_csv_line_breaks": csv_line_breaks,
    "sink_table": table_sink,
    "sink_tag_table": tag_table_sink,
    "sink_recommendations": saved_recommendations,
    "reports_from_wide_table": reports_from_wide_table,
}

_ALL_RATINGS = with_tables("ratings", "SELECT userid, movieid, rating FROM ratings")
_SUMMED = {
    "profile_production": ("production_companies", "avg(rating)"),
    "profile_movies": ("title", "avg(rating)"),
    "profile_users": ("userid", "avg(rating)"),
    "count_by_genre": ("genres", "count(title)"),
    "count_by_language": ("language", "count(title)"),
    "count_by_vote": ("vote_average", "count(title)"),
    "count_titles_by_production": ("production_companies", "count(title)"),
    "count_language_by_production": ("production_companies", "count(language)"),
    "count_titles_by_year": ("release_year", "count(title)"),
    "count_production_by_year": ("release_year", "count(production_companies)"),
}


def _summed_sql(name: str, key: str, measure: str) -> str:
    kept = " HAVING max(release_year) IS NOT NULL" if name.startswith("profile_") else ""
    return f"""
        SELECT '{name}' AS report, count(*) AS groups, {single_sql("sum(m)")} AS total
        FROM (SELECT {measure} AS m FROM movie_repo WHERE {key} IS NOT NULL GROUP BY {key}{kept})"""


SQL = {
    "scan_csv_inferred": _ALL_RATINGS,
    "scan_csv_schema": _ALL_RATINGS,
    "scan_csv_by_name": with_tables(
        "movie_repo",
        "SELECT {} FROM movie_repo".format(
            ", ".join("trim(title) AS title" if c == "title" else c for c in schemas.REPORT_INPUT.names)
        ),
    ),
    "scan_csv_permissive": with_tables(
        "ratings",
        """
        SELECT CASE WHEN userid % 4 <> 2 THEN userid END AS userid, movieid,
               CASE WHEN userid % 4 <> 3 THEN rating END AS rating
        FROM ratings""",
    ),
    "scan_text_split": _ALL_RATINGS,
    "sink_csv_dir": with_tables("movies", "SELECT movieid, title, genres FROM movies"),
    "sink_csv_single": with_tables(
        "movie_repo",
        "SELECT genres, count(title) AS title FROM movie_repo WHERE genres IS NOT NULL GROUP BY genres",
    ),
    "sink_csv_parts": with_tables(
        "movie_repo",
        """
        SELECT userid, max(release_year) AS latest_release_year FROM movie_repo
        WHERE userid IS NOT NULL GROUP BY userid HAVING max(release_year) IS NOT NULL""",
    ),
    "scan_csv_line_breaks": with_tables(
        "movie_repo",
        """
        SELECT genres, count(title) AS titles, count(*) AS ratings, max(userid) AS last_userid
        FROM movie_repo GROUP BY genres""",
    ),
    "sink_recommendations": """
        SELECT problem, CAST(0 AS BIGINT) AS cases FROM (VALUES ('lost'), ('strange'), ('none')) AS t(problem)""",
    "sink_table": with_tables("movie_repo", "SELECT * FROM movie_repo"),
    "sink_tag_table": with_tables(
        "genome_scores genome_tags",
        """
        SELECT DISTINCT s.movieid, s.tagid, s.relevance, t.tag
        FROM genome_scores s JOIN genome_tags t ON s.tagid = t.tagid""",
    ),
    "reports_from_wide_table": with_tables(
        "movie_repo", " UNION ALL ".join(_summed_sql(name, *parts) for name, parts in _SUMMED.items())
    ),
}
