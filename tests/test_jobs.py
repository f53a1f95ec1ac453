"""The submitted jobs end to end, from raw files to reports and recommendations."""

from __future__ import annotations

import csv

import pytest
from frames import rows
from pyspark.sql import functions as F

from marquee import schemas
from marquee.jobs import analyze, curate, recommend, tune
from marquee.plans.recommend import AlsSettings
from marquee.plans.reports import REPORTS
from marquee.plans.tuning import load_model
from marquee.registry import domain
from marquee.sinks import export_csv


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    data = domain.movie_data(spark, sf_dir).withColumn("release_date", F.lit("1999-01-01"))
    data = data.withColumn("plot", F.concat("plot", F.lit('\nsaid "no", then\nleft')))
    tables = {
        "ratings": domain.ratings(spark, sf_dir),
        "movies": domain.movies(spark, sf_dir),
        "links": domain.links(spark, sf_dir),
        "moviedata": data.select(schemas.MOVIE_DATA.names),
        "genome-scores": domain.genome_scores(spark, sf_dir),
        "genome-tags": domain.genome_tags(spark, sf_dir),
    }
    for name, frame in tables.items():
        export_csv(frame, str(folder), name)
    return str(folder)


def test_curate_to_tables(spark, sf_dir, raw, tmp_path):
    curate.run(spark, raw, str(tmp_path))
    found = spark.read.parquet(f"{tmp_path}/movie_repo")
    assert found.filter("plot NOT LIKE '%\nleft'").isEmpty()
    assert rows(found.drop("plot")) == rows(domain.repo(spark, sf_dir).drop("plot"))
    tags = spark.read.parquet(f"{tmp_path}/movie_tags")
    assert tags.columns == ["movieid", "relevance", "tag", "tagid"]
    assert tags.filter("size(tag) != size(tagid) OR size(tag) != size(relevance)").isEmpty()


def test_curate_to_csv_then_analyze(spark, sf_dir, raw, tmp_path):
    curate.run(spark, raw, str(tmp_path / "curated"), fmt="csv")
    written = analyze.run(spark, f"{tmp_path}/curated/movie_repo", str(tmp_path / "reports"))
    assert {name: files[0].split("/")[-2:] for name, files in written.items()} == {
        name: [report.folder, f"{report.file}.csv" if report.single_file else report.file]
        for name, report in REPORTS.items()
    }
    with open(written["count_titles_by_year"][0], newline="") as file:
        lines = list(csv.reader(file))
    assert lines[0] == ["release_year", "title"]
    assert sum(int(n) for _, n in lines[1:]) == domain.repo(spark, sf_dir).filter("title IS NOT NULL").count()
    users = spark.read.csv(written["profile_users"], header=True)
    assert users.columns == ["userid", "average rating", "average vote", "average popularity", "release year"]


def test_csv_and_parquet_give_the_same_reports(spark, raw, tmp_path):
    """Plots with line breaks do not move cells."""
    curate.run(spark, raw, str(tmp_path / "c"), fmt="csv")
    curate.run(spark, raw, str(tmp_path / "p"), tags=False)
    one = analyze.run(spark, f"{tmp_path}/c/movie_repo", str(tmp_path / "rc"))
    two = analyze.run(spark, f"{tmp_path}/p/movie_repo", str(tmp_path / "rp"), "parquet", one_file=True)
    for name in ("count_by_genre", "count_by_language", "count_titles_by_year", "profile_users"):
        assert rows(spark.read.csv(one[name], header=True)) == rows(spark.read.csv(two[name], header=True))


def test_curate_from_tables_with_mode_and_options(spark, raw, sf_dir, tmp_path):
    source = str(tmp_path / "raw")
    for name, frame in curate.read_raw(spark, raw).items():
        frame.write.parquet(f"{source}/{name.removesuffix('.csv')}")
    for _ in range(2):
        curate.run(
            spark, source, str(tmp_path / "out"), tags=False, input_fmt="parquet", mode="overwrite",
            options={"compression": "gzip"},
        )
    assert list((tmp_path / "out/movie_repo").glob("*.gz.parquet"))
    assert spark.read.parquet(f"{tmp_path}/out/movie_repo").count() == domain.repo(spark, sf_dir).count()
    curate.run(spark, source, None, fmt="noop", input_fmt="parquet", mode="overwrite")


def test_tune_job(spark, raw, tmp_path):
    report = tune.run(spark, f"{raw}/ratings.csv", str(tmp_path / "m"), ranks=(2, 3), reg_params=(0.5,), max_iter=1)
    assert report.tuned.metrics.count() == 2 and load_model(spark, str(tmp_path / "m")).rank in (2, 3)


def test_recommend_and_save(spark, raw, tmp_path):
    top, shelves, matched = recommend.run(
        spark,
        f"{raw}/movies.csv",
        f"{raw}/ratings.csv",
        "blue",
        settings=AlsSettings(rank=4, max_iter=2),
        output=str(tmp_path),
    )
    for frame, name in ((top, "titles"), (shelves, "shelves"), (matched, "matched")):
        saved = spark.read.csv(f"{tmp_path}/{name}", header=True, schema=frame.schema)
        assert rows(saved) == rows(frame) and saved.count() > 0
    wild, literal = (
        recommend.run(spark, f"{raw}/movies.csv", f"{raw}/ratings.csv", "%%", settings=AlsSettings(2, 1), literal=flag)[2]
        for flag in (False, True)
    )
    assert wild.count() > 0 and literal.count() == 0
