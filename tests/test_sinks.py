from __future__ import annotations

import csv

import pytest
from frames import rows
from pyspark.errors import AnalysisException

from marquee.sinks import export_csv, preview, write_csv, write_table
from marquee.sources import scan_csv


def content(path):
    with open(path, newline="") as file:
        return list(csv.reader(file))


def test_csv_folder_has_headers_and_survives_quotes(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "id bigint, t string")
    path = str(tmp_path / "out")
    write_csv(frame, path)
    assert rows(scan_csv(spark, path, frame.schema)) == rows(frame)
    assert all(content(p)[0] == ["id", "t"] for p in (tmp_path / "out").glob("part-*"))


def test_blanks_are_trimmed_unless_kept(spark, tmp_path):
    frame = spark.createDataFrame([(1, " x ")], "id bigint, t string")
    for keep, want in ((False, "x"), (True, " x ")):
        write_csv(frame, str(tmp_path / str(keep)), keep_blanks=keep)
        assert rows(scan_csv(spark, str(tmp_path / str(keep)), frame.schema)) == [(1, want)]


def test_small_report_is_one_file_with_a_stable_name(spark, tmp_path):
    folder = str(tmp_path / "genre")
    for size in (5, 3):
        files = export_csv(spark.range(size), folder, "genre-movie")
    assert files == [f"{folder}/genre-movie.csv"]
    assert content(files[0]) == [["id"], ["0"], ["1"], ["2"]]
    assert [p.name for p in (tmp_path / "genre").iterdir() if not p.name.endswith(".crc")] == ["genre-movie.csv"]


@pytest.mark.parametrize("size", [0, 1, 500])
def test_layout_does_not_follow_the_number_of_rows(spark, tmp_path, size):
    frame = spark.range(size).repartition(3)
    assert export_csv(frame, str(tmp_path), "one") == [f"{tmp_path}/one.csv"]
    assert export_csv(frame, str(tmp_path), "many", single_file=False) == [f"{tmp_path}/many"]
    assert spark.read.csv(f"{tmp_path}/many", header=True, schema="id bigint").count() == size
    assert {p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")} == {"one.csv", "many"}


def test_export_replaces_its_own_report_only(spark, tmp_path):
    folder = str(tmp_path)
    export_csv(spark.range(7).repartition(3), folder, "production-movie", single_file=False)
    export_csv(spark.range(4), folder, "production-by-year")
    for size in (9, 2):
        export_csv(spark.range(size), folder, "production")
    export_csv(spark.range(3), folder, "production-movie", single_file=False)
    assert len(content(f"{folder}/production.csv")) == 3
    assert len(content(f"{folder}/production-by-year.csv")) == 5
    assert spark.read.csv(f"{folder}/production-movie", header=True).count() == 3


def test_the_other_layout_of_a_report_goes(spark, tmp_path):
    folder = str(tmp_path)
    export_csv(spark.range(5), folder, "users-list")
    (tmp_path / "users").mkdir()
    (tmp_path / "users" / "notes.txt").write_text("not an export")
    for size, single in ((3, True), (4, False), (2, True)):
        name = "title"
        written = export_csv(spark.range(size).repartition(2), folder, name, single_file=single)
        there = {p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc") and p.name.startswith(name)}
        assert there == {"title.csv" if single else "title"}
        assert spark.read.csv(written, header=True).count() == size
    export_csv(spark.range(1), folder, "users")
    assert (tmp_path / "users" / "notes.txt").exists() and (tmp_path / "users-list.csv").exists()


def test_rows_of_a_file_are_bounded(spark, tmp_path):
    path = str(tmp_path / "many")
    write_csv(spark.range(95).repartition(2), path, rows_per_file=10)
    files = list((tmp_path / "many").glob("part-*.csv"))
    assert len(files) >= 10 and all(1 < len(content(f)) <= 11 for f in files)
    assert spark.read.csv(path, header=True).count() == 95


def test_empty_report(spark, tmp_path):
    files = export_csv(spark.range(0), str(tmp_path), "none")
    assert len(files) == 1 and content(files[0]) in ([["id"]], [])


def test_table_sink(spark, tmp_path):
    frame = spark.createDataFrame([(1, [1, 2])], "k bigint, a array<int>")
    path = str(tmp_path / "t")
    write_table(frame, path)
    assert rows(spark.read.parquet(path)) == [(1, [1, 2])]
    with pytest.raises(AnalysisException):
        write_table(frame, path)
    write_table(frame, path, mode="append", fmt="parquet")
    assert spark.read.parquet(path).count() == 2
    write_table(frame, str(tmp_path / "o"), fmt="orc")
    assert rows(spark.read.orc(str(tmp_path / "o"))) == [(1, [1, 2])]


def test_bucketed_tables_join_without_a_shuffle(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("bucketed_left", "bucketed_right"):
        write_table(spark.range(50).toDF("movieid"), name, catalog=True, bucket_by=(4, "movieid"), mode="overwrite")
    joined = spark.table("bucketed_left").join(spark.table("bucketed_right"), "movieid")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50
    for name in ("bucketed_left", "bucketed_right"):
        spark.sql(f"DROP TABLE {name}")


def test_preview(spark):
    frame = spark.range(30).toDF("id")
    assert preview(frame).count() == 20
    assert [r.id for r in preview(frame, 3, [frame.id.desc()]).collect()] == [29, 28, 27]
