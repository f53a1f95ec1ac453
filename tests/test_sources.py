from __future__ import annotations

from frames import rows

from marquee import schemas
from marquee.functions.titles import release_year
from marquee.sources import query_views, rating_rows, read_csv_by_name, read_table, scan_csv, split_text_ratings, value_rows

RATINGS_TEXT = "userId,movieId,rating,timestamp\n1,2,3.5,99\n1,3,4.0,98\nbad,4,1.0,3\n7,8\n"
LENIENT = [(1, 2, 3.5), (1, 3, 4.0), (7, 8, None), (None, 4, 1.0)]


def write(tmp_path, text, name="in.csv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_declared_schema_is_lenient(spark, tmp_path):
    found = scan_csv(spark, write(tmp_path, RATINGS_TEXT), schemas.RATINGS)
    assert rows(found) == LENIENT
    assert all(f.nullable for f in found.schema)


def test_header_read_as_data_is_dropped_by_the_join(spark, tmp_path):
    path = write(tmp_path, RATINGS_TEXT)
    unheaded = scan_csv(spark, path, schemas.RATINGS, header=False)
    assert rows(unheaded) == [*LENIENT, (None, None, None)]
    movies = spark.createDataFrame([(i,) for i in (2, 3, 4, 8)], "movieid bigint")
    headed = scan_csv(spark, path, schemas.RATINGS)
    assert rows(unheaded.join(movies, "movieid")) == rows(headed.join(movies, "movieid"))


def test_inferred_types(spark, tmp_path):
    found = scan_csv(spark, write(tmp_path, "userId,movieId,rating\n1,2,3.5\n2,3,4.0\n"))
    assert found.dtypes == [("userId", "int"), ("movieId", "int"), ("rating", "double")]


def test_columns_by_name(spark, tmp_path):
    path = write(tmp_path, "rating,note,MOVIEID,userId\n4.5,x,7,1\noops,y,8,2\n")
    assert rows(read_csv_by_name(spark, path, schemas.RATINGS)) == [(1, 7, 4.5), (2, 8, None)]
    assert rows(read_table(spark, path, schemas.RATINGS)) == [(1, 7, 4.5), (2, 8, None)]


def test_stored_table_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(4.5, 7, 1)], "rating float, movieId int, userId int").write.parquet(path)
    assert rows(read_table(spark, path, schemas.RATINGS, "parquet")) == [(1, 7, 4.5)]


def test_quoted_cell_with_comma_quote_and_line_break(spark, tmp_path):
    path = write(tmp_path, 'id,language,plot\n5,en,"He said ""go"", then\nleft"\n')
    found = scan_csv(spark, path, "id bigint, language string, plot string", multi_line=True)
    assert rows(found) == [(5, "en", 'He said "go", then\nleft')]


def test_text_lines(spark, tmp_path):
    path = write(tmp_path, "userId,movieId,rating,timestamp\n1,2,3.5,99\nuserId,movieId,rating,timestamp\n3,4,5.0,1\n")
    assert rows(split_text_ratings(spark, path)) == [(1, 2, 3.5), (3, 4, 5.0)]
    assert rows(split_text_ratings(spark, write(tmp_path, "", "empty.csv"))) == []


def test_inline_rows(spark):
    assert rows(rating_rows(spark, 9, [1, 2])) == [(9, 1, 5.0), (9, 2, 5.0)]
    assert rating_rows(spark, 9, []).schema == schemas.RATINGS
    assert rows(value_rows(spark, [], "a int")) == []


def test_views_live_for_one_query(spark):
    kept = spark.createDataFrame([("kept",)], "a string")
    kept.createOrReplaceTempView("numbers")
    found = query_views(spark, "SELECT sum(a) AS total FROM numbers", numbers=spark.range(4).toDF("a"))
    assert rows(found) == [(6,)]
    assert rows(spark.table("numbers")) == [("kept",)]
    query_views(spark, "SELECT * FROM passing", passing=kept)
    assert not spark.catalog.tableExists("passing")
    spark.catalog.dropTempView("numbers")


def test_year_column_of_a_csv_stays_text(spark, tmp_path):
    path = write(tmp_path, "movieid,title,genres\n1,Heat (1995),Crime\n")
    found = scan_csv(spark, path, schemas.MOVIES).select(release_year("title").alias("y"))
    assert found.dtypes == [("y", "string")]
