from __future__ import annotations

import pytest
from frames import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from marquee.functions import (
    cast_to_schema,
    genre_matches,
    release_year,
    release_year_pandas,
    title_matches,
    title_without_year,
    title_without_year_pandas,
    to_double,
    to_long,
)
from marquee.schemas import RATINGS

TITLES = {
    "Toy Story (1995)": ("1995", "Toy Story "),
    "ab (2000)": ("2000", "ab "),
    "(1999)": ("1999", ""),
    "a)": ("a", ""),
    "": (None, None),
    "No year": (None, None),
    "Foo (1995) ": (None, None),
    "Bar (2005-2007)": ("2007", "Bar (2005"),
    "Él (1953)": ("1953", "Él "),
    None: (None, None),
}


def parsed(spark, titles, year, title):
    frame = spark.createDataFrame([(t,) for t in titles], "t string")
    return {r.t: (r.y, r.n) for r in frame.select("t", year("t").alias("y"), title("t").alias("n")).collect()}


def test_titles(spark):
    assert parsed(spark, TITLES, release_year, title_without_year) == TITLES


def test_titles_pandas(spark):
    assert parsed(spark, TITLES, release_year_pandas, title_without_year_pandas) == TITLES


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\0"), max_size=12), max_size=25))
def test_any_titles_cut_by_character(spark, texts):
    titles = set(texts) | {t + ")" for t in texts}
    want = {t: (t[-5:-1], t[:-6]) if t.endswith(")") else (None, None) for t in titles}
    assert parsed(spark, titles, release_year, title_without_year) == want


def test_dirty_numbers_become_null(spark):
    frame = spark.createDataFrame([("1.5",), ("oops",), (None,)], "c string")
    assert frame.agg(F.avg(to_double("c"))).first()[0] == 1.5
    assert rows(frame.select(to_long(F.lit("7x")))) == [(None,)] * 3
    with pytest.raises(NumberFormatException):
        frame.select(F.col("c").cast("double")).collect()


def test_columns_found_in_any_letter_case(spark):
    frame = spark.createDataFrame([("3", "x", "4.5", "note")], "movieId string, userId string, Rating string, n string")
    found = cast_to_schema(frame, RATINGS)
    assert found.columns == ["userid", "movieid", "rating"]
    assert rows(found) == [(None, 3, 4.5)]


def test_wildcards_in_keyword(spark):
    frame = spark.createDataFrame([("100% wolf",), ("1000 wolves",)], "title string")
    assert frame.filter(title_matches("100% W")).count() == 2
    assert rows(frame.filter(title_matches("100% W", literal=True))) == [("100% wolf",)]


def test_genre_is_a_substring_test(spark):
    genres = ["Children's|Comedy", "Children", "Sci-Fi", "(no genres listed)", None]
    frame = spark.createDataFrame([(g,) for g in genres], "genres string")
    assert rows(frame.filter(genre_matches("Children"))) == [("Children",), ("Children's|Comedy",)]
