"""Table layouts.

Keys are 64-bit and measures are double, so that sums and averages match a SQL
engine's; every column is nullable because text files give no stronger promise.
"""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

_LONG, _DOUBLE, _TEXT, _DATE = LongType(), DoubleType(), StringType(), DateType()


def _layout(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


RATINGS = _layout(userid=_LONG, movieid=_LONG, rating=_DOUBLE)
MOVIES = _layout(movieid=_LONG, title=_TEXT, genres=_TEXT)
LINKS = _layout(movieid=_LONG, imdbid=_LONG, tmdbid=_LONG)
GENOME_SCORES = _layout(movieid=_LONG, tagid=_LONG, relevance=_DOUBLE)
GENOME_TAGS = _layout(tagid=_LONG, tag=_TEXT)
MOVIE_DATA = _layout(
    id=_LONG,
    language=_TEXT,
    plot=_TEXT,
    popularity=_DOUBLE,
    poster=_TEXT,
    production_companies=_TEXT,
    release_date=_DATE,
    keywords=_TEXT,
    vote_average=_DOUBLE,
)

# Column order of the curated rating-grain table.
MOVIE_REPO = _layout(
    userid=_LONG,
    movieid=_LONG,
    genres=_TEXT,
    keywords=_TEXT,
    language=_TEXT,
    plot=_TEXT,
    popularity=_DOUBLE,
    poster=_TEXT,
    production_companies=_TEXT,
    rating=_DOUBLE,
    release_year=_TEXT,
    title=_TEXT,
    tmdbid=_LONG,
    vote_average=_DOUBLE,
)
MOVIE_REPO_COLUMNS = MOVIE_REPO.names

# The reports read the curated table without its keywords.
REPORT_INPUT = StructType([f for f in MOVIE_REPO.fields if f.name != "keywords"])
