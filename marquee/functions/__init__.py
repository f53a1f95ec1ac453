from marquee.functions.casts import cast_to_schema, to_double, to_long
from marquee.functions.matching import genre_matches, title_matches
from marquee.functions.titles import (
    release_year,
    release_year_pandas,
    title_without_year,
    title_without_year_pandas,
)

__all__ = [
    "cast_to_schema",
    "genre_matches",
    "release_year",
    "release_year_pandas",
    "title_matches",
    "title_without_year",
    "title_without_year_pandas",
    "to_double",
    "to_long",
]
