"""Text predicates of the search and of the genre shelves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_matches(keyword: str, title: Column | str = "title", literal: bool = False) -> Column:
    """Case-insensitive substring test.

    ``%`` and ``_`` in the keyword act as wildcards unless ``literal`` is set.
    """
    column = F.lower(F.col(title) if isinstance(title, str) else title)
    needle = keyword.lower()
    return F.contains(column, F.lit(needle)) if literal else column.like(f"%{needle}%")


def genre_matches(genre: str, genres: Column | str = "genres") -> Column:
    """Substring test on the pipe-separated genre text (``Children`` finds ``Children's``)."""
    column = F.col(genres) if isinstance(genres, str) else genres
    return column.like(f"%{genre}%")
