"""Title and release year out of ``Some Title (1999)``.

A title counts as dated when its last character is ``)``. The year is the four
characters before it and the title is everything but the last six characters,
trailing blank included; an undated title yields null for both.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _col(title: Column | str) -> Column:
    return F.col(title) if isinstance(title, str) else title


def release_year(title: Column | str) -> Column:
    title = _col(title)
    return F.when(F.endswith(title, F.lit(")")), F.substring(title, -5, 4))


def title_without_year(title: Column | str) -> Column:
    title = _col(title)
    kept = F.greatest(F.char_length(title) - 6, F.lit(0))
    return F.when(F.endswith(title, F.lit(")")), F.substring(title, F.lit(1), kept))


# Arrow-batched forms of the same two functions. The native columns above are the
# ones in use; these exist for callers who register them as SQL functions.


@F.pandas_udf(StringType())
def release_year_pandas(titles: pd.Series) -> pd.Series:
    return titles.str[-5:-1].where(titles.str.endswith(")", na=False), None)


@F.pandas_udf(StringType())
def title_without_year_pandas(titles: pd.Series) -> pd.Series:
    return titles.str[:-6].where(titles.str.endswith(")", na=False), None)
