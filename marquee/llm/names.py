"""Column names that no table of the caller already has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(frame: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until the frame has no such column in any letter case."""
    taken = {c.lower() for c in frame.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
