"""What tests look at in a DataFrame."""

from __future__ import annotations


def rows(frame):
    """Rows as a list of tuples, sorted as text with nulls last."""
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def physical_plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
