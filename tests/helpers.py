"""Helpers of the tests."""

from __future__ import annotations


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    found = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(found, key=lambda r: [(v is None, str(v)) for v in r])
