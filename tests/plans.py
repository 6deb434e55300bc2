"""Physical plan text of a DataFrame."""

from __future__ import annotations


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
