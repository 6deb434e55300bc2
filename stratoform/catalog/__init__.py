"""Named queries over a folder of tables, each with its reference SQL."""

from __future__ import annotations

from stratoform.catalog.registry import Query, registered

__all__ = ["Query", "all_queries"]


def all_queries() -> dict[str, Query]:
    from stratoform.catalog import (  # noqa: F401 - importing registers the queries
        analytics,
        cleansing,
        expressions,
        ingest,
        layouts,
        modelling,
        quality,
        records,
        sketches,
        summaries,
    )

    return registered()
