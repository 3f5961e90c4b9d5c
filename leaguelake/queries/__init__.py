"""Runnable queries over the given tables, one or more per operator, with comparison SQL where SQL can say it."""

from leaguelake.queries import (  # noqa: F401
    events,
    feeds,
    history,
    landing,
    league,
    projections,
    quality,
    serving,
    streaming,
)
from leaguelake.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
