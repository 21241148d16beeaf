"""Registered queries of the procurement operators, each bound to the star-schema tables, with its SQL."""

from .registry import ORACLE, QUERIES
from . import aggregates, dedup_joins, feeds, nested, pipelines, scalars, streams, texts, windows  # noqa: F401  registration

__all__ = ["ORACLE", "QUERIES"]
