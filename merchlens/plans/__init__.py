"""Registered queries, their SQL oracles and the end-to-end run."""

from __future__ import annotations


def all_queries():
    """Every registered query by name."""
    from . import queries_data, queries_models, queries_tables  # noqa: F401  (each module registers its queries)
    from .registry import QUERIES

    return QUERIES
