"""Queries over the driver tables, one per operator, and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame, with its SQL if SQL can express it."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def _load() -> None:
    from tidemark.plans import core, details, discovery, ledgers, lookups, models, rollups, round_trips, samples, streams, tables  # noqa: F401


_load()
