"""Named queries with the inventory ids they cover and their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(ids: str, sql: str | None = None, name: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its function name; without SQL only its rows are checked."""

    def register(run: Run) -> Run:
        key = name or run.__name__
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = Query(key, tuple(ids.split()), run, sql)
        return run

    return register


def load_all() -> dict[str, Query]:
    from forumtide.plans import (  # noqa: F401
        growth,
        intake,
        merging,
        ranking,
        reporting,
        texts,
    )

    return QUERIES
