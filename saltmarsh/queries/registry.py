"""Registered queries: a Spark callable and, where possible, the equal SQL text."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


class Entry(NamedTuple):
    run: Run
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under ``name``; ``sql`` is the independent reference text."""

    def add(run: Run) -> Run:
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(run, sql)
        return run

    return add
