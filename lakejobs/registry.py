"""Registry of runnable queries: a Spark builder and, where SQL can say it, an oracle text."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lakejobs.tables import VIEWS, Tables


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def _with_views(sql: str, views: tuple[str, ...]) -> str:
    body = sql.strip()
    if not views:
        return body
    head = ",\n".join(f"{name} AS (\n{VIEWS[name].oracle_text()}\n)" for name in views)
    recursive = re.match(r"(?is)^WITH\s+RECURSIVE\s+", body)
    if recursive:
        return f"WITH RECURSIVE {head},\n{body[recursive.end():]}"
    plain = re.match(r"(?is)^WITH\s+", body)
    if plain:
        return f"WITH {head},\n{body[plain.end():]}"
    return f"WITH {head}\n{body}"


def query(key: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a builder under ``key``; ``views`` are put before the oracle text as CTEs."""

    def register(build):
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(key, build, _with_views(sql, views) if sql else None)
        return build

    return register
