"""Named queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)
    oracles: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, query: Query, oracle: str | None = None) -> None:
        if name in self.queries:
            raise KeyError(f"query {name} is registered twice")
        self.queries[name] = query
        if oracle is not None:
            self.oracles[name] = oracle
