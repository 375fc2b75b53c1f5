"""Query registry: name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    build: Builder
    oracle: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, Registered] = {}


def register(name: str, operators: tuple[str, ...] | list[str], oracle: str | None = None):
    """Decorator: register a query builder with its operator ids and DuckDB oracle SQL."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Registered(name, fn, oracle, tuple(operators))
        return fn

    return deco


def load_all() -> dict[str, Registered]:
    # importing the modules fills the registry
    from claimwise.plans import (  # noqa: F401
        q_stats, q_extract, q_enrich, q_decode, q_person, q_score, q_io,
    )
    return REGISTRY
