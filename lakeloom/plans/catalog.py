"""Registry of named queries: Spark builder + DuckDB oracle SQL.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
full given tables. The oracle is an independent ANSI-SQL formulation over the
same tables (views registered by name), omitted where no SQL form exists.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module so its ``register`` calls run."""
    from lakeloom.plans import (q_claims, q_explore, q_files, q_loads, q_messages, q_normalise,  # noqa: F401
                                q_observations, q_streams)
