"""Registered queries: one Spark plan per operator family, each paired (where
SQL can express it) with an oracle query DuckDB runs on the same tables.

Every query reads the driver tables (or tables Spark derives from them), so
its work grows with the data; nothing runs on made-up input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _load_all() -> None:
    # importing the modules fills the registries
    from roadframe.plans import queries_etl  # noqa: F401
    from roadframe.plans import queries_profile  # noqa: F401
    from roadframe.plans import queries_ml  # noqa: F401
    from roadframe.plans import queries_io  # noqa: F401
    from roadframe.plans import full_etl  # noqa: F401
    from roadframe.plans import queries_more  # noqa: F401
    from roadframe.plans import queries_training  # noqa: F401
    from roadframe.plans import queries_documents  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
