"""All queries of the engine by name, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import intake  # noqa: F401  (registers its queries)
from . import queries as q

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return dict(q.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(q.SQL)
