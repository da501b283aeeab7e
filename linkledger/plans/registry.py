"""Registry of named queries: each is a Spark callable (spark, sf_dir) -> DataFrame
and, where the semantics are SQL-expressible, the equivalent DuckDB SQL over
the same tables. Double outputs are rounded to 9 places on both sides, so the
compare does not depend on the association order of floating-point sums.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ROUND = 9


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco
