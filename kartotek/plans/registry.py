"""Name -> query and name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kartotek.plans.bindings import Tables
from kartotek.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, *ctes: str, sql: str | None = None):
    """Register a query over :class:`Tables`; ``ctes`` and ``sql`` make its oracle."""

    def add(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(configure(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + sql
        return build

    return add
