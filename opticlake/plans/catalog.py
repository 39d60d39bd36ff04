"""The registered queries and the SQL that each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opticlake.plans.views import oracle
from opticlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its operator's name, with the SQL over the same tables."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(configure(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register
