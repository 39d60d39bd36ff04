"""The registered queries of this subpackage and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from opticlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = [
    "url_filter", "chat", "mixing", "warc", "langid", "decontaminate", "pii", "jaccard", "substring", "neighbours", "pipeline",
    "exact_topk", "whitening", "variants",
]


#: Rows and bytes of a batch that a Python worker gets at a time; a row that is larger comes alone.
BATCH_ROWS = 4000
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """The settings that the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return configure(spark)


def fresh(name: str, taken: list[str]) -> str:
    """A column name like `name` that none of `taken` clashes with, in whatever case."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(prepare(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"opticlake.llm.{name}")
