"""Every operator as a query on the given tables, with its SQL twin."""

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepared(query):
    """The query in a configured session. Where `spark.checkpoint.dir` is unset and the session
    runs in one process, as in tests, a temporary folder is named."""

    def run(spark, sf_dir):
        configure(spark)
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not named and context.master.startswith("local["):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="footfall-"))
        return query(spark, sf_dir)

    return run


def check(name: str, sql: str | None = None):
    """Register a query, and the SQL that must give the same rows."""

    def add(query):
        QUERIES[name] = prepared(query)
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def load_all() -> None:
    from checks import (  # noqa: F401
        aggregates, bodies, filters, joins, legacy, projections, sets, streams, wire, windows,
    )
