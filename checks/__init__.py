"""Every operator as a query over the driver tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``run(tables) -> DataFrame`` under a name, with the SQL that must give the same rows."""
    from checks.views import Tables, with_views

    def register(run):
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(Tables(spark, sf_dir))

        call.__name__ = name
        call.__doc__ = run.__doc__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return run

    return register


def load() -> None:
    """Import every module that registers queries."""
    from checks import aggregates, functions, joins, sources, streams, validation  # noqa: F401
