"""The query registry shared by the catalogue modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.plans.stages import to_wallclock

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its DuckDB oracle text (if any).

    Instants leave as UTC wall-clock ``timestamp_ntz``, which is what the
    oracle's ``TIMESTAMP`` holds.
    """
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # operators read and present instants in UTC (the reference's database zone)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return to_wallclock(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco
