"""Registry of the migration jobs: query name -> (Spark builder, DuckDB oracle text)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..context import DEFAULT_CONTEXT, MigrationContext
from ..sources.catalog import Legacy
from . import assets, fleet, master, orders, quotation, rejects, requisitions, suppliers, tender, warehouse

_MODULES = [master, suppliers, quotation, tender, orders, warehouse, fleet, requisitions, assets, rejects]

JOBS: dict[str, Callable[[Legacy, MigrationContext], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: Outputs kept in segments: name -> function that gives segment -> rows, or None for a segment that stays as it is.
SEGMENTS: dict[str, Callable[[Legacy, MigrationContext], dict[str, DataFrame | None]]] = {}
for _m in _MODULES:
    JOBS.update(_m.QUERIES)
    SEGMENTS.update(getattr(_m, "SEGMENTS", {}))
    ORACLE.update(_m.ORACLE)


def run(name: str, spark: SparkSession, sf_dir: str, ctx: MigrationContext = DEFAULT_CONTEXT) -> DataFrame:
    return JOBS[name](Legacy(spark, sf_dir), ctx)
