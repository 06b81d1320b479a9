"""The registered queries: each runs a library operator over the driver's
tables (through the adapters of ``weatherlake.sources.fixtures``) and has an
independent SQL formulation for DuckDB beside it.

Every query reads whole tables; positions, years and dates below are the
query parameters of the operator, not subsets taken to keep checks cheap.
Aggregated doubles are rounded to 6 decimals in both formulations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from weatherlake.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, sql)
        return fn
    return deco


def r6(c: str):
    """Round an aggregated double for comparison."""
    return F.round(F.col(c), 6).alias(c)


def with_o(body: str) -> str:
    """Prefix a SQL body with the adapter relation ``O``."""
    return "WITH " + fx.sql_cte() + "\n" + body


# Plain-SQL fragments shared by several oracles.
POS = f"lat = CAST({fx.PROBE_LAT} AS FLOAT) AND lon = CAST({fx.PROBE_LON} AS FLOAT)"
F2C = "(({x}) - 32) * 5.0 / 9.0"
