"""Scans of the observation tables: by position, by month, by day range and
at one instant.

Each is a plain ``filter``/``select`` on a DataFrame.  On the stored Parquet
layouts Catalyst turns the time predicates into partition filters (the
by-date layout is partitioned by year and month) and pushes the rest into the
Parquet reader, where the sort order of the files makes row-group statistics
skip most of the data; ``ReadSchema`` holds only the selected columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from weatherlake.functions.exprs import position_eq


def by_position(obs: DataFrame, lat: float, lon: float | None, columns: Sequence[str] | str = ()) -> DataFrame:
    """Rows at an exact stored position: ``year, month`` and the requested
    columns.  Float equality is done in the stored 32-bit type."""
    if isinstance(columns, str):
        columns = (columns,)
    for c in columns:
        if c not in obs.columns:
            raise ValueError(f"unknown column {c!r}")
    return obs.filter(position_eq(lat, lon)).select("year", "month", *columns)


def by_month(obs: DataFrame, year: int, month: int, columns: Sequence[str] | None = None) -> DataFrame:
    """All rows of one month."""
    out = obs.filter((F.col("year") == year) & (F.col("month") == month))
    return out.select(*columns) if columns else out


def by_day_range(obs: DataFrame, year: int, month: int, day1: int | None = None, day2: int | None = None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of one month between two days, inclusive at both ends.  Omitted
    days mean the whole month."""
    cond = (F.col("year") == year) & (F.col("month") == month)
    if day1 is not None:
        cond = cond & (F.col("day") >= day1)
    if day2 is not None:
        cond = cond & (F.col("day") <= day2)
    out = obs.filter(cond)
    return out.select(*columns) if columns else out


def at_minute(obs: DataFrame, year: int, month: int, day: int | None = None, hour: int | None = None,
              minute: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows at one instant.  An omitted part means "any"."""
    cond = (F.col("year") == year) & (F.col("month") == month)
    for name, v in (("day", day), ("hour", hour), ("minute", minute)):
        if v is not None:
            cond = cond & (F.col(name) == v)
    out = obs.filter(cond)
    return out.select(*columns) if columns else out
