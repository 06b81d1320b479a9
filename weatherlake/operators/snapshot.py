"""Snapshots: one indicator, or many, across all stations at one instant.

A snapshot is a time filter (partition-pruned on the by-date layout) and a
projection: the labelled points a map would draw.  Many indicators come from
one scan, unpivoted into long form (a narrow ``Expand``, no shuffle) instead
of one scan per indicator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from weatherlake import schema
from weatherlake.functions.exprs import as_double, half_even
from weatherlake.sources.scan import at_minute

ID_COLS = ("station", "lat", "lon") + schema.TIME_PARTS


def _ids(obs: DataFrame) -> list[str]:
    return [c for c in ID_COLS if c in obs.columns]


def snapshot(obs: DataFrame, indicator: str, year: int, month: int, day: int | None = None,
             hour: int | None = None, minute: int | None = None, *, digits: int = 2) -> DataFrame:
    """Points with a value for ``indicator`` at one instant (omitted parts
    mean "any").  Numeric values are rounded half-even to ``digits``; text
    indicators keep their text.  Columns: station, lat, lon, time parts, value.
    """
    if indicator not in obs.columns:
        raise ValueError(f"indicator {indicator!r} is not a column of the input")
    if not (schema.is_numeric_indicator(indicator) or schema.is_text_indicator(indicator)):
        raise ValueError(f"{indicator!r} cannot be drawn as a label")
    df = at_minute(obs, year, month, day, hour, minute).filter(F.col(indicator).isNotNull())
    value = half_even(indicator, digits) if schema.is_numeric_indicator(indicator) else F.col(indicator)
    return df.select(*_ids(obs), value.alias("value"))


def _batch(obs: DataFrame, indicators: Sequence[str] | None, kind: str) -> list[str]:
    if indicators is None:
        wanted = [c for c in dict.fromkeys(schema.SNAPSHOT_BATCH_INDICATORS) if c in obs.columns]
    else:
        wanted = list(dict.fromkeys(indicators))
        missing = [c for c in wanted if c not in obs.columns]
        if missing:
            raise ValueError(f"indicators not in input: {missing}")
    test = schema.is_numeric_indicator if kind == "numeric" else schema.is_text_indicator
    return [c for c in wanted if test(c)]


def snapshot_all(obs: DataFrame, year: int, month: int, day: int | None = None, hour: int | None = None,
                 minute: int | None = None, *, indicators: Sequence[str] | None = None,
                 digits: int = 2) -> DataFrame:
    """All numeric indicators at one instant in long form, one scan.

    ``indicators`` defaults to the batch list (de-duplicated) restricted to
    the columns present; text indicators and the timestamp are left to
    ``snapshot_all_text``.  Columns: station, lat, lon, time parts,
    indicator, value.
    """
    names = _batch(obs, indicators, "numeric")
    if not names:
        raise ValueError("no numeric indicator to draw")
    ids = _ids(obs)
    df = at_minute(obs, year, month, day, hour, minute).select(*ids, *[as_double(c).alias(c) for c in names])
    long = df.unpivot(ids, names, "indicator", "value")
    return long.filter(F.col("value").isNotNull()).withColumn("value", F.bround("value", digits))


def snapshot_all_text(obs: DataFrame, year: int, month: int, day: int | None = None, hour: int | None = None,
                      minute: int | None = None, *, indicators: Sequence[str] | None = None) -> DataFrame:
    """All text indicators (sky cover, weather codes) at one instant in long
    form.  Columns: station, lat, lon, time parts, indicator, value."""
    names = _batch(obs, indicators, "text")
    if not names:
        raise ValueError("no text indicator to draw")
    ids = _ids(obs)
    df = at_minute(obs, year, month, day, hour, minute).select(*ids, *names)
    return df.unpivot(ids, names, "indicator", "value").filter(F.col("value").isNotNull())
