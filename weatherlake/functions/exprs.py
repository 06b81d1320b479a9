"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from weatherlake import schema


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: str | Column) -> Column:
    """Stored values are 32-bit floats; every aggregate works on doubles."""
    return col(c).cast("double")


def f_to_c(c: str | Column) -> Column:
    """Fahrenheit to Celsius, ``(t - 32) * 5 / 9``.  Linear, so converting a
    mean equals the mean of converted values; callers convert after averaging."""
    return (col(c) - 32.0) * 5.0 / 9.0


def half_even(c: str | Column, digits: int) -> Column:
    """Round half to even on the double value (NumPy/Python rounding).

    Applied to values of float32 origin; ``F.round`` rounds half up and
    disagrees on ties.
    """
    return F.bround(as_double(c), digits)


def float_lit(x: float) -> Column:
    """A literal with the stored 32-bit type, so that equality on a float
    column compares like with like (``lat == -3.7894`` as a double matches
    nothing)."""
    return F.lit(float(x)).cast("float")


def position_eq(lat: float, lon: float | None = None,
                lat_col: str = "lat", lon_col: str = "lon") -> Column:
    """Exact position predicate on the stored float columns."""
    cond = col(lat_col) == float_lit(lat)
    if lon is not None:
        cond = cond & (col(lon_col) == float_lit(lon))
    return cond


def position_label(lat: str | Column = "lat", lon: str | Column = "lon") -> Column:
    """Display form ``"lat,lon"`` of a rounded position."""
    return F.concat_ws(",", col(lat).cast("string"), col(lon).cast("string"))


def year_month_label(year: str | Column = "year", month: str | Column = "month") -> Column:
    """Display form ``"Y-M"``, month not padded.  Grouping stays on the ints."""
    return F.concat_ws("-", col(year).cast("string"), col(month).cast("string"))


def euclid(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Euclidean distance of two equal-length vectors of columns."""
    if len(a) != len(b) or not a:
        raise ValueError("vectors must be non-empty and of equal length")
    acc = None
    for x, y in zip(a, b):
        term = F.pow(x - y, 2)
        acc = term if acc is None else acc + term
    return F.sqrt(acc)


def planar_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance of two (lon, lat) points in degrees, as a plane."""
    return euclid([lon1, lat1], [lon2, lat2])


def zscore(x: str | Column, mean: Column, std: Column) -> Column:
    """``(x - mean) / std`` with the population std; a feature with zero
    spread contributes 0 instead of dividing by zero."""
    return F.when(std == 0, F.lit(0.0)).otherwise((as_double(x) - mean) / std)


def first_argmin(values: Sequence[Column] | Column | str) -> Column:
    """0-based index of the smallest value, the lowest index on ties.
    ``values``: columns, or one array column."""
    arr = col(values) if isinstance(values, (str, Column)) else F.array(*values)
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def validate_indicator(name: str, kind: str = "numeric", available: Sequence[str] | None = None) -> str:
    """Check a run-time indicator name before it becomes a column reference."""
    names = schema.NUMERIC_INDICATORS if kind == "numeric" else schema.TEXT_INDICATORS
    if name not in names:
        raise ValueError(f"unknown {kind} indicator {name!r}; expected one of {', '.join(names)}")
    if available is not None and name not in available:
        raise ValueError(f"indicator {name!r} is not a column of the input")
    return name
