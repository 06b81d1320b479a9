"""Column expressions (scalar functions) used across the library."""

from weatherlake.functions.exprs import (  # noqa: F401
    as_double, euclid, f_to_c, first_argmin, float_lit, half_even, planar_distance,
    position_eq, position_label, validate_indicator, year_month_label, zscore,
)
